"""Minimax contiguous sharding of atomic groups, with DataFrame functions only.

Equal texts (null counts as empty) form one group and stay together; the groups are ordered by a hash of the text. A
shard is a stretch of that order, and the shards are cut at the smallest capacity that suffices: binary search over the
capacity, each candidate checked greedily, each shard filled up to the capacity.

The check needs, for a position x, the last group end at or before x. Group ends are running sums, made in two levels of
windows over ranges of the hash. The driver holds a summary of them: the first and last end of each of ``SUMMARY`` equal
stretches. Where a stretch leaves a capacity or a cut open, only the stretches that any cut can still fall into are
summarised again, finer; so the driver's share is bounded by the number of shards, whatever the number of groups.

A group larger than an even share gets a shard of its own, and the rest is cut into the remaining shards; else greedy
filling to such a group's size would leave shards empty. Documents then find shard and slot by expressions and two more
levels of counts. An empty table gives an empty result; rows that repeat are placed each by itself; a null ``doc_id`` is
carried along. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketframe.llm.common import numbered, parts_for, written

SHARDS = 16
#: Stretches of the running sum that the driver looks at first.
SUMMARY = 4096
#: How much shorter stretches get with each refinement. A cut lies within some multiple of the number of shards of
#: stretches, so the driver sees at most about FINER * SHARDS ** 2 of them.
FINER = 64
#: Rows numbered together.
RANGE_ROWS = 1024
#: Ranges numbered together, as bits.
_RANGE_BITS = 12


def running_sums(groups: DataFrame, rows: int) -> DataFrame:
    """Adds ``upto``: the sum of ``bytes`` over all keys up to this one. Keys are evenly spread longs."""
    bits = (parts_for(rows, RANGE_ROWS) - 1).bit_length()

    def top(column: str, shift: int) -> Column:
        return F.shiftright(column, shift) if shift < 64 else F.lit(0).cast("long")

    ranged = groups.withColumn("range", top("key", 64 - bits))
    sums = ranged.groupBy("range").agg(F.sum("bytes").alias("in_range"))
    sums = sums.withColumn("wide", top("range", max(0, bits - _RANGE_BITS)))
    wide = sums.groupBy("wide").agg(F.sum("in_range").alias("in_wide"))
    before_wide = F.sum("in_wide").over(Window.orderBy("wide").rowsBetween(Window.unboundedPreceding, -1))
    wide = wide.select("wide", F.coalesce(before_wide, F.lit(0)).alias("before_wide"))
    before = F.sum("in_range").over(Window.partitionBy("wide").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("before", F.coalesce(before, F.lit(0))).join(wide, "wide")
    offsets = sums.select("range", (F.col("before") + F.col("before_wide")).alias("offset"))
    own = F.sum("bytes").over(Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("own", own).join(offsets, "range").select("key", "bytes", (F.col("own") + F.col("offset")).alias("upto"))


class Ends:
    """What is known of the group ends: for disjoint stretches in order, the first and the last end."""

    def __init__(self, stretches: list[tuple[int, int]]):
        self.stretches = sorted(stretches)
        self.firsts = [first for first, _ in self.stretches]

    def last_upto(self, x: int) -> tuple[int, int]:
        """Bounds of the last group end at or before ``x``; 0 if there is none."""
        at = bisect_right(self.firsts, x) - 1
        if at < 0:
            return 0, 0
        first, last = self.stretches[at]
        return (last, last) if last <= x else (first, x if last > first else first)

    def cuts(self, capacity: int, shards: int) -> tuple[list[int], list[int]]:
        """Lower and upper bounds of the greedy cuts."""
        low, high = [0], [0]
        for _ in range(shards):
            low.append(self.last_upto(low[-1] + capacity)[0])
            high.append(self.last_upto(high[-1] + capacity)[1])
        return low[1:], high[1:]


def _least(low: int, high: int, holds) -> int:
    """The least value of low..high for which ``holds``; it holds for ``high``."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle + 1, high)
    return low


def _summary(sums: DataFrame, windows: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """First and last end of each stretch of ``width`` in the windows (above a window's start, up to its end)."""
    inside = F.lit(False)
    for start, end in windows:
        inside = inside | ((F.col("upto") > start) & (F.col("upto") <= end))
    rows = sums.where(inside).groupBy(F.expr(f"(upto - 1) div {width}L"))
    return [(row["first"], row["last"]) for row in rows.agg(F.min("upto").alias("first"), F.max("upto").alias("last")).collect()]


def _joined(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(windows):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def minimax_cuts(sums: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity and the greedy cuts at it, as running sums."""
    width = -(-total // SUMMARY)
    ends = Ends(_summary(sums, [(0, total)], width))
    low, high = max(largest, -(-total // shards)), -(-total // shards) + largest
    while True:
        high = _least(low, high, lambda capacity: ends.cuts(capacity, shards)[0][-1] >= total)
        low = _least(low, high, lambda capacity: ends.cuts(capacity, shards)[1][-1] >= total)
        at_least, at_most = ends.cuts(low, shards)[0], ends.cuts(high, shards)[1]
        if low == high and at_least == at_most:
            return low, at_least
        windows = _joined([(a - 1, b) for a, b in zip(at_least, at_most, strict=True) if a < b])
        kept = [s for s in ends.stretches if s[0] == s[1] and not any(a < s[0] <= b for a, b in windows)]
        outside = [s for s in ends.stretches if s[0] < s[1]]
        for first, last in outside:
            inner = [(a, b) for a, b in windows if a < last and b >= first]
            if not inner:
                kept.append((first, last))
            else:  # the whole stretch is seen again
                windows = _joined([*windows, (first - 1, last)])
        kept = [s for s in kept if not any(a < s[1] and s[0] <= b for a, b in windows)]
        width = -(-width // FINER)
        ends = Ends(kept + _summary(sums, windows, width))


def giants(largest: list[int], total: int, shards: int) -> int:
    """How many of the largest groups exceed an even share of what is left for the other shards."""
    taken = 0
    for count, size in enumerate(largest[: shards - 1]):
        if size * (shards - count) <= total - taken:
            return count
        taken += size
    return min(len(largest), shards - 1)


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    heads = numbered(
        documents,
        "heads",
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    )
    groups = written(heads.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "groups")
    facts = groups.agg(F.sum("bytes").alias("total"), F.count("*").alias("n"), F.sum("rows").alias("rows")).first()
    total, rows = facts["total"] or 0, facts["rows"] or 0
    top = groups.orderBy(F.desc("bytes"), "key").limit(shards).select("key", "bytes").collect()
    alone = [row["key"] for row in top[: giants([row["bytes"] for row in top], total, shards)]]
    rest, rest_total = groups, total
    if alone:
        rest = groups.where(~F.col("key").isin(alone))
        rest_total -= sum(row["bytes"] for row in top[: len(alone)])
    cut_keys: list[int] = []
    if rest_total:
        sums = written(running_sums(rest, facts["n"]), "sums")
        _, cuts = minimax_cuts(sums, rest_total, top[len(alone)]["bytes"], shards - len(alone))
        inner = sorted({cut for cut in cuts if 0 < cut < rest_total})
        cut_keys = sorted(row["key"] for row in sums.where(F.col("upto").isin(inner)).select("key").collect()) if inner else []
    shard = F.lit(0)
    for key in cut_keys:
        shard = shard + F.when(F.col("key") > key, 1).otherwise(0)
    placed = shard
    for number, key in enumerate(alone):
        placed = F.when(F.col("key") == key, shards - 1 - number).otherwise(placed)

    deal = F.pmod(F.xxhash64("row_id"), F.lit(parts_for(rows, shards * RANGE_ROWS)))
    dealt = heads.select("*", placed.cast("int").alias("shard"), deal.alias("deal"))
    counts = dealt.groupBy("shard", "deal").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("shard", "deal", F.coalesce(before, F.lit(0)).alias("before"))
    turn = F.row_number().over(Window.partitionBy("shard", "deal").orderBy("row_id")) - 1
    return (
        dealt.withColumn("turn", turn)
        .join(counts, ["shard", "deal"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("turn") + F.col("before")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
