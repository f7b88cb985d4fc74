"""Mixing sources to target weights over fixed-length blocks.

1. Words of a source are laid end to end, in a pseudorandom document order, and cut into blocks of ``BLOCK`` words (the
   last one may be shorter).
2. Weights share the words of all sources; a source's target stops at ``MOST_REPEATS`` times its words, and the excess is
   shared again by weight.
3. Each output shard draws its number of slots per source from a multinomial. Running sums over the shards number a
   source's slots; what the draws leave over or short of the target is cut or topped up in one last shard.
4. A slot is mapped to a block through the source's pseudorandom index permutation, anew for every pass, so no block comes
   twice before all have come once. The slot that reaches the target is cut there.
5. Blocks join the slots by (source, index); each document's taken words are summed from the pieces of its blocks.

Order within a source and all draws come from hashes of the seed, so reruns agree. A null text has no words; null is a
source of its own, the last. Documents without words are listed and take nothing; an empty table gives an empty result.
Rows that repeat are separate documents. Sources are few against documents: one row each (name, words) is handled on the
driver, like the weights. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from docketframe.llm.common import WORD, by_key, numbered, one_per_key, parts_for, row_key, unused

BLOCK = 128
MOST_REPEATS = 3
#: Slots of an output shard.
SHARD_SLOTS = 8192
#: Rows numbered together.
CHUNK_ROWS = 4096


def cycled(index: int) -> float:
    """The weight of the source at ``index``: 1, 2, 3, repeating."""
    return float(index % 3 + 1)


def targets(sizes: list[int], weights: list[float], most: int = MOST_REPEATS) -> list[float]:
    """Words wanted of each source: all words shared by weight, none above ``most`` times its size."""
    wanted, total = [0.0] * len(sizes), float(sum(sizes))
    capped: set[int] = set()
    while len(capped) < len(sizes):
        open_weight = sum(w for i, w in enumerate(weights) if i not in capped)
        left = total - sum(wanted[i] for i in capped)
        over = []
        for i, weight in enumerate(weights):
            if i not in capped:
                wanted[i] = left * weight / open_weight
                if wanted[i] > most * sizes[i]:
                    over.append(i)
        if not over:
            break
        for i in over:
            wanted[i] = float(most * sizes[i])
        capped.update(over)
    return wanted


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The place of each ``index`` under the pseudorandom permutation of 0..size-1 that ``key`` selects, or the reverse.

    A Feistel network over a power of four, walked until the value is in range.
    """
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask, key = (np.uint64(1) << bits) - np.uint64(1), key.astype(np.int64).view(np.uint64)
    out, todo, size = index.astype(np.uint64), np.arange(len(index)), size.astype(np.uint64)
    with np.errstate(over="ignore"):

        def scramble(half: np.ndarray, turn: int) -> np.ndarray:
            h = (half + key[todo] + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return (h ^ (h >> np.uint64(29))) & mask[todo]

        while len(todo):
            left, right = out[todo] >> bits[todo], out[todo] & mask[todo]
            for turn in range(4):
                if inverse:
                    left, right = right ^ scramble(left, 3 - turn), left
                else:
                    left, right = right, left ^ scramble(right, turn)
            out[todo] = (left << bits[todo]) | right
            todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def positions(heads: DataFrame, group: str, size: str, rows: int, seed: int) -> DataFrame:
    """Adds ``start``: the running sum of ``size`` within ``group``, in the order of a hash of the row.

    Rows are numbered in chunks and chunks are numbered by their sums, so a group of any size is spread.
    """
    chunk = F.pmod(F.xxhash64(F.lit(seed), "row_id"), F.lit(parts_for(rows, CHUNK_ROWS)))
    chunked = heads.withColumn("chunk", chunk)
    sums = chunked.groupBy(group, "chunk").agg(F.sum(size).alias("in_chunk"))
    before = F.sum("in_chunk").over(Window.partitionBy(group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(F.col(group).alias("of"), F.col("chunk").alias("at"), F.coalesce(before, F.lit(0)).alias("before"))
    own = F.sum(size).over(Window.partitionBy(group, "chunk").orderBy("row_id").rowsBetween(Window.unboundedPreceding, -1))
    numbered_rows = chunked.withColumn("own", F.coalesce(own, F.lit(0)))
    return (
        numbered_rows.join(offsets, F.expr(f"{group} = of and chunk = at"))
        .withColumn("start", F.col("own") + F.col("before"))
        .drop("own", "before", "of", "at", "chunk")
    )


def source_table(heads: DataFrame, weight=cycled) -> list[dict]:
    """One entry a source, by code point, null last: place, source, source_size, target."""
    sums = heads.groupBy("source").agg(F.sum("size").alias("words")).collect()
    ordered = sorted(sums, key=lambda row: (row["source"] is None, row["source"] or ""))
    sizes = [row["words"] for row in ordered]
    wanted = targets(sizes, [weight(i) for i in range(len(sizes))])
    return [
        {"place": i, "source": row["source"], "source_size": row["words"], "target": wanted[i]} for i, row in enumerate(ordered)
    ]


def _passes(source: dict, seed: int, block: int) -> dict:
    """How a source's slots run: whole passes over its blocks, then slots up to the target, the last one cut."""
    size, wanted = source["source_size"], round(source["target"])
    blocks = -(-size // block)
    shortage = blocks * block - size
    passes, rest = divmod(wanted, size) if size else (0, 0)
    key, slots, cut = seed * 1_000_003 + source["place"] * 7919, 0, 0
    if rest:
        # The slot of the last pass at which the shorter last block comes.
        short = int(permuted(np.array([blocks - 1]), np.array([blocks]), np.array([key + passes]), inverse=True)[0])
        slots = -(-rest // block)
        if short < slots and slots * block - shortage < rest:
            slots += 1
        cut = rest - ((slots - 1) * block - (shortage if short < slots - 1 else 0))
    return {"blocks": blocks, "key": key, "slots": passes * blocks + slots, "cut": cut}


def drawn(spark: SparkSession, needs: list[int], seed: int, shard_slots: int) -> DataFrame:
    """shard, place, first, slots: the slots of each source that an output shard draws; ``needs``: slots of each source."""
    total = sum(needs)
    shards = parts_for(total, shard_slots)
    share = np.array(needs, dtype=np.float64) / max(total, 1)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"] if total else []:
                counts = np.random.default_rng([seed, int(shard)]).multinomial(-(-total // shards), share)
                yield pd.DataFrame({"shard": shard, "place": np.arange(len(share)), "slots": counts})

    draws = spark.range(shards).mapInPandas(draw, "shard long, place int, slots long")
    needed = spark.createDataFrame(list(enumerate(needs)), "place int, needed long")
    last = needed.select(F.lit(shards).cast("long").alias("shard"), "place", F.col("needed").alias("slots"))
    upto = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = draws.unionByName(last).withColumn("first", F.coalesce(F.sum("slots").over(upto), F.lit(0)))
    cut = F.least("slots", F.col("needed") - F.col("first"))
    return placed.join(needed, "place").select("shard", "place", "first", cut.alias("slots")).where("slots > 0")


def mapped(draws: DataFrame, runs: list[dict], block: int) -> DataFrame:
    """shard, place, pass, block, words: every slot with its block and the words it takes of it at most."""
    blocks, keys, slots, cuts = (np.array([run[name] for run in runs], dtype=np.int64) for name in ("blocks", "key", "slots", "cut"))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place, slot = batch["place"].to_numpy(), batch["slot"].to_numpy()
            turn = slot // blocks[place]
            chosen = permuted(slot % blocks[place], blocks[place], keys[place] + turn)
            words = np.where((slot == slots[place] - 1) & (cuts[place] > 0), cuts[place], block)
            yield pd.DataFrame({"shard": batch["shard"], "place": place, "pass": turn, "block": chosen, "words": words})

    each = draws.select("shard", "place", F.explode(F.expr("sequence(first, first + slots - 1)")).alias("slot"))
    return each.mapInPandas(index, "shard long, place int, pass long, block long, words long")


def mixed(
    documents: DataFrame, weight=cycled, seed: int = 6, block: int = BLOCK, shard_slots: int = SHARD_SLOTS
) -> tuple[DataFrame, DataFrame]:
    """Mixes ``documents`` (row_id, source, size, and what else they hold).

    Returns the documents with source_size and target, and the picks: row_id, shard, pass, from_word, words.
    """
    spark = documents.sparkSession
    sources = source_table(documents, weight)
    if not sources:
        empty = spark.createDataFrame([], "row_id long, shard long, pass long, from_word long, words long")
        return documents.select("*", F.lit(None).cast("long").alias("source_size"), F.lit(None).cast("double").alias("target")), empty
    table = spark.createDataFrame([tuple(source.values()) for source in sources], "place int, of string, source_size long, target double")
    placed = documents.join(table, F.expr("source <=> of")).drop("of")
    runs = [_passes(source, seed, block) for source in sources]
    slots = mapped(drawn(spark, [run["slots"] for run in runs], seed, shard_slots), runs, block)
    sized = placed.select("row_id", "place", "size").where("size > 0")
    laid = positions(sized, "place", "size", documents.count(), seed)
    at = F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block")
    pieces = laid.select("row_id", "place", "start", "size", at).select(
        "row_id",
        "place",
        "block",
        F.greatest(F.lit(0), F.col("start") - F.col("block") * block).alias("offset"),
        F.greatest(F.lit(0), F.col("block") * block - F.col("start")).alias("from_word"),
        F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block).alias("end"),
        "start",
    )
    length = F.col("end") - F.col("start") - F.col("from_word")
    picks = slots.join(pieces, ["place", "block"]).select(
        "row_id", "shard", "pass", "from_word", F.least(length, F.col("words") - F.col("offset")).alias("words")
    )
    return placed.drop("place"), picks.where("words > 0")


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_report(documents: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    heads = numbered(documents, "heads", "doc_id", "source", word_count("text").alias("size"))
    placed, picks = mixed(heads, **options)
    taken = picks.groupBy("row_id").agg(F.sum("words").alias("taken"))
    return placed.join(taken, "row_id", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


@F.pandas_udf(StringType())
def _passage(texts: pd.Series, runs: pd.Series) -> pd.Series:
    """The words of each run (first word, words), with the white space between them; runs are parted by a line end."""
    word, out = re.compile(WORD), []
    for text, pieces in zip(texts, runs, strict=True):
        if text is None:
            out.append(None)
            continue
        spans, parts, end = [match.span() for match in word.finditer(text)], [], None
        for piece in sorted((int(piece["from_word"]), int(piece["words"])) for piece in pieces):
            if end is not None and piece[0] == end:
                parts[-1][1] = sum(piece)
            else:
                parts.append([piece[0], sum(piece)])
            end = sum(piece)
        out.append("\n".join(text[spans[first][0] : spans[last - 1][1]] for first, last in parts))
    return pd.Series(out, dtype=object)


def mix_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix as documents: one row, with all columns, for each pass that takes words of a document.

    A pass that takes the whole document keeps its text as it is; one that takes some of its blocks has these blocks as
    its text, and their length as n_chars.
    """
    heads = numbered(documents, "heads", row_key(), "source", word_count("text").alias("size"))
    _, picks = mixed(heads, **options)
    runs = picks.groupBy("row_id", "pass").agg(F.sum("words").alias("taken"), F.collect_list(F.struct("from_word", "words")).alias("runs"))
    own = unused("mixed", documents.columns)
    whole_of, runs_of, passage_of = (f"{own}_{name}" for name in ("whole", "runs", "passage"))
    runs = runs.join(heads.select("row_id", "row_key", "size"), "row_id").select("row_key", (F.col("taken") == F.col("size")).alias(whole_of), F.col("runs").alias(runs_of))
    # Rows of one key are one text; each has its own runs.
    keys = heads.groupBy("row_key").agg(F.lit(True).alias("stays"), F.count("*").alias("n"))
    joined = by_key(one_per_key(documents, keys.where("n > 1")), runs, "inner")
    passage = _passage(F.when(~F.col(whole_of), F.col("text")), F.when(~F.col(whole_of), F.col(runs_of)))
    joined = joined.withColumn(passage_of, passage).withColumn("text", F.coalesce(passage_of, "text"))
    if "n_chars" in documents.columns:
        joined = joined.withColumn("n_chars", F.when(F.col(whole_of), F.col("n_chars")).otherwise(F.length("text")).cast("long"))
    return joined.select(*[f"`{column}`" for column in documents.columns])
