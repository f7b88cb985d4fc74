"""Periodic runs of words, by catching squares online over dyadic blocks.

A run is a longest stretch of words with a smallest period q that holds for at least two periods. Words are appended in
spans. At each level k the words so far are cut into completed blocks of 2**k words, and every block is a catcher of the
periods from 2 * 2**k up to 4 * 2**k - 1 (at level 0 also of 1): each appended word compares the suffix of 2**k words that
it ends with the two catchers that lie so far back. Two copies of a square's first half at distance q always hold such
a block, so no square is missed, and a word costs two comparisons a level. A catch is watched: its equal stretch grows to
the left at once and to the right as words come; when it reaches q words, a square is there, and where it ends, the
squares it went through have merged into one run. Of catches of one stretch the smallest period stays.

Suffixes are compared by differences of one running polynomial sum modulo 2**61 - 1. Unequal sums prove unequal words,
equal ones stand for unequal words with a chance of at most (words of the text) / 2**61; every run that is reported is
compared word by word, and one that fails is extended word by word instead. Working memory is a few numbers a word of the
longest text, whatever the number of levels.

A null text has no words; texts without words have no run and stay empty. Every row is judged by itself, so repeated rows,
ties, empty tables, null ids and other columns change nothing. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketframe.functions.text import bind
from docketframe.llm.common import WORD

#: Least number of words of a run.
LEAST_WORDS = 12
#: Words appended at a time; shorter texts go together.
SPAN = 1 << 16
#: Bytes of text whose words are held at a time.
PORTION = 1 << 21
#: Words whose numbers a task remembers.
CACHE_WORDS = 1 << 20
#: Modulus and base of the running sum.
PRIME, BASE = np.uint64((1 << 61) - 1), 0x1E3779B97F4A7C15
RUNS = "array<struct<start:long,length:long,period:long>>"
_NONE = np.empty(0, np.int64)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products modulo the prime, by halves that fit 64 bits."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    x_high, x_low, y_high, y_low = x >> half, x & low, y >> half, y & low
    middle = x_low * y_high + x_high * y_low
    upper = x_high * y_high * np.uint64(2) + (middle >> np.uint64(30))
    return _reduced(upper + ((middle & np.uint64((1 << 30) - 1)) << half) + x_low * y_low)


def _running(x: np.ndarray) -> np.ndarray:
    """Running sums modulo the prime."""
    high, low = np.cumsum(x >> np.uint64(31)), np.cumsum(x & np.uint64((1 << 31) - 1))
    return _reduced(_times(_reduced(high), np.array([1 << 31], np.uint64)) + _reduced(low))


def _powers(size: int) -> np.ndarray:
    """The powers of the base from 0 to ``size``."""
    powers = np.ones(1, np.uint64)
    while len(powers) <= size:
        powers = np.concatenate([powers, _times(powers, np.array([pow(BASE, len(powers), int(PRIME))], np.uint64))])
    return powers[: size + 1]


def _minus(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.where(x >= y, x - y, x + PRIME - y)


class Catchers:
    """Runs of a growing sequence of ``size`` words in all, in which none reaches over more than ``longest`` words."""

    def __init__(self, size: int, longest: int):
        self.ids = np.empty(size, np.int64)
        self.sums = np.zeros(size + 1, np.uint64)
        self.powers = _powers(size)
        self.size, self.longest = 0, longest
        self.steps = [1 << k for k in range(max(1, longest).bit_length() - 1, -1, -1)]
        #: Watched stretches that the last word may still extend: first word, end, period, place of the catch.
        self.watched = np.empty((4, 0), np.int64)
        self.closed: list[np.ndarray] = []

    def _equal(self, at: np.ndarray, period: np.ndarray, length: int) -> np.ndarray:
        """Whether ``length`` words at ``at`` come again ``period`` words on."""
        sums, later = self.sums, at + period
        return _times(_minus(sums[at + length], sums[at]), self.powers[period]) == _minus(sums[later + length], sums[later])

    def _grown(self, end: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How far the equal stretches reach to the right in the words so far."""
        end = end.copy()
        for step in self.steps:
            fits = np.flatnonzero(end + period + step <= self.size)
            end[fits[self._equal(end[fits], period[fits], step)]] += step
        return end

    def _grown_back(self, start: np.ndarray, period: np.ndarray) -> np.ndarray:
        start = start.copy()
        for step in self.steps:
            fits = np.flatnonzero(start >= step)
            start[fits[self._equal(start[fits] - step, period[fits], step)]] -= step
        return start

    def append(self, ids: np.ndarray) -> None:
        """Takes the next words, grows what is watched and catches what is new."""
        old, new = self.size, self.size + len(ids)
        self.ids[old:new] = ids
        # Numbers of words start at 1; those that part texts are negative and end up at the far end of the range.
        codes = np.where(ids >= 0, ids + 1, int(PRIME) + ids).astype(np.uint64)
        self.sums[old + 1 : new + 1] = _reduced(_running(_times(codes, self.powers[old:new])) + self.sums[old])
        self.size = new
        start, end, period, place = self.watched
        watched = [np.stack([start, self._grown(end, period), period, place])]
        known = watched[0][:, np.argsort(period, kind="stable")]
        level = 0
        while level == 0 or 2 << level <= self.longest // 2:
            watched.append(self._caught(level, max(0, old + 1 - (1 << level)), known))
            level += 1
        every = np.concatenate(watched, axis=1)
        every = every[:, np.unique(every[:3], axis=1, return_index=True)[1]]
        still = every[1] + every[2] == new
        self.watched = every[:, still]
        self.closed.append(every[:, ~still & (every[1] - every[0] >= every[2])])

    def _caught(self, level: int, first: int, known: np.ndarray) -> np.ndarray:
        """New watches by the suffixes of 2**level words from ``first`` on."""
        block = 1 << level
        suffix = np.arange(first, self.size - block + 1)
        places, periods = [_NONE], [_NONE]
        for back in (1, 2, 3) if level == 0 else (2, 3):
            late = suffix[np.searchsorted(suffix, back << level) :]
            catcher = ((late >> level) - back) << level
            hit = self._equal(catcher, late - catcher, block)
            first_of_chain = hit.copy()  # the catcher before caught the same stretch
            first_of_chain[block:] &= ~hit[:-block]
            places.append(catcher[first_of_chain])
            periods.append((late - catcher)[first_of_chain])
        place, period = np.concatenate(places), np.concatenate(periods)
        if known.size and place.size:  # the words up to here end one stretch for a period at most
            at = np.minimum(np.searchsorted(known[2], period), known.shape[1] - 1)
            inside = (known[2][at] == period) & (known[0][at] <= place) & (known[1][at] >= place + block)
            place, period = place[~inside], period[~inside]
        return np.stack([self._grown_back(place, period), self._grown(place + block, period), period, place])

    def _exact(self, place: int, period: int) -> tuple[int, int] | None:
        """The stretch around a catch, word by word."""
        ids = self.ids[: self.size]
        if place + period >= len(ids) or ids[place] != ids[place + period]:
            return None
        differ = np.flatnonzero(ids[:-period] != ids[period:])
        at = int(np.searchsorted(differ, place))
        return int(differ[at - 1]) + 1 if at else 0, int(differ[at]) if at < len(differ) else len(ids) - period

    def runs(self, least: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of all runs of ``least`` words or more, by start, then period."""
        ids = self.ids[: self.size]
        start, end, period, place = np.concatenate([*self.closed, self.watched], axis=1)
        length = end - start + period
        fits = np.flatnonzero((end - start >= period) & (length >= least))
        by_stretch: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for i in fits[np.argsort(period[fits], kind="stable")].tolist():
            by_stretch.setdefault((int(start[i]), int(start[i] + length[i])), []).append((int(period[i]), int(place[i])))
        found: dict[tuple[int, int], int] = {}
        for (first, last), catches in by_stretch.items():
            for q, at in catches:
                if np.array_equal(ids[first : last - q], ids[first + q : last]):
                    found[first, last] = min(q, found.get((first, last), q))
                    break
                exact = self._exact(at, q)
                if exact and exact[1] - exact[0] >= q and exact[1] - exact[0] + q >= least:
                    key = (exact[0], exact[1] + q)
                    found[key] = min(q, found.get(key, q))
        return sorted((first, last, q) for (first, last), q in found.items())


def runs_of(texts: list[np.ndarray], least: int = LEAST_WORDS, span: int = SPAN) -> list[list[tuple[int, int, int]]]:
    """For each text, as numbers of words, its runs as (start, length, period) by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i, ids in enumerate(texts) if len(ids) >= least), key=lambda i: len(texts[i]))
    group: list[int] = []
    words = 0
    for turn, i in enumerate(order):
        group.append(i)
        words += len(texts[i]) + 1
        if turn + 1 < len(order) and words + len(texts[order[turn + 1]]) < span:
            continue
        # Texts that go together are parted by numbers that no word has.
        parted = np.concatenate([part for at, j in enumerate(group) for part in (texts[j], np.array([-1 - at]))])
        catchers = Catchers(len(parted), len(texts[i]))
        for at in range(0, len(parted), span):
            catchers.append(parted[at : at + span])
        starts = np.cumsum([0] + [len(texts[j]) + 1 for j in group])
        for first, last, period in catchers.runs(least):
            own = int(np.searchsorted(starts, first, side="right")) - 1
            found[group[own]].append((first - int(starts[own]), last - first, period))
        group, words = [], 0
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words of a text without those that a run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.cumsum(edges)[:-1] == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``PORTION`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PORTION, side="right")))
        yield batch.slice(at, end - at)
        at = end


def find_runs(documents: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """For every row of ``documents`` (doc_id, text): doc_id, runs (by start, then period), collapsed (the text without repeats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for batch in chain.from_iterable(map(_portions, batches)):
            split = [(text.as_py() or "").encode().split() for text in batch["text"]]
            if len(numbers) > CACHE_WORDS:
                numbers.clear()
            texts = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in split]
            runs = runs_of(texts, least)
            kept = [collapsed(words, own).decode() for words, own in zip(split, runs, strict=True)]
            rows = [[{"start": a, "length": b, "period": c} for a, b, c in own] for own in runs]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, kind), pa.array(kept, pa.string())], names=["doc_id", "runs", "collapsed"])

    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed string")


def run_report(documents: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Per row: doc_id, n_runs, the longest run (ties: smallest start, then period), digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = find_runs(documents, least).withColumn("best", best)
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda each: F.concat(each, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def with_repeated_ends(documents: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the rows, chosen by the id, the words from some place on repeat a stretch of words.

    With h = crc32 of the decimal doc_id, g = h div 10 and n words: where h mod 10 = 0, each word i >= a = g mod n
    becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Null ids and texts without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))

    def repeated(row: Column) -> Column:
        a, n, words = row["a"], row["n"], row["words"]
        period = 1 + F.floor((n - a) / (3 + row["g"] % 8)).cast("int")
        return F.array_join(F.transform(words, lambda word, i: F.when(i < a, word).otherwise(F.get(words, a + F.pmod(i - a, period)))), " ")

    words = F.regexp_extract_all("text", F.lit(f"({WORD})"))
    bound = bind(words, lambda w: F.struct(w.alias("words"), F.size(w).alias("n"), F.floor(h / 10).alias("g"), (F.floor(h / 10) % F.greatest(F.size(w), F.lit(1))).cast("int").alias("a")))
    return documents.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), bind(bound, repeated)).otherwise(F.col("text")).alias("text"))
