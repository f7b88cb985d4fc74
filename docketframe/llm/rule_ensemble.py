"""Quality classifier: a sparse ensemble of rules over text statistics, run as Spark column expressions.

``STATISTICS`` are measured over the whole text of every document. Small trees are boosted on a sample of labelled rows
(``SAMPLE_ROWS`` at most, by a hash of the id); the path to each of their nodes is a rule, a conjunction of intervals of
statistics. A logistic regression with an absolute-value (lasso) penalty gives most rules the weight 0; of a falling
sequence of penalties the one is taken whose loss is least on a quarter of the sample that trees and weights have not seen.
The rules that keep a weight are compiled into one column expression, which scores all documents in the JVM.

Learned from are labels (doc_id, quality) of rows outside the held-out fold (crc32 of doc_id as text, modulo 4, is 2). Of a
document's several labels the majority counts, for quality 1 in a tie; null qualities and ids are passed over. Of rows with
one id, one is learned from. A null text counts as empty; texts without words have all statistics 0 and get a score like
any other. Without labels of both kinds the score is the (smoothed) share of label 1 for all. Rows that repeat score
alike; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketframe.llm.common import written

#: Labelled rows learned from.
SAMPLE_ROWS = 8192
#: Trees, their depth, the share of rows each sees, the part of a tree's answer that is added.
TREES, DEPTH, SHARE, RATE = 60, 3, 0.6, 0.15
#: Cuts tried for a statistic; least rows of a node.
CUTS, LEAST_ROWS = 24, 8
#: Penalties tried, as parts of the least one that silences all rules; steps for each.
PENALTIES, STEPS = tuple(0.5 * 0.7**k for k in range(16)), 150
#: The least score of a document predicted as good.
GOOD = 0.7
FOLDS, HELD_OUT = 4, 2
#: Words whose numbers a task remembers.
CACHE_WORDS = 1 << 20

STATISTICS = (
    "words",
    "word_length",
    "longest_word",
    "symbols",
    "shouts",
    "digits",
    "capitals",
    "letters",
    "bare_words",
    "top_word",
    "new_words",
    "stutter",
    "repeats",
    "lines",
    "line_words",
    "repeated_lines",
    "ended_lines",
    "density",
    "entropy",
)
_SPACE = b" \t\n\x0b\x0c\r"
_LETTERS = bytes(b for b in range(256) if b >= 128 or chr(b).isalpha())
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#$%&*+<=>@[\\]^_`{|}~"
_ENDS = (b".", b"!", b"?", b":", b'"', b")")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def statistics(text: str | None, numbers: _Numbers) -> tuple[float, ...]:
    """The values of ``STATISTICS``; lengths in bytes."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    solid = len(raw) - (len(raw) - len(raw.translate(None, _SPACE)))
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    letters = count(_LETTERS)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    ordered = np.sort(ids)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    often = np.diff(np.append(starts, n))
    pairs = np.sort(ids[:-1] * np.int64(1 << 31) + ids[1:])
    lines = [line for line in raw.split(b"\n") if line.strip()]
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    shares = shares[shares > 0]
    lengths = list(map(len, words))
    return (
        float(n),
        solid / n,
        float(max(lengths)),
        count(_SYMBOLS) / solid,
        raw.count(b"!") / n,
        count(_DIGITS) / solid,
        count(_CAPITALS) / max(1, letters),
        letters / solid,
        sum(not word.strip(_SYMBOLS + b".,;:!?-/()'\"") for word in words) / n,
        float(often.max()) / n,
        len(starts) / n,
        float((ids[1:] == ids[:-1]).sum()) / n,
        float((pairs[1:] == pairs[:-1]).sum()) / n,
        float(len(lines)),
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(line.rstrip().endswith(_ENDS) for line in lines) / len(lines),
        len(zlib.compress(raw, 1)) / len(raw),
        float(-(shares * np.log2(shares)).sum()),
    )


def measured(documents: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                rows.append(statistics(text.as_py(), numbers))
                if len(numbers) > CACHE_WORDS:
                    numbers.clear()
            table = np.array(rows, np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array(column) for column in table.T]], names=["doc_id", *STATISTICS])

    schema = "doc_id long, " + ", ".join(f"{name} double" for name in STATISTICS)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction: each statistic of ``bounds`` (its place, low, high) lies above low and not above high."""

    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, table: np.ndarray) -> np.ndarray:
        held = np.ones(len(table), bool)
        for at, low, high in self.bounds:
            held &= (table[:, at] > low) & (table[:, at] <= high)
        return held

    def column(self) -> Column:
        tests = []
        for at, low, high in self.bounds:
            if low > -np.inf:
                tests.append(F.col(STATISTICS[at]) > low)
            if high < np.inf:
                tests.append(F.col(STATISTICS[at]) <= high)
        return reduce(Column.__and__, tests)

    def __str__(self) -> str:
        parts = []
        for at, low, high in self.bounds:
            parts += [f"{STATISTICS[at]} > {low:.4g}"] if low > -np.inf else []
            parts += [f"{STATISTICS[at]} <= {high:.4g}"] if high < np.inf else []
        return " and ".join(parts)


def _within(bounds: tuple, at: int, low: float, high: float) -> tuple:
    """The bounds of a path with one more test."""
    known = {place: (a, b) for place, a, b in bounds}
    a, b = known.get(at, (-np.inf, np.inf))
    known[at] = (float(max(a, low)), float(min(b, high)))
    return tuple((place, *known[place]) for place in sorted(known))


def _cuts(column: np.ndarray) -> np.ndarray:
    """Cuts halfway between neighbouring quantiles that differ."""
    marks = np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 2), method="nearest"))
    return (marks[1:] + marks[:-1]) / 2


def grow(table: np.ndarray, binned: np.ndarray, cuts: list[np.ndarray], pull: np.ndarray, bend: np.ndarray, rows: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """One tree on ``rows`` by first and second slopes of the loss: the rules of its nodes, and its answer for all rows."""
    rules, answer = [], np.zeros(len(table))
    nodes = [((), rows, np.arange(len(table)))]
    for depth in range(DEPTH + 1):
        below = []
        for bounds, own, reached in nodes:
            total, weight = pull[own].sum(), bend[own].sum() + 1.0
            if depth:
                rules.append(Rule(bounds))
            best, where = 1e-9, None
            if depth < DEPTH and len(own) >= 2 * LEAST_ROWS:
                for at, own_cuts in enumerate(cuts):
                    if not len(own_cuts):
                        continue
                    size = len(own_cuts) + 1
                    bins = binned[own, at]
                    left, left_weight, left_rows = (np.cumsum(np.bincount(bins, values, size))[:-1] for values in (pull[own], bend[own], None))
                    gain = left**2 / (left_weight + 1) + (total - left) ** 2 / (weight - left_weight) - total**2 / weight
                    gain[(left_rows < LEAST_ROWS) | (len(own) - left_rows < LEAST_ROWS)] = 0
                    if gain.max() > best:
                        best, where = gain.max(), (at, int(gain.argmax()))
            if where is None:
                answer[reached] = total / weight
                continue
            at, cut = where
            for low, high, side in ((-np.inf, cuts[at][cut], True), (cuts[at][cut], np.inf, False)):
                below.append((_within(bounds, at, low, high), own[(binned[own, at] <= cut) == side], reached[(binned[reached, at] <= cut) == side]))
        nodes = below
    return rules, answer


def extract(table: np.ndarray, label: np.ndarray) -> list[Rule]:
    """The rules of boosted trees, those that hold for the same rows once."""
    cuts = [_cuts(column) for column in table.T]
    binned = np.stack([np.searchsorted(own, column) for own, column in zip(cuts, table.T, strict=True)], axis=1)
    rng = np.random.default_rng(13)
    share = label.mean()
    margin, found = np.full(len(table), log(share / (1 - share))), {}
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        rows = rng.permutation(len(table))[: max(2 * LEAST_ROWS, int(SHARE * len(table)))]
        rules, answer = grow(table, binned, cuts, label - chance, chance * (1 - chance), rows)
        margin = np.clip(margin + RATE * answer, -8, 8)
        for rule in rules:
            held = rule.holds(table)
            if LEAST_ROWS <= held.sum() <= len(table) - LEAST_ROWS:
                found.setdefault(held.tobytes(), rule)
    return list(found.values())


def steepest(held: np.ndarray) -> float:
    """A safe bound of the loss's second slope in any direction, by power steps."""
    way = np.ones(held.shape[1] + 1)
    size = 1.0
    for _ in range(30):
        answer = held @ way[:-1] + way[-1]
        way = np.append(held.T @ answer, answer.sum())
        size = np.linalg.norm(way)
        way /= size
    return 1.1 * size / (4 * len(held))


def lasso(held: np.ndarray, label: np.ndarray, penalty: float, weights: np.ndarray, bias: float, step: float) -> tuple[np.ndarray, float]:
    """Logistic weights under an absolute-value penalty, by accelerated proximal steps from ``weights`` on."""
    n = len(label)
    ahead, ahead_bias, turn = weights, bias, 1.0
    for _ in range(STEPS):
        off = 1 / (1 + np.exp(-np.clip(held @ ahead + ahead_bias, -30, 30))) - label
        moved = ahead - step * (held.T @ off) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_bias = ahead_bias - step * off.mean()
        next_turn = (1 + (1 + 4 * turn * turn) ** 0.5) / 2
        part = (turn - 1) / next_turn
        ahead, ahead_bias, turn = new + part * (new - weights), new_bias + part * (new_bias - bias), next_turn
        weights, bias = new, new_bias
    return weights, float(bias)


def _losses(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, np.where(label == 1, -margin, margin))


@dataclass
class Ensemble:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def scores(self, table: np.ndarray) -> np.ndarray:
        margin = np.full(len(table), self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            margin += weight * rule.holds(table)
        return 1 / (1 + np.exp(-margin))

    def score(self) -> Column:
        """The score as a column over the statistics."""
        parts = [F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in zip(self.rules, self.weights, strict=True)]
        return 1 / (1 + F.exp(-reduce(Column.__add__, parts, F.lit(self.bias))))

    def reasons(self) -> Column:
        """The rules that hold and lower the score, the heaviest first."""
        against = sorted((weight, str(rule), rule) for rule, weight in zip(self.rules, self.weights, strict=True) if weight < 0)
        if not against:
            return F.array().cast("array<string>")
        return F.array_compact(F.array(*[F.when(rule.column(), F.lit(name)) for _, name, rule in against]))


def fit(table: np.ndarray, label: np.ndarray) -> Ensemble:
    """An ensemble from the statistics and labels (0 or 1) of the sample."""
    if not 0 < label.sum() < len(label):
        share = (label.sum() + 1) / (len(label) + 2)
        return Ensemble([], [], float(np.log(share / (1 - share))))
    kept_out = np.arange(len(label)) % 4 == 3
    if len(label) < 40 or not 0 < label[~kept_out].sum() < (~kept_out).sum():
        kept_out[:] = False
    rules = extract(table[~kept_out], label[~kept_out])
    held = np.stack([rule.holds(table) for rule in rules], axis=1).astype(np.float64) if rules else np.empty((len(label), 0))
    spread = held[~kept_out].std(axis=0) + 1e-12
    scaled, wanted = held[~kept_out] / spread, label[~kept_out].astype(np.float64)
    share = wanted.mean()
    top = np.abs(scaled.T @ (wanted - share)).max() / len(wanted) if rules else 0.0
    weights, bias = np.zeros(len(rules)), log(share / (1 - share))
    path, losses, step = [], [], 1 / steepest(scaled)
    judged = kept_out if kept_out.any() else ~kept_out
    for part in PENALTIES:
        weights, bias = lasso(scaled, wanted, part * top, weights, bias, step)
        path.append((weights / spread, bias))
        losses.append(_losses(held[judged] @ path[-1][0] + bias, label[judged]))
    means = [own.mean() for own in losses]
    weights, bias = path[int(np.argmin(means))]
    used = np.flatnonzero(weights)
    return Ensemble([rules[i] for i in used], weights[used].tolist(), bias)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def chosen_labels(labels: DataFrame, rows: int) -> DataFrame:
    """doc_id and label of at most ``rows`` documents outside the held-out fold, by a hash of the id."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where("doc_id is not null and quality in (0, 1)")
    one_each = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    one_each = written(one_each, "labels")
    parts = 1 << 20
    share = int(min(1.0, 1.2 * rows / max(1, one_each.count())) * parts) + 1
    near = one_each.withColumn("deal", F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(parts))).where(F.col("deal") < share)
    first = Window.partitionBy(F.lit(0)).orderBy("deal", "doc_id")  # a little more than ``rows`` rows
    return near.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= rows).select("doc_id", "label")


def train(statistics_of: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Ensemble:
    """Learns from at most ``rows`` of the measured rows."""
    sample = statistics_of.join(F.broadcast(chosen_labels(labels, rows)), "doc_id")  # broadcast: ``rows`` rows at most
    sample = sample.groupBy("doc_id", "label").agg(F.min(F.struct(*STATISTICS)).alias("own")).select("doc_id", "label", "own.*")
    found = sample.toPandas().sort_values("doc_id")
    return fit(found[list(STATISTICS)].to_numpy(np.float64), found["label"].to_numpy(np.int64))


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, held_out, score (0 to 1), predicted, reasons (the rules against it)."""
    own = written(measured(documents), "statistics")
    ensemble = train(own, labels)
    scored = own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), ensemble.score().alias("score"), ensemble.reasons().alias("reasons"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"), "reasons")
