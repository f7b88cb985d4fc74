"""Quality rules with risk-controlled thresholds.

Base: counts over the whole text, and ``base_failed`` for texts of fewer than ``LEAST_WORDS`` words or with more than half
of their words in repeated three-word windows. On top, each rule of ``RULES`` rejects a document whose measure lies above
a cutoff. Cutoffs come from labelled documents: for every stratum (lang; null is its own) and rule, a grid of cutoffs is
tested from the most lenient to the strictest, and is certified while the exact binomial test rejects, at its level, that
the rule would turn away more than its share of the stratum's good documents (this is the Clopper-Pearson bound). Of the
certified cutoffs the most useful against documents labelled bad is taken. The grid is a fixed sequence, so all certified
cutoffs hold together and need no correction within a rule; across rules and strata the level is divided by their
number (Bonferroni), and the allowed rejection of ``RISK`` per stratum is divided by the number of rules. So, with
confidence 1 - ``DELTA`` over all strata together, no stratum loses more than ``RISK`` of its good documents to the rules.
Strata with too few labels get no cutoff and reject nothing.

Good: labelled with quality 1 and not base_failed (bad: with 0). The bound asks for independent rows, so each text of a
stratum counts once, however many documents and labels it has, as good if any label says so.
Counts for the tests are made over all labelled texts, as histograms. A null text has no words. Documents without
words have measures of 0. Rows that repeat are judged alike; empty tables give empty results; without labels the verdict
is that of the base.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.llm.common import written

LEAST_WORDS = 50
#: Characters that count as symbols (fixed value).
SYMBOLS = b"#*$%&|<>"
#: Words of a window.
REPEAT_WINDOW = 3
#: Largest share of good documents that the rules may turn away in a stratum, and the chance of that being exceeded.
RISK, DELTA = 0.02, 0.05
#: Measures in 0..1, and the cutoffs tested, as 1/GRID, from GRID down.
RULES = ("symbols", "dup_lines", "repeats", "capitals", "long_words")
GRID = 50
#: Bad documents that must go for one good one.
GOOD_WEIGHT = 10
#: Words whose numbers a task remembers.
CACHE_WORDS = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def measure(text: str | None, numbers: _Numbers) -> tuple:
    """The counts of ``COUNTS`` and the measures of ``RULES``."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS) + (0.0,) * len(RULES)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, _SPACE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeated = 0
    if n > REPEAT_WINDOW:
        ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
        size = len(numbers)
        if size < 1 << 21:  # three numbers fit a long
            windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
        else:
            pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1].astype(np.int64)
            windows = pairs[:-1] * size + ids[2:]
        order = np.argsort(windows, kind="stable")
        ordered = windows[order]
        equal = ordered[1:] == ordered[:-1]
        often = np.zeros(len(windows), bool)
        often[order[1:][equal]] = True
        often[order[:-1][equal]] = True
        covered = np.zeros(n, bool)
        for k in range(REPEAT_WINDOW):
            covered[k : k + len(often)] |= often
        repeated = int(covered.sum())
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    long_words = sum(len(word) > 30 for word in words)
    return (
        n,
        word_chars,
        symbols,
        dup_lines,
        repeated,
        min(1.0, symbols / n),
        dup_lines / len(lines),
        repeated / n,
        capitals / letters if letters else 0.0,
        long_words / n,
    )


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, lang, a hash of the text, the counts and the measures of every row."""
    names = [*COUNTS, *RULES]
    kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                rows.append(measure(text.as_py(), numbers))
                if len(numbers) > CACHE_WORDS:
                    numbers.clear()
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names=["doc_id", "lang", "text_hash", *names])

    schema = "doc_id long, lang string, text_hash long, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{r} double" for r in RULES])
    return documents.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def _beta_share(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction (for x below (a + 1) / (a + b + 2))."""
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x)) / a
    tiny, value, upper, lower = 1e-300, 1.0, 1.0, 0.0
    for step in range(20_000):
        half = step // 2
        if step == 0:
            part = 1.0
        elif step % 2:
            part = -(a + half) * (a + b + half) * x / ((a + 2 * half) * (a + 2 * half + 1))
        else:
            part = half * (b - half) * x / ((a + 2 * half - 1) * (a + 2 * half))
        lower = 1 / ((1 + part * lower) or tiny)
        upper = (1 + part / upper) or tiny
        value *= upper * lower
        if step and abs(1 - upper * lower) < 1e-14:
            break
    return front * (value - 1)


def tail(hits: int, n: int, share: float) -> float:
    """P(at most ``hits`` of ``n``) when each has the chance ``share``: an incomplete beta function, whatever ``hits`` is."""
    if hits >= n:
        return 1.0
    a, b = n - hits, hits + 1
    if 1 - share < (a + 1) / (a + b + 2):
        return min(1.0, _beta_share(a, b, 1 - share))
    return max(0.0, 1 - _beta_share(b, a, share))


def certified(hits: int, n: int, share: float, level: float) -> bool:
    """Whether ``hits`` of ``n`` show, at ``level``, a chance of at most ``share``."""
    return hits <= n * share and tail(hits, n, share) <= level


def cutoff(good: np.ndarray, bad: np.ndarray, share: float, level: float) -> int | None:
    """The certified grid cutoff that turns away most bad documents, with good ones counting ``GOOD_WEIGHT`` times against.

    ``good`` and ``bad`` count documents by ceil(measure * GRID); a cutoff c turns away measures above c / GRID. Of equally
    useful cutoffs the middle one is taken; None if no certified one is of use.
    """
    n, certain = int(good.sum()), []
    good_above, bad_above = n - np.cumsum(good), int(bad.sum()) - np.cumsum(bad)
    for at in range(GRID - 1, -1, -1):
        if n == 0 or not certified(int(good_above[at]), n, share, level):
            break
        certain.append(at)
    if not certain:
        return None
    use = [int(bad_above[at]) - GOOD_WEIGHT * int(good_above[at]) for at in certain]
    best = [at for at, value in zip(certain, use, strict=True) if value == max(use)]
    return best[len(best) // 2] if max(use) > 0 else None


def cutoffs(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, rule, cutoff) for every stratum and rule that has one."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    steps = F.array(*[F.struct(F.lit(i).alias("rule"), F.ceil(F.col(rule) * GRID).cast("int").alias("step")) for i, rule in enumerate(RULES)])
    labelled = measured.where("not base_failed").join(known, "doc_id")
    texts = labelled.groupBy("lang", "text_hash").agg(F.max("quality").alias("quality"), *[F.max(rule).alias(rule) for rule in RULES])
    judged = texts.select("lang", (F.col("quality") == 1).alias("good"), F.explode(steps).alias("at"))
    histogram = written(judged.groupBy("lang", "at.rule", "at.step", "good").agg(F.count("*").alias("n")), "histogram")
    strata = histogram.select("lang").distinct().count()
    share, level = RISK / len(RULES), DELTA / max(1, strata * len(RULES))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((2, GRID + 1), np.int64)
        np.add.at(counts, (pdf["good"].to_numpy().astype(int), pdf["step"].to_numpy()), pdf["n"].to_numpy())
        at = cutoff(counts[1], counts[0], share, level)
        found = [(pdf["lang"].iloc[0], int(pdf["rule"].iloc[0]), at)] if at is not None else []
        return pd.DataFrame(found, columns=["lang", "rule", "cutoff"])

    return histogram.groupBy("lang", "rule").applyInPandas(choose, "lang string, rule int, cutoff int")


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept, broken (the rules that turn it away)."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = written(measures(documents).withColumn("base_failed", failed), "measures")
    chosen = cutoffs(measured, labels)
    table = chosen.groupBy(F.col("lang").alias("stratum")).pivot("rule", list(range(len(RULES)))).agg(F.first("cutoff"))
    table = table.withColumnsRenamed({str(i): f"cut_{rule}" for i, rule in enumerate(RULES)})
    joined = measured.join(table, F.expr("lang <=> stratum"), "left")
    broken = F.array_compact(F.array(*[F.when(F.ceil(F.col(rule) * GRID) > F.col(f"cut_{rule}"), F.lit(rule)) for rule in RULES]))
    return joined.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.size(broken) == 0)).alias("kept"), broken.alias("broken"))
