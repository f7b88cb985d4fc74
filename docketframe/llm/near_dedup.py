"""Near duplicates by MinHash with sequential Bayesian verification.

1. One pass over the texts gives each row the digest of its lower-cased words, its number of distinct shingles and a
   signature of ``BANDS * ROWS`` MinHash values of 16 bits. Rows with equal words form a class; one row stands for it.
2. Banded signatures bring classes together. In each band bucket every class is compared with one of them,
   chosen by a hash of class and band (a star, not all pairs; bands choose differently).
3. Verification is sequential: signatures are compared batch by batch, and a pair is given up as soon as the posterior
   probability of a similarity at or above the threshold (flat prior) is at most ``MISS``. Survivors are verified
   exactly on their full shingle sets.
4. Buckets whose classes still lie in several components are finished without listing pairs: the classes outside a
   bucket's main component ask all others, in blocks of signatures, and name the components in which some class may be
   similar; they are then verified against all classes of these components, in blocks of texts. So a bucket of many
   copies costs a star, and none of its links is lost.
5. Components of the verified links are found by pointing to the smallest neighbour and drawing the links anew.

A text with fewer words than a shingle has one shingle, the whole sequence; a text without words, or null, has none and
is linked with nothing. Empty tables give empty results; rows that repeat are members of one class; a null ``doc_id`` is
linked like any other and is a component's id only if it has no other. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import pairwise
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docketframe.llm.common import one_per_key, row_key, written

BANDS, ROWS = 36, 6
#: Signature values compared before each decision.
BATCH = 36
#: Largest chance, at each decision, of giving up a pair at the threshold.
MISS = 1e-5
#: Words whose hashes a task remembers.
CACHE_WORDS = 1 << 20
#: Classes, and shingles, that meet as one block.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 1 << 18
_BLOCK = 1024
_MULTIPLIERS = np.random.default_rng(20).integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of words."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(words: list[bytes], size: int) -> set[bytes]:
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*[words[i:] for i in range(size)], strict=False)))


def _shingle_hashes(words: list[bytes], size: int, hashes: _Words) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    with np.errstate(over="ignore"):
        out = h[: len(h) - size + 1].copy()
        for k in range(1, size):
            out = (out ^ (out >> np.uint64(29))) * _MIX + h[k : len(h) - size + 1 + k]
        out = (out ^ (out >> np.uint64(32))) * _MIX
    return np.unique(out ^ (out >> np.uint64(29)))


def _signature(shingles: np.ndarray) -> bytes:
    least = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), _BLOCK):
            np.minimum(least, (shingles[at : at + _BLOCK, None] * _MULTIPLIERS).min(axis=0), out=least)
        return ((least * _MIX) >> np.uint64(48)).astype("<u2").tobytes()


def sketches(documents: DataFrame, shingle_words: int, *carried) -> DataFrame:
    """doc_id, text_key, node (digest of the words; null without words), n_shingles, signature, and the columns ``carried``."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Words()
        for batch in batches:
            nodes, sizes, signatures = [], [], []
            for text in batch["text"]:
                words = (text.as_py() or "").encode().lower().split()
                shingles = _shingle_hashes(words, shingle_words, hashes)
                sizes.append(len(shingles))
                nodes.append(blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                signatures.append(_signature(shingles) if words else None)
                if len(hashes) > CACHE_WORDS:
                    hashes.clear()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())],
                names=[*batch.schema.names[:-1], "node", "n_shingles", "signature"],
            )

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), *carried, "text")
    schema = StructType(read.schema.fields[:-1]).add("node", "binary").add("n_shingles", "long").add("signature", "binary")
    return read.mapInArrow(sketch, schema)


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, matches needed to go on) for each batch.

    With a flat prior the posterior of the similarity after m matches of n is Beta(m + 1, n - m + 1), so the chance of
    at least ``threshold`` is that of at most m successes in n + 1 trials at ``threshold``.
    """
    steps = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        chance, m = 0.0, -1
        while chance <= miss:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        steps.append((n, m))
    return steps


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that neither their set sizes nor the posterior bounds rule out."""
    steps = least_matches(percent / 100)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch[name].to_pylist()), "<u2").reshape(batch.num_rows, -1) for name in ("sig_a", "sig_b")
            )
            alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, needed in steps:
                matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                stay = matches >= needed
                alive, matches, done = alive[stay], matches[stay], n
            chosen = pa.array(alive)
            yield pa.RecordBatch.from_arrays([batch["a"].take(chosen), batch["b"].take(chosen)], names=["a", "b"])

    a = classes.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("sig_a"))
    b = classes.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("sig_b"))
    near = (F.col("n_a") * percent <= F.col("n_b") * 100) & (F.col("n_b") * percent <= F.col("n_a") * 100)
    return pairs.join(a, "a").join(b, "b").where(near).select("a", "b", "sig_a", "sig_b").mapInArrow(compare, "a long, b long")


def _confirmed(pairs: DataFrame, classes: DataFrame, documents: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold. Only texts of their classes move."""
    texts = _texts(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))), classes, documents)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of = None, set()
        for batch in batches:
            keep = []
            for at, (a, left, right) in enumerate(zip(batch["a"].to_pylist(), batch["text_a"], batch["text_b"], strict=True)):
                if a != known:
                    known, of = a, shingle_set(left.as_py().encode().lower().split(), shingle_words)
                other = shingle_set(right.as_py().encode().lower().split(), shingle_words)
                common = len(of & other)
                if 100 * common >= percent * (len(of) + len(other) - common):
                    keep.append(at)
            chosen = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["a"].take(chosen), batch["b"].take(chosen)], names=["a", "b"])

    a = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(rep, label) for every end of a link: the smallest end that can be reached.

    In each round every class points to its smallest neighbour, pointers are shortened, and the links are drawn anew
    between the classes pointed to; so most links are gone after the first round.
    """
    edges, labels = written(links.select("a", "b"), "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "points")
        far = points.select(F.col("a").alias("to"), F.col("to").alias("far"))
        points = written(points.join(far, "to").select("a", F.col("far").alias("to")), "points")
        if labels is None:
            labels = points.select(F.col("a").alias("rep"), F.col("to").alias("label"))
        else:
            moved = points.select(F.col("a").alias("label"), F.col("to").alias("new"))
            labels = labels.join(moved, "label", "left").select("rep", F.coalesce("new", "label").alias("label"))
            labels = written(labels, "labels")
        ends = points.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        drawn = edges.join(points.withColumnRenamed("to", "to_a"), "a").join(ends, "b").where("to_a <> to_b")
        drawn = drawn.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        edges = written(drawn, "edges")
        if edges.isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links."""

    def end(name: str) -> DataFrame:
        return labels.select(F.col("rep").alias(name), F.col("label").alias(f"to_{name}"))

    between = links.join(end("a"), "a", "left").join(end("b"), "b", "left")
    between = between.select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b")).distinct()
    new = components(between).select(F.col("rep").alias("label"), F.col("label").alias("new"))
    old = labels.join(new, "label", "left").select("rep", F.coalesce("new", "label").alias("label"))
    # Ends that had no link before stand for themselves.
    alone = new.select(F.col("label").alias("rep"), F.col("new").alias("label")).join(labels.select("rep"), "rep", "left_anti")
    return written(old.unionByName(alone), "labels")


def _stars(entries: DataFrame, leaders: DataFrame) -> DataFrame:
    """Each class with the leader of each of its buckets."""
    met = entries.join(leaders.select("band", "leader"), "band").where("rep <> leader")
    return met.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """The rows of each ``key`` of a partition sorted by it, parted into those that ask and those that are asked."""
    rest = None

    def parted(run: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        return run[run["asks"]], run[~run["asks"]]

    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if rows.empty:
            continue
        keys = rows["key"].to_numpy()
        starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1)]
        for start, end in pairwise(starts):
            yield parted(rows.iloc[start:end])
        rest = rows.iloc[starts[-1] :]
    if rest is not None:
        yield parted(rest)


def _blocks(asked: DataFrame, asking: DataFrame, group: str, weight: str, most: int, *columns: str) -> DataFrame:
    """Both sides of every block pair of every ``group``, sorted by the key of the block pair.

    A group of weight w is dealt into w / ``most`` blocks on either side; each side goes to the blocks of the other.
    """

    def number(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(group).agg(F.ceil(F.sum(weight) / most).cast("long").alias(name))

    sizes = number(asked, "asked").join(number(asking, "asking"), group)

    def side(rows: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("rep"), F.col(own))
        spread = rows.join(sizes, group).withColumn("facing", F.explode(F.expr(f"sequence(0L, {other} - 1)")))
        pair = (block, F.col("facing")) if not asks else (F.col("facing"), block)
        return spread.select(F.xxhash64(group, *pair).alias("key"), F.lit(asks).alias("asks"), *columns)

    both = side(asked, "asked", "asking", False).unionByName(side(asking, "asking", "asked", True))
    return both.repartition("key").sortWithinPartitions("key")


def _suspected(entries: DataFrame, leaders: DataFrame, labels: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(rep, label): classes with the components, other than their own, where a bucket holds a plausible partner."""
    steps = least_matches(percent / 100)
    labelled = entries.join(leaders.where("n > 2").select("band"), "band", "left_semi").join(labels, "rep", "left")
    labelled = labelled.select("band", "rep", F.coalesce("label", "rep").alias("label"))
    counts = labelled.groupBy("band", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("band").agg(F.max_by("label", "n").alias("main"), F.count("*").alias("labels")).where("labels > 1")
    mixed = labelled.join(main.select("band", "main"), "band").join(classes.select("rep", "n_shingles", "signature"), "rep")
    mixed = written(mixed.withColumn("one", F.lit(1)), "mixed")
    blocks = _blocks(mixed, mixed.where("label <> main"), "band", "one", BLOCK_CLASSES, "rep", "label", "n_shingles", "signature")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for asking, asked in _runs(batches):
            found = set()
            theirs = np.frombuffer(b"".join(asked["signature"]), "<u2").reshape(len(asked), -1)
            their_labels, their_sizes = asked["label"].to_numpy(), asked["n_shingles"].to_numpy()
            for row in asking.itertuples():
                alive = np.flatnonzero(
                    (their_labels != row.label) & (their_sizes * percent <= row.n_shingles * 100) & (row.n_shingles * percent <= their_sizes * 100)
                )
                own, matches, done = np.frombuffer(row.signature, "<u2"), np.zeros(len(alive), np.int64), 0
                for n, needed in steps:
                    matches = matches + (theirs[alive, done:n] == own[done:n]).sum(axis=1)
                    stay = matches >= needed
                    alive, matches, done = alive[stay], matches[stay], n
                    if not len(alive):
                        break
                found.update((row.rep, int(label)) for label in np.unique(their_labels[alive]))
            if found:
                yield pd.DataFrame(sorted(found), columns=["rep", "label"])

    return blocks.mapInPandas(ask, "rep long, label long").distinct()


def _texts(reps: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """(rep, text) of the classes; no other text is handed on."""
    wanted = classes.join(reps.distinct(), "rep", "left_semi").select("rep", "member.doc_id", "member.text_key")
    keyed_texts = documents.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"), "text")
    return written(keyed_texts.join(wanted, F.expr("id <=> doc_id and key = text_key")).select("rep", "text").dropDuplicates(["rep"]), "texts")


def _links_across(suspected: DataFrame, labels: DataFrame, classes: DataFrame, documents: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(a, b): links between the classes of ``suspected`` (rep, label) and all classes of these components."""
    every = classes.select("rep", "n_shingles").join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    asked = every.join(suspected.select("label").distinct(), "label", "left_semi")
    asking = suspected.join(classes.select("rep", "n_shingles"), "rep")
    texts = _texts(asked.select("rep").unionByName(asking.select("rep")), classes, documents)
    blocks = _blocks(asked.join(texts, "rep"), asking.join(texts, "rep"), "label", "n_shingles", BLOCK_SHINGLES, "rep", "text")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for asking_rows, asked_rows in _runs(batches):
            numbers: dict[bytes, list[int]] = {}
            sizes = np.zeros(len(asked_rows), np.int64)
            for at, text in enumerate(asked_rows["text"]):
                shingles = shingle_set(text.encode().lower().split(), shingle_words)
                sizes[at] = len(shingles)
                for shingle in shingles:
                    numbers.setdefault(shingle, []).append(at)
            places = {shingle: np.array(found) for shingle, found in numbers.items()}
            reps = asked_rows["rep"].to_numpy()
            for row in asking_rows.itertuples():
                shingles = shingle_set(row.text.encode().lower().split(), shingle_words)
                found = [places[shingle] for shingle in shingles if shingle in places]
                common = np.bincount(np.concatenate(found), minlength=len(reps)) if found else np.zeros(len(reps), np.int64)
                linked = reps[(100 * common >= percent * (len(shingles) + sizes - common)) & (reps != row.rep)]
                if len(linked):
                    yield pd.DataFrame({"a": np.minimum(linked, row.rep), "b": np.maximum(linked, row.rep)})

    return blocks.mapInPandas(verify, "a long, b long").distinct()


def near_groups(documents: DataFrame, shingle_words: int = 5, percent: int = 80, *carried) -> DataFrame:
    """Every row of ``documents`` (doc_id, text): doc_id, n_shingles, component_id, kept, component, and ``carried``.

    ``component`` numbers the components; it is null without words.
    """
    rows = written(sketches(documents, shingle_words, *carried), "sketches")
    held = rows.columns[2:-3]
    classes = rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least_id"),
        F.min(F.struct("doc_id", "text_key")).alias("member"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    size = 2 * ROWS
    bands = [F.xxhash64(F.lit(i), F.expr(f"substring(signature, {i * size + 1}, {size})")) for i in range(BANDS)]
    entries = classes.select("rep", F.explode(F.array(*bands)).alias("band"))
    order = F.xxhash64("rep", "band")
    leaders = entries.groupBy("band").agg(F.min_by("rep", order).alias("leader"), F.count("*").alias("n"))
    leaders = written(leaders.where("n > 1"), "leaders")
    entries = written(entries.join(leaders.select("band"), "band", "left_semi"), "entries")
    likely = written(_plausible(_stars(entries, leaders), classes, percent), "likely")
    found = written(_confirmed(likely, classes, documents, shingle_words, percent), "links")
    labels = components(found)
    suspected = written(_suspected(entries, leaders, labels, classes, percent), "suspected")
    if not suspected.isEmpty():
        more = written(_links_across(suspected, labels, classes, documents, shingle_words, percent), "links")
        if not more.isEmpty():
            labels = merged(labels, more)
    labelled = classes.join(labels, "rep", "left").select("node", "least_id", F.coalesce("label", "rep").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    ids = written(labelled.join(least, "label").select("node", "component_id", F.col("label").alias("component")), "ids")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        rows.select("doc_id", "node", "n_shingles", *held)
        .join(ids, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
            "component",
            *held,
        )
    )


def one_of_each(documents: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents``, with all their columns, of which one per component is left: that of the smallest id."""
    groups = near_groups(documents, shingle_words, percent, row_key()).where("component is not null")
    rows = written(groups.groupBy("component", "row_key").agg(F.count("*").alias("n")), "groups")
    order = F.struct(F.col("row_key.doc_id").isNull(), "row_key")
    first = rows.groupBy("component").agg(F.min(order)["row_key"].alias("first"))
    decided = rows.join(first, "component").select("row_key", (F.col("row_key") == F.col("first")).alias("stays"), "n")
    return one_per_key(documents, decided)
