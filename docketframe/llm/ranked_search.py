"""Ranked lexical search by presence masks.

Every item of a query set is scored against all documents. A task reads its documents in blocks and keeps, for a block,
which documents hold which terms of the items. For an item the rows of its terms, packed to bits, give each document a
mask of the terms it holds; documents with one mask form a group. The most that a group can score follows from its mask,
the greatest counts of its terms in the block and the shortest document of the group. Groups are scored in the order of
these bounds, and an item is finished in a block when no group left can reach the worst of the ``k`` best documents that
the task has found so far; a group that could tie is still scored, so the result is exact. The ``k`` best of each task
are then reduced to the ``k`` best of all, by groups of tasks first.

Two passes over the documents: one counts N, L and the document frequencies of the items' terms, one scores. Items are
taken in blocks of about ``ITEM_BYTES`` of text, so what goes to every task is bounded; the documents are never
broadcast, joined or moved.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII; A-Z are lower-cased. A null text has no
term, and neither text nor item without a term appears in the result. Weights and scores: see :func:`weight` and
``_Block.scores``. Items are the distinct rows (item_id, text); repeated documents count and are ranked each by itself.
Equal scores go by doc_id, null ids last. Other columns are not read; empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketframe.llm.common import parts_for, written

#: Documents reported for an item.
BEST = 20
#: Text of the items that are scored in one pass.
ITEM_BYTES = 1 << 19
#: Counts (terms of the items x documents) and words a block may hold; it has one document at least.
BLOCK_CELLS, BLOCK_WORDS = 1 << 23, 1 << 20
#: Documents scored before the bound is looked at again, at first.
FIRST_ROUND = 32
#: Tasks whose results are reduced together.
TASKS_TOGETHER = 512
#: Fixed values of the score: its scale, and the part of it that does not depend on the length of a document.
SCALE, FLAT, SLOPE = 1_000_000_000, 75, 25
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_BYTES).split()


def weight(n_documents: int, df: int) -> int:
    return floor(1000 * log((2 * n_documents + 2) / (2 * df + 1)))


@dataclass
class Items:
    """A block of items: ids, and for each the numbers and repeats of its terms in the block's vocabulary."""

    ids: list[int | None]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Items:
        made = cls([], [], [], {})
        for item, text in rows:
            counts = Counter(terms(text))
            if counts:
                made.ids.append(item)
                made.terms.append(np.array([made.vocabulary.setdefault(term, len(made.vocabulary)) for term in counts], np.int64))
                made.repeats.append(np.array(list(counts.values()), np.int64))
        return made


class _Block:
    """Some documents of a task: the counts of the vocabulary's terms in each."""

    def __init__(self, ids: list[int | None], numbers: list[np.ndarray], lengths: np.ndarray, n_terms: int):
        self.null = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.lengths = lengths
        self.counts = np.zeros((n_terms, len(ids)), np.int32)
        for at, found in enumerate(numbers):
            held, often = np.unique(found, return_counts=True)
            self.counts[held, at] = often
        self.most = self.counts.max(axis=1, initial=0).astype(np.int64)

    def groups(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct non-empty masks of ``chosen`` terms, one row each, and the mask of every document, -1 for none."""
        held = self.counts[chosen] > 0
        bits = np.packbits(held, axis=0)
        words = np.zeros((-(-len(bits) // 8) * 8, bits.shape[1]), np.uint8)
        words[: len(bits)] = bits
        words = np.ascontiguousarray(words.T).view(np.uint64)
        key = words[:, 0]
        for column in range(1, words.shape[1]):
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64) << np.uint64(32) | np.unique(words[:, column], return_inverse=True)[1].astype(np.uint64)
        _, first, mask = np.unique(key, return_index=True, return_inverse=True)
        masks = held[:, first].T
        some = masks.any(axis=1)
        number = np.where(some, np.cumsum(some) - 1, -1)
        return masks[some], number[mask]

    def bounds(self, chosen: np.ndarray, factors: np.ndarray, masks: np.ndarray, shortest: np.ndarray) -> np.ndarray:
        """The most that a document with each mask can score."""
        most = self.most[chosen]
        return (masks * (factors * ((SCALE * most) // (1000 * most + 12 * shortest[:, None])))).sum(axis=1)

    def scores(self, chosen: np.ndarray, factors: np.ndarray, documents: np.ndarray) -> np.ndarray:
        counts = self.counts[np.ix_(chosen, documents)].astype(np.int64)
        return (factors[:, None] * ((SCALE * counts) // (1000 * counts + 12 * self.lengths[documents]))).sum(axis=0)


class Best:
    """The ``k`` best documents of an item so far."""

    def __init__(self, k: int):
        self.k, self.size = k, 0
        self.scores, self.ids, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """The score that a document needs to be of use."""
        return int(self.scores[-1]) if self.size == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        fits = scores >= self.least
        if fits.any():
            scores, ids, null = (np.concatenate([a, b[fits]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.null, null)))
            order = np.lexsort((ids, null, -scores))[: self.k]
            self.scores, self.ids, self.null = scores[order], ids[order], null[order]
            self.size = len(order)


def take(block: _Block, chosen: np.ndarray, factors: np.ndarray, best: Best) -> int:
    """Adds what the block holds for an item to ``best``; returns how many documents were scored."""
    masks, mask = block.groups(chosen)
    if not len(masks):
        return 0
    shortest = np.full(len(masks), np.iinfo(np.int64).max)
    members = np.flatnonzero(mask >= 0)
    np.minimum.at(shortest, mask[members], block.lengths[members])
    bound = block.bounds(chosen, factors, masks, shortest)
    rank = np.empty(len(masks), np.int64)
    rank[np.argsort(-bound, kind="stable")] = np.arange(len(masks))
    members = members[np.argsort(rank[mask[members]], kind="stable")]
    reach = bound[mask[members]]  # falls from group to group
    done, round_size = 0, FIRST_ROUND
    while done < len(members) and reach[done] >= best.least:
        some = members[done : min(done + round_size, int(np.searchsorted(-reach, -best.least, side="right")))]
        best.add(block.scores(chosen, factors, some), block.ids[some], block.null[some])
        done, round_size = done + len(some), 2 * round_size
    return done


def _read(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[tuple[int | None, np.ndarray, int]]:
    """For each document with a term: its id, the numbers of its terms in the vocabulary, and how many terms it has."""
    for batch in batches:
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            words = terms(text.as_py())
            if words:
                yield doc, np.array([vocabulary[word] for word in words if word in vocabulary], np.int64), len(words)


def _frequencies(documents: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of every term."""
    n_terms = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms + 2, np.int64)
        for _, numbers, length in _read(batches, vocabulary):
            counts[np.unique(numbers)] += 1
            counts[n_terms] += 1
            counts[n_terms + 1] += length
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["term", "n"])

    counts = np.zeros(n_terms + 2, np.int64)
    for row in documents.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]
    return int(counts[n_terms]), int(counts[n_terms + 1]), counts[:n_terms]


def _found(documents: DataFrame, items: Items, k: int) -> DataFrame:
    """item (its number in the block), item_id, doc_id, score, task: the best of each task."""
    n_documents, n_words, df = _frequencies(documents, items.vocabulary)
    weights = np.array([weight(n_documents, int(d)) for d in df], np.int64)
    per_block = max(1, BLOCK_CELLS // max(1, len(items.vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items.ids]
        factors = [weights[chosen] * often for chosen, often in zip(items.terms, items.repeats, strict=True)]
        ids, numbers, lengths, words = [], [], [], 0

        def finish() -> None:
            block = _Block(ids, numbers, FLAT + (SLOPE * np.array(lengths, np.int64) * n_documents) // n_words, len(weights))
            for chosen, own, so_far in zip(items.terms, factors, best, strict=True):
                take(block, chosen, own, so_far)

        for doc, found, length in _read(batches, items.vocabulary):
            if not len(found):
                continue
            ids.append(doc)
            numbers.append(found)
            lengths.append(length)
            words += len(found)
            if len(ids) == per_block or words >= BLOCK_WORDS:
                finish()
                ids, numbers, lengths, words = [], [], [], 0
        if ids:
            finish()
        task = TaskContext.get().partitionId()
        for at, own in enumerate(best):
            if own.size:
                columns = [pa.array([at] * own.size), pa.array([items.ids[at]] * own.size, pa.int64()), pa.array(own.ids, mask=own.null), pa.array(own.scores), pa.array([task] * own.size)]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "doc_id", "score", "task"])

    return documents.mapInArrow(run, "item long, item_id long, doc_id long, score long, task long")


def _best(found: DataFrame, k: int, *within: str) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents (doc_id, text) of highest positive score for each item (item_id, text)."""
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    blocks = parts_for(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0, ITEM_BYTES)
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = []
    for number in range(blocks):
        rows = sorted(asked.where(block_of == number).collect(), key=lambda row: (row["item_id"] is None, row["item_id"] or 0, row["text"] or ""))
        together = _best(_found(own, Items.of(rows), k).withColumn("task", F.expr(f"task div {TASKS_TOGETHER}")), k, "item", "task")
        parts.append(written(_best(together, k, "item").select("item_id", "rank", "doc_id", "score"), "search"))
    return reduce(DataFrame.unionByName, parts)
