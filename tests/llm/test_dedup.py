from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketframe.llm import exact_dedup, fuse_filter, near_dedup
from tests.llm.odd import empty_documents, odd_documents, odd_rows, prose, with_clashes


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 3000])
def test_a_filter_holds_its_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    built = fuse_filter.build(keys)
    assert fuse_filter.contains(keys, *built).all()
    assert fuse_filter.contains(rng.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64), *built).mean() < 0.001


def expected_groups(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1] or ""].append(row[0])
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out[(i, keep, len(ids), sha256(text.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("digest", [exact_dedup.short_digest, lambda text: F.pmod(F.crc32(text), F.lit(5)).cast("long")])
@pytest.mark.parametrize("snapshots", [0, 2])
def test_exact_groups_match_brute_force(spark, digest, snapshots):
    """With a digest of five values every step but the byte check is fooled."""
    found = exact_dedup.exact_groups(with_clashes(odd_documents(spark)), exact_dedup.by_landing(snapshots), digest).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected_groups(odd_rows())
    kept = Counter(r.text_sha256 for r in found if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.text_sha256 for r in found}
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_groups(empty_documents(spark), exact_dedup.by_landing(2)).collect() == []


def test_one_of_each_keeps_all_columns(spark):
    documents = with_clashes(odd_documents(spark))
    kept = exact_dedup.one_of_each(documents)
    assert kept.columns == documents.columns
    rows = kept.collect()
    assert Counter(r.text or "" for r in rows) == Counter({row[1] or "" for row in odd_rows()})
    assert {r.row_id for r in rows} == {"clash"}


def brute_components(rows, size, percent=80):
    """(doc_id, set size, component id) of every row."""
    sets = [near_dedup.shingle_set((row[1] or "").encode().lower().split(), size) for row in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i, row in enumerate(rows):
        members[find(i)].append(row[0])
    least = {root: min((i for i in ids if i is not None), default=None) for root, ids in members.items()}
    return [(row[0], len(sets[i]), least[find(i)]) for i, row in enumerate(rows)]


@pytest.mark.parametrize("size", [2, 5])
def test_near_groups_match_brute_force(spark, size):
    found = near_dedup.near_groups(with_clashes(odd_documents(spark)), size).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(brute_components(odd_rows(), size))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def near_rows():
    """A group of near copies around one text, some too far from most others, and strangers."""
    rng = np.random.default_rng(4)
    base = prose(5, 150).split()
    rows = []
    for i in range(90):
        words = list(base)
        for at in rng.choice(len(words), 3 + i // 6, replace=False):
            words[at] = f"w{rng.integers(1000)}"
        rows.append((1000 - i, " ".join(words), "en", "a", 0))
    return rows + [(2000 + i, prose(3000 + i, 100), "en", "a", 0) for i in range(20)]


def test_groups_without_a_good_leader_lose_no_link(spark):
    rows = near_rows()
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = near_dedup.near_groups(documents, 2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(brute_components(rows, 2))


def test_near_one_of_each(spark):
    documents = with_clashes(odd_documents(spark))
    kept = near_dedup.one_of_each(documents, 2)
    assert kept.columns == documents.columns
    expected = Counter()
    for doc_id, n_shingles, component in set(brute_components(odd_rows(), 2)):
        if n_shingles and doc_id == component:
            expected[doc_id] = 1
    for row in odd_rows():
        if not (row[1] or "").split():
            expected[row[0]] += 1
    assert Counter(r.doc_id for r in kept.collect()) == expected


def test_near_dedup_of_nothing(spark):
    assert near_dedup.near_groups(empty_documents(spark)).collect() == []
    assert near_dedup.one_of_each(empty_documents(spark)).collect() == []


def test_posterior_bounds_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    matches = rng.random((20_000, near_dedup.BANDS * near_dedup.ROWS)) < 0.8
    lost = np.zeros(len(matches), bool)
    for n, needed in near_dedup.least_matches(0.8):
        lost |= matches[:, :n].sum(axis=1) < needed
    assert lost.mean() < 0.001
    strangers = rng.random((2000, 36)) < 0.3
    n, needed = near_dedup.least_matches(0.8)[0]
    assert (strangers.sum(axis=1) >= needed).mean() < 0.02


def test_text_of_one_word_is_one_shingle():
    assert near_dedup.shingle_set([b"a"], 2) == {b"a"}
    assert near_dedup.shingle_set([], 2) == set()
