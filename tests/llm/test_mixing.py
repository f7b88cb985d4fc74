from collections import Counter, defaultdict

import numpy as np
import pytest

from docketframe.llm import mixing
from tests.llm.odd import empty_documents, odd_documents, odd_rows, with_clashes


def test_targets_stop_at_three_times_the_size():
    assert mixing.targets([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    found = mixing.targets([100, 1, 0], [1, 2, 3])
    assert found == pytest.approx([98, 3, 0])
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0, 0]
    assert sum(mixing.targets([7, 500, 20, 3], [1, 2, 3, 1])) == pytest.approx(530)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000])
def test_permutation_and_its_inverse(n):
    index, size, key = np.arange(n), np.full(n, n), np.full(n, 12345)
    there = mixing.permuted(index, size, key)
    assert sorted(there) == list(range(n))
    assert (mixing.permuted(there, size, key, inverse=True) == index).all()


@pytest.mark.parametrize("block", [1, 4, 128])
@pytest.mark.parametrize("shard_slots", [3, 8192])
def test_taken_words_reach_the_target_and_no_word_comes_four_times(spark, block, shard_slots):
    rows = mixing.mix_report(with_clashes(odd_documents(spark)), block=block, shard_slots=shard_slots).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((row[0], len((row[1] or "").encode().split())) for row in odd_rows())
    sizes = defaultdict(int)
    for row in odd_rows():
        sizes[row[3]] += len((row[1] or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, mixing.targets([sizes[s] for s in order], [1.0, 2.0, 3.0, 1.0]), strict=True))
    assert all(r.taken <= 3 * r["size"] for r in rows)
    by_target = defaultdict(int)
    for r in rows:
        by_target[(r.source_size, r.target)] += r.taken
    assert {size: pytest.approx(total, abs=0.51) for (size, _), total in by_target.items()} == {sizes[s]: pytest.approx(wanted[s], abs=0.51) for s in order}


def test_reruns_agree(spark):
    first, again = (sorted(map(tuple, mixing.mix_report(odd_documents(spark)).fillna(-1).collect())) for _ in range(2))
    assert first == again


def test_draws_number_each_slot_once(spark):
    needs = [0, 5, 1000, 37, 1]
    rows = mixing.drawn(spark, needs, 3, 50).collect()
    for place, need in enumerate(needs):
        slots = [s for r in rows if r.place == place for s in range(r["first"], r["first"] + r.slots)]
        assert sorted(slots) == list(range(need))
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.slots
    assert max(sizes.values()) <= 60 or len(sizes) == 1


def test_mixed_documents_keep_columns_and_words(spark):
    documents = with_clashes(odd_documents(spark))
    mixed = mixing.mix_documents(documents, block=16)
    assert mixed.columns == documents.columns
    rows = mixed.collect()
    words = defaultdict(set)
    for row in odd_rows():
        words[row[0]].add(row[1])
    for r in rows:
        assert any(t and (r.text == t or (set(r.text.split()) <= set(t.split()) and len(r.text) < len(t))) for t in words[r.doc_id])
        assert r.row_id == "clash"
    partial = [r for r in rows if r.text not in words[r.doc_id]]
    assert partial and all(r.n_chars == len(r.text) for r in partial)
    report = mixing.mix_report(documents, block=16).collect()
    taken = Counter()
    for r in report:
        taken[r.doc_id] += r.taken
    given = Counter()
    for r in rows:
        given[r.doc_id] += len(r.text.encode().split())
    assert sum(given.values()) == sum(taken.values())


def test_mixing_nothing(spark):
    assert mixing.mix_report(empty_documents(spark)).collect() == []
    assert mixing.mix_documents(empty_documents(spark)).collect() == []
    no_words = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [tuple(r)[1:] for r in mixing.mix_report(no_words).collect()] == [(0, 0, 0.0, 0)] * 2
