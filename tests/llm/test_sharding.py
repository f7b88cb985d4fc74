import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from docketframe.llm import sharding
from tests.llm.odd import empty_documents, odd_documents, odd_rows, prose, with_clashes


def brute_minimax(sizes, shards):
    def cut(capacity):
        cuts, at, filled = [], 0, 0
        for size in sizes:
            if filled + size > capacity:
                cuts.append(at)
                filled = 0
            filled, at = filled + size, at + size
        return [*cuts, at]

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if len(cut(middle)) <= shards else (middle + 1, high)
    return low, cut(low)


@pytest.mark.parametrize("seed", range(40))
def test_search_over_summaries_finds_the_exact_cuts(seed, monkeypatch):
    rng = random.Random(seed)
    sizes = [int(rng.paretovariate(0.9)) + rng.randint(0, 50) for _ in range(rng.randint(1, 200))]
    shards, ends = rng.randint(1, 16), []
    for size in sizes:
        ends.append((ends[-1] if ends else 0) + size)

    def summary(_, windows, width):
        stretches = {}
        for end in ends:
            if any(a < end <= b for a, b in windows):
                stretches.setdefault((end - 1) // width, []).append(end)
        return [(min(found), max(found)) for found in stretches.values()]

    monkeypatch.setattr(sharding, "_summary", summary)
    monkeypatch.setattr(sharding, "SUMMARY", 7)
    monkeypatch.setattr(sharding, "FINER", 3)
    capacity, cuts = sharding.minimax_cuts(None, ends[-1], max(sizes), shards)
    wanted, wanted_cuts = brute_minimax(sizes, shards)
    assert capacity == wanted and sorted(set(cuts)) == sorted(set(wanted_cuts))


def test_running_sums_match_a_plain_sum(spark):
    rng = random.Random(1)
    rows = [(rng.randint(-(2**63), 2**63 - 1), rng.randint(1, 99)) for _ in range(5000)]
    for pretended in (10, 5000, 10**8):  # a single range, some, and more than rows
        found = sharding.running_sums(spark.createDataFrame(rows, "key long, bytes long"), pretended).orderBy("key").collect()
        total = 0
        for (key, size), row in zip(sorted(rows), found, strict=True):
            total += size
            assert (row.key, row.upto) == (key, total)


def check_shards(rows, documents, shards):
    sizes = {i: len((row[1] or "").encode()) + 1 for i, row in enumerate(documents)}
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (row[0], sizes[i], zlib.crc32((row[1] or "").encode())) for i, row in enumerate(documents)
    )
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        groups[(r["size"], r.text_crc32)].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert all(len(found) == 1 for found in groups.values())


def test_odd_documents(spark):
    check_shards(sharding.shard_documents(with_clashes(odd_documents(spark))).collect(), odd_rows(), 16)


def test_a_group_of_a_third_gets_its_own_shard_and_the_rest_is_even(spark):
    rows = [(i, prose(1, 100), "en", "a", 0) for i in range(300)] + [(1000 + i, prose(10 + i, 100), "en", "a", 0) for i in range(600)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = sharding.shard_documents(documents, 8).collect()
    check_shards(found, rows, 8)
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r["size"]
    big = {r.shard for r in found if r.doc_id < 300}
    assert len(big) == 1 and {r.doc_id for r in found if r.shard in big} == set(range(300))
    rest = [sizes[s] for s in range(8) if s not in big]
    assert max(rest) < 1.1 * min(rest)


def test_sharding_nothing_and_without_python(spark):
    assert sharding.shard_documents(empty_documents(spark)).collect() == []
    one = spark.createDataFrame([(1, None, "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [tuple(r) for r in sharding.shard_documents(one).collect()] == [(1, 1, 0, "bytes", 15, 0, None)]
    plan = sharding.shard_documents(one)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
