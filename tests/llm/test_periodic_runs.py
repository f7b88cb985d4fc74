import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketframe.llm import periodic_runs
from docketframe.llm.queries import op12_periodic_runs
from tests.llm.odd import empty_documents, odd_documents, odd_rows, prose, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def brute_runs(words, least=12):
    """Every period, every stretch; of one stretch the smallest period."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i >= p and j + p - i >= least:
                found.setdefault((i, j + p), p)
            i = max(i + 1, j)
    return sorted((start, end - start, p) for (start, end), p in found.items())


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    chosen = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *chosen, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(kept)))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def found(texts, span=periodic_runs.SPAN):
    return periodic_runs.runs_of([np.array(text, np.int64) for text in texts], span=span)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=120), max_size=5), st.sampled_from([5, 40, 1000]))
def test_runs_of_few_words_against_brute_force(texts, span):
    assert found(texts, span) == [brute_runs(text) for text in texts]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.integers(0, 90), st.lists(st.integers(0, 9), max_size=40), st.integers(3, 80))
def test_planted_runs_against_brute_force(part, more, before, span):
    text = before + (part * (2 + more))[: 2 * len(part) + more] + before
    assert found([text, before], span) == [brute_runs(text), brute_runs(before)]


@pytest.mark.parametrize("span", [16, 300, 1 << 16])
def test_famous_sequences(span):
    thue = [bin(i).count("1") % 2 for i in range(700)]
    texts = [fibonacci(600), thue, [0] * 500, [0, 1] * 250, list(range(400)) * 3, []]
    assert found(texts, span) == [brute_runs(text) for text in texts]


def test_a_sum_that_tells_little_reports_true_runs_only(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BASE", 1)
    rng = random.Random(4)
    for _ in range(60):
        text = [rng.randrange(3) for _ in range(120)]
        assert {run[:2] for run in found([text])[0]} <= {run[:2] for run in brute_runs(text)}


def test_long_texts_stay_linear():
    assert found([[7] * 200_000]) == [[(0, 200_000, 1)]]
    block = list(range(30_000))
    assert found([block * 3 + [-5]]) == [[(0, 90_000, 30_000)]]


def rows_of(df):
    return Counter(tuple(row) for row in df.collect())


def test_odd_documents(spark):
    rows = [row for row in odd_rows() if len(row[1] or "") < 5000]
    rows += [(k, f"{prose(k, 30)} {'a b c ' * 9}x {prose(k, 30)}", None, None, 0) for k in range(200, 240)]
    rows += [(300, "one two " * 6, "", "", 0), (301, "w " * 11, "", "", 0), (302, "w " * 12, "", "", 0), (303, "a\x0bb\x0cc\rd\x1ce " * 5, "", "", 0)]
    documents = with_clashes(spark.createDataFrame(rows, odd_documents(spark).schema)).repartition(3)
    report = periodic_runs.run_report(periodic_runs.with_repeated_ends(documents))
    assert rows_of(report) == Counter(brute_row(row[0], row[1]) for row in rows)


def test_long_odd_texts_keep_their_words(spark):
    texts = {row.doc_id: row for row in periodic_runs.find_runs(odd_documents(spark)).collect()}
    assert texts[11].collapsed.split() == odd_rows()[14][1].split() and texts[11].runs == []
    assert texts[5].collapsed == "" and texts[5].runs == [] and texts[8].collapsed == ""


def test_the_query_over_a_whole_table(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(op12_periodic_runs(spark, SF)) == Counter(brute_row(row.doc_id, row.text) for row in documents if len(row.text) < 20_000) + rows_of(
        op12_periodic_runs(spark, SF).where(f"doc_id in ({','.join(str(r.doc_id) for r in documents if len(r.text) >= 20_000) or -1})")
    )


def test_small_portions_give_the_same(spark, monkeypatch):
    whole = rows_of(periodic_runs.run_report(odd_documents(spark)))
    monkeypatch.setattr(periodic_runs, "PORTION", 300)
    batch = odd_documents(spark).select("doc_id", "text").toArrow().combine_chunks().to_batches()[0]
    parts = list(periodic_runs._portions(batch))
    assert len(parts) > 10 and sum(part.num_rows for part in parts) == batch.num_rows
    assert rows_of(periodic_runs.run_report(odd_documents(spark))) == whole


def test_nothing(spark):
    assert periodic_runs.run_report(empty_documents(spark)).collect() == []
