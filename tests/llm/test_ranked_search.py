import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketframe.llm import ranked_search
from docketframe.llm.queries import CHECKS, op11_ranked_search
from tests.llm.odd import empty_documents, odd_documents, odd_rows, with_clashes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"
SF = "/root/testdata/sf0.01"


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, items, k=20):
    docs = [(doc, plain_terms(text)) for doc, text in documents]
    docs = [(doc, words) for doc, words in docs if words]
    n, total, df = len(docs), sum(len(words) for _, words in docs), Counter(w for _, words in docs for w in set(words))
    rows = []
    for item, text in set(items):
        found = []
        for doc, words in docs:
            tf, m, score = Counter(words), 75 + 25 * len(words) * n // total, 0
            for term in plain_terms(text):
                if tf[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * tf[term] // (1000 * tf[term] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        rows += [(item, rank, None if null else doc, -score) for rank, (score, null, doc) in enumerate(sorted(found)[:k], 1)]
    return Counter(rows)


def rows_of(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


TEXTS = ["", None, "...", "river stone", "River RIVER stone; lake", "ÄÖ äö naïve_x a-b a1", "the " * 50, "table x table table", "日本語 word", "\x00a\x7fb"]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_odd_documents_and_items(spark, k):
    items = [(i, text) for i, text in enumerate(TEXTS)] + [(3, "river stone"), (None, "green cloud"), (3, "glass road river"), (40, odd_rows()[0][1]), (41, odd_rows()[14][1])]
    found = ranked_search.search(with_clashes(odd_documents(spark)).repartition(3), spark.createDataFrame(items, ITEMS), k)
    assert rows_of(found) == brute([row[:2] for row in odd_rows()], items, k)


def test_small_blocks_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, row[1]) for i, row in enumerate(odd_rows()) if len(row[1] or "") < 5000], ITEMS)
    whole = rows_of(ranked_search.search(odd_documents(spark), items))
    for name, value in (("BLOCK_CELLS", 1), ("ITEM_BYTES", 500), ("TASKS_TOGETHER", 1)):
        monkeypatch.setattr(ranked_search, name, value)
    assert rows_of(ranked_search.search(odd_documents(spark).repartition(2), items)) == whole


def test_ties_go_by_id_and_repeated_rows_count(spark):
    documents = [(doc, "same words here") for doc in (9, 3, 7, 3, None, 1)] + [(i, f"other{i}") for i in range(100, 130)]
    items = [(1, "same"), (2, "other100 here here")]
    found = ranked_search.search(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), 5)
    assert rows_of(found) == brute(documents, items, 5)
    assert [r.doc_id for r in found.where("item_id = 1").orderBy("rank").collect()] == [1, 3, 3, 7, 9]


def test_nothing(spark):
    items = spark.createDataFrame([(1, "a")], ITEMS)
    assert ranked_search.search(empty_documents(spark), items).collect() == []
    assert ranked_search.search(odd_documents(spark), items.limit(0)).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 80), max_size=30), min_size=1, max_size=40), st.lists(st.integers(0, 80), min_size=1, max_size=75, unique=True), st.integers(1, 8))
def test_groups_skipped_hold_nothing_better(documents, chosen, k):
    """Also with more than 64 terms, where a mask is wider than one word."""
    lengths = np.array([75 + len(words) for words in documents])
    block = ranked_search._Block(list(range(len(documents))), [np.array(words, np.int64) for words in documents], lengths, 81)
    chosen, best = np.array(chosen), ranked_search.Best(k)
    factors = chosen * 7 % 11
    scored = ranked_search.take(block, chosen, factors, best)
    every = block.scores(chosen, factors, np.arange(len(documents)))
    wanted = sorted((-int(s), i) for i, s in enumerate(every) if s > 0)[:k]
    assert list(zip((-best.scores).tolist(), best.ids.tolist())) == wanted
    assert scored <= len(documents)


def test_most_documents_are_never_scored():
    rng = np.random.default_rng(2)
    documents = [rng.zipf(1.6, 60) % 500 for _ in range(4000)]
    block = ranked_search._Block(list(range(4000)), documents, np.full(4000, 100), 500)
    chosen = np.unique(documents[17])
    scored = ranked_search.take(block, chosen, np.linspace(1000, 9000, len(chosen)).astype(int), ranked_search.Best(20))
    assert scored < 1000


def test_the_query_against_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    wanted = Counter(con.execute(CHECKS["op11_ranked_search"]).fetchall())
    found = op11_ranked_search(spark, SF)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert rows_of(found) == wanted
    per_item = defaultdict(list)
    for item, rank, _, _ in wanted:
        per_item[item].append(rank)
    assert all(sorted(ranks) == list(range(1, len(ranks) + 1)) for ranks in per_item.values())
