from collections import defaultdict
from pathlib import Path

import pytest

import corpus_pipeline
from docketframe.llm.common import written
from docketframe.llm.queries import CHECKS, QUERIES
from tests.llm.odd import empty_documents, odd_documents, with_clashes

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="benchmark tables are not here")


@pytest.mark.parametrize("make", [lambda spark: with_clashes(odd_documents(spark)), empty_documents])
def test_stages_run_in_turn(spark, make):
    docs = make(spark)
    columns = docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), name)
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert counts[1] <= counts[0] and counts[2] <= counts[1]
    assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@tables
def test_run_packs_what_the_stages_hand_on(spark):
    pieces = defaultdict(int)
    for row in corpus_pipeline.run(spark, SF_DIR).collect():
        pieces[row.sequence_id] += row.length
    assert pieces and all(n == 2048 or n & (n - 1) == 0 for n in pieces.values())


@tables
@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_its_check(spark, name):
    from collections import Counter

    from workloads.compare import check_connection

    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    cursor = check_connection(SF_DIR).execute(CHECKS[name])
    order = [item[0] for item in cursor.description]
    assert sorted(order) == columns
    got = Counter(tuple(row) for row in result.select(*columns).collect())
    assert got == Counter(tuple(row[order.index(c)] for c in columns) for row in cursor.fetchall())
