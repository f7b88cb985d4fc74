from pyspark.sql import functions as F

from docketframe.llm import exact_dedup


def test_only_rows_of_shared_digests_are_grouped(spark, monkeypatch):
    plain, plans = exact_dedup.written, {}

    def recorded(frame, name):
        plans[name] = frame._jdf.queryExecution().analyzed().toString().split("\n")
        return plain(frame, name)

    monkeypatch.setattr(exact_dedup, "written", recorded)
    rows = [(at, f"text {at}") for at in range(200)] + [(at, f"text {at % 3}") for at in range(200, 230)]
    groups = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), exact_dedup.by_landing(2))
    found = {row.doc_id: row for row in groups.collect()}
    assert sum(row.kept for row in found.values()) == 200
    assert all((found[at].group_size, found[at].keep_id) == (11, keep) for at, keep in enumerate((228, 229, 227)))
    grouped = next(at for at, line in enumerate(plans["keepers"]) if "Aggregate" in line and "max_by(" in line)
    assert any("Join LeftSemi" in line for line in plans["keepers"][grouped + 1 : grouped + 4]), "all rows are grouped"


def test_texts_of_digests_that_occur_once_do_not_move(spark):
    texts = spark.range(5000).selectExpr("id AS doc_id", "concat('t', id % 4900) AS text").withColumn("digest", F.xxhash64("text"))
    shared = texts.groupBy("digest").count().where("count > 1").select("digest")
    passed = exact_dedup.passing(texts, shared)
    assert passed.columns == texts.columns
    wanted = {r.doc_id for r in texts.join(shared, "digest", "left_semi").collect()}
    found = {r.doc_id for r in passed.collect()}
    assert wanted <= found and len(found) < 4 * len(wanted)
    assert exact_dedup.passing(texts, shared.limit(0)).count() == 0
    assert "hashpartitioning" not in passed._jdf.queryExecution().executedPlan().toString()


def test_the_bitmap_is_tested_before_texts_are_joined(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "written", lambda frame, name: frame)
    documents = spark.createDataFrame([(i, f"text {i % 90}") for i in range(100)], "doc_id long, text string")
    plan = exact_dedup.exact_groups(documents, exact_dedup.by_landing(2))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("<=> id") < plan.find("getbit")
