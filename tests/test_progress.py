import time

import pytest
from pyspark.sql import functions as F

from docketframe.operators import extract, refs, summary
from docketframe.plans import jobs
from docketframe.sources import pages as page_source
from docketframe.sources import progress
from docketframe.sources.config import load_counties, search_pages_frame
from docketframe.streaming import incremental
from tests import sample

LISTED = {"JN00041-19", "JN00042-19", "JN00043-19", "JN00050-19", "JN00044-19", "SR-012-X", "SP-0030-K", "SR-013-Y"}


def test_progress_lines(spark, tmp_path):
    (tmp_path / "juniper.jsonl").write_text('{"n": "1"}\n\n{"n": "2"}\n{"m": "3"}\n[1]\n{"n": "1"}\n{"n": "4', encoding="utf-8")
    done = progress.read_done_files(spark, str(tmp_path))
    assert sorted(tuple(r) for r in done.collect()) == [("juniper", "1"), ("juniper", "2")]
    assert [tuple(r) for r in summary.completed_count(done).collect()] == [("juniper", 2)]


def test_append_and_reset(spark, tmp_path):
    path = str(tmp_path / "done")
    assert progress.read_done(spark, path).count() == 0
    for refs_now in ([("a", "1", "ok"), ("b", "1", "missing")], [("a", "2", "ok")]):
        progress.append_done(spark.createDataFrame(refs_now, "county_key string, n string, state string"), path)
    assert sorted(tuple(r) for r in progress.read_done(spark, path).collect()) == [("a", "1"), ("a", "2"), ("b", "1")]
    progress.reset_done(spark, path)
    assert progress.read_done(spark, path).count() == 0


def test_skip_done_is_per_county(spark):
    listed = spark.createDataFrame([("a", "1"), ("b", "1"), ("a", "2")], "county_key string, case_ref string")
    done = spark.createDataFrame([("a", "1"), ("b", "9")], "county_key string, n string")
    assert sorted(tuple(r) for r in refs.skip_done(listed, done).collect()) == [("a", "2"), ("b", "1")]


def test_states_of_all_references(spark):
    pages = sample.pages_frame(spark).withColumn(
        "html", F.when(F.col("page_key") != "SR-013-Y.html", F.col("html"))
    )
    cases = jobs.cases_from_pages(pages, sample.COUNTIES, keep_all=True).collect()
    assert {r.case_ref for r in cases} == LISTED
    states = {r.case_ref: r.state for r in cases if r.state != "ok"}
    assert states == {"JN00050-19": "missing", "SR-013-Y": "failed"}


def test_resumed_run_adds_nothing_and_keeps_the_rows(spark, tmp_path):
    rows_path, done_path = str(tmp_path / "rows"), str(tmp_path / "done")
    pages = sample.pages_frame(spark)
    assert jobs.resume(pages, sample.COUNTIES, rows_path, done_path) == 7
    assert jobs.resume(pages, sample.COUNTIES, rows_path, done_path) == 0
    assert [tuple(r) for r in jobs.export_table(spark, rows_path).collect()] == sample.EXPECTED
    states = spark.read.json(done_path).groupBy("state").count().collect()
    assert {r.state: r["count"] for r in states} == {"ok": 7, "missing": 1}


def test_only_files_with_a_page_to_do_are_read(spark, tmp_path):
    done = spark.createDataFrame([("juniper", "JN00043-19"), ("sorrel", "SR-013-Y")], "county_key string, n string")
    wanted = [r for r in sample.EXPECTED if not r[1].endswith(("00043-19", "013-Y"))]
    got = jobs.attorney_rows(sample.pages_frame(spark), sample.COUNTIES, done=done)
    assert [tuple(r) for r in got.collect()] == wanted
    kind = F.when(F.col("page_key").startswith("results"), "search").otherwise("case")
    pages = sample.pages_frame(spark).withColumn("kind", kind)
    for key in [r.page_key for r in pages.select("page_key").distinct().collect()]:  # one file a page
        page_source.write_pages(pages.where(F.col("page_key") == key).coalesce(1), str(tmp_path / "pages"))
    landed = page_source.read_pages(spark, str(tmp_path / "pages"))
    assert [tuple(r) for r in jobs.attorney_rows(landed, sample.COUNTIES, done=done).collect()] == wanted
    counties = load_counties(sample.COUNTIES)
    one = spark.createDataFrame([("juniper", "JN00043-19", 0, 0)], "county_key string, case_ref string, page_ord int, ref_pos int")
    _, narrowed = refs.only_pages_of(one, landed, counties)
    assert [r.page_key for r in narrowed.collect()] == ["JN00043-19.html"]
    plan = narrowed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_results_pages_that_fail_or_are_absent_are_recorded(spark):
    pages = sample.pages_frame(spark).withColumn(
        "html", F.when((F.col("county_key") == "juniper") & (F.col("page_key") == "results_1.html"), None).otherwise(F.col("html"))
    )
    counties = load_counties(sample.COUNTIES)
    found = refs.results_page_states(pages, counties, search_pages_frame(spark, counties)).collect()
    states = {(r.county_key, r.page): r.state for r in found}
    assert states == {("juniper", "results_1"): "failed", ("sorrel", "results_1"): "ok", ("sorrel", "results_2"): "ok", ("sorrel", "results_7"): "missing"}


def test_summary(spark):
    cases = jobs.cases_from_pages(sample.pages_frame(spark), sample.COUNTIES)
    got = {r.county: tuple(r)[1:] for r in jobs.run_summary(cases).collect()}
    assert got == {"Juniper County": (4, 7, 5, 7, 7), "Sorrel County": (3, 6, 5, 6, 6), None: (7, 13, 10, 13, 13)}


def test_pages_from_a_directory_and_from_a_table(spark, tmp_path):
    for county, pages in (("juniper", sample.GRID_PAGES), ("sorrel", sample.BLOCK_PAGES)):
        (tmp_path / county).mkdir()
        for name, html in pages.items():
            (tmp_path / county / name).write_text(html, encoding="utf-8")
    (tmp_path / "juniper" / "A B+c%.html").write_text("odd name", encoding="utf-8")
    found = page_source.read_page_directory(spark, str(tmp_path))
    assert found.where("page_key = 'A B+c%.html'").first().html == "odd name"
    assert [tuple(r) for r in jobs.attorney_rows(found, sample.COUNTIES).collect()] == sample.EXPECTED

    counties = load_counties(sample.COUNTIES)
    url = F.concat(
        F.lit("https://records.invalid/"), F.col("county_key"),
        F.when(F.col("page_key").startswith("results"), "/Search/").otherwise("/Case/"),
        F.regexp_replace("page_key", ".html$", ""), F.lit("?x=1"),
    )
    stray = spark.createDataFrame([("https://elsewhere.invalid/Case/JN00041-19", "<p>")], "url string, html string")
    by_url = sample.pages_frame(spark).select(url.alias("url"), "html").unionByName(stray)
    tabled = page_source.page_table(by_url, counties)
    assert {r.kind for r in tabled.select("kind").collect()} == {"search", "case"}
    assert [tuple(r) for r in jobs.attorney_rows(tabled, sample.COUNTIES).collect()] == sample.EXPECTED


def test_landed_pages_are_pruned_by_county_and_kind(spark, tmp_path):
    kind = F.when(F.col("page_key").startswith("results"), "search").otherwise("case")
    page_source.write_pages(sample.pages_frame(spark).withColumn("kind", kind), str(tmp_path / "pages"))
    landed = page_source.read_pages(spark, str(tmp_path / "pages"))
    table = jobs.attorney_rows(landed, sample.COUNTIES)
    assert [tuple(r) for r in table.collect()] == sample.EXPECTED
    scans = [line for line in table._jdf.queryExecution().sparkPlan().toString().splitlines() if "FileScan" in line]
    assert sum("html:string" in s for s in scans) == 2  # results pages, case pages
    assert len(scans) == 4  # and the keys of both, for pages that landed more than once
    assert all("PartitionFilters: [" in s and "county_key" in s and "kind" in s.split("PartitionFilters")[1] for s in scans)


def test_html_is_never_shuffled(spark):
    counties = load_counties(sample.COUNTIES)
    plan = jobs.attorney_rows(sample.pages_frame(spark), counties)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "MapIn" not in plan
    assert not any("html" in line or "page#" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert search_pages_frame(spark, counties).count() == 4


def test_incremental_run_over_pages_in_any_order(spark, tmp_path):
    landing, out, state = (str(tmp_path / name) for name in ("landing", "rows", "state"))
    pages = sample.pages_frame(spark).withColumn(
        "kind", F.when(F.col("page_key").startswith("results"), "search").otherwise("case")
    )
    early = F.col("page_key").isin("results_1.html", "JN00043-19.html", "SP-0030-K.html")
    counts = []
    for landed in (pages.where(early), pages.where(~early), pages.where(early)):
        page_source.write_pages(landed, landing)
        incremental.run_available(spark, landing, sample.COUNTIES, out, state)
        counts.append(incremental.added_rows(spark, out, state).count())
    incremental.run_available(spark, landing, sample.COUNTIES, out, state)
    states = {r.case_ref: r.state for r in incremental.reference_states(spark, state).collect()}
    assert states == {ref: "missing" if ref == "JN00050-19" else "ok" for ref in LISTED}
    assert counts == [4, 13, 13] and incremental.added_rows(spark, out, state).count() == 13
    assert [tuple(r) for r in jobs.finish(incremental.stored_rows(spark, out, state)).collect()] == sample.EXPECTED


def test_stream_keeps_listing_order_and_the_newest_version(spark, tmp_path):
    landing, out, state = (str(tmp_path / name) for name in ("landing", "rows", "state"))
    county = {**sample.BLOCK, "search_pages": ["p0", "p1"]}
    old = sample.block_page("R0", "old", [], [("Claimant", "x", ["Ann Old"])], [])
    new = sample.block_page("R0", "new", [], [("Claimant", "x", ["Ann New"])], [])
    other = sample.block_page("R1", "other", [], [("Claimant", "y", ["Bo Other"])], [])
    batches = [
        [("case", "R0.html", None), ("case", "R1.html", other)],
        [("search", "p1.html", sample.card_page(["R0", "R1"])), ("case", "R0.html", old)],
        [("case", "R0.html", new)],
        [("search", "p0.html", sample.card_page(["R1", "R0"]))],
    ]
    for batch in batches:
        landed = spark.createDataFrame([("sorrel", *page) for page in batch], schema_of_landed)
        page_source.write_pages(landed, landing)
        incremental.run_available(spark, landing, [county], out, state)
    found = incremental.stored_rows(spark, out, state).orderBy("row_ord").collect()
    assert [(r.case_ref, r.last_name) for r in found] == [("R1", "Other"), ("R0", "Old")]
    assert [int(r.row_ord) // 10**10 for r in found] == [0, 1]


def two_versions(spark, landing):
    """Two versions of a page, each in a file of its own; the later one sorts first by content."""
    old = sample.block_page("R0", "old", [], [("Claimant", "x", ["Zed Old"])], [])
    new = sample.block_page("R0", "new", [], [("Claimant", "x", ["Ann New"])], [])
    for batch in ([("case", "R0.html", old), ("search", "p0.html", sample.card_page(["R9", "R0"]))], [("case", "R0.html", new), ("search", "p0.html", sample.card_page(["R0"]))]):
        page_source.write_pages(spark.createDataFrame([("sorrel", *page) for page in batch], schema_of_landed).coalesce(1), landing)
        time.sleep(0.05)


def test_the_version_landed_last_counts_in_batch_and_stream(spark, tmp_path):
    landing, out, state = (str(tmp_path / name) for name in ("landing", "rows", "state"))
    county = {**sample.BLOCK, "search_pages": ["p0"]}
    two_versions(spark, landing)
    (row,) = jobs.attorney_rows(page_source.read_pages(spark, landing), [county]).collect()
    assert row["Last Name"] == "New"
    assert jobs.cases_from_pages(page_source.read_pages(spark, landing), [county], keep_all=True).count() == 1
    incremental.run_available(spark, landing, [county], out, state)
    (row,) = incremental.stored_rows(spark, out, state).collect()
    assert row.last_name == "New"


def test_a_batch_that_is_run_again_leaves_no_copy(spark, tmp_path, monkeypatch):
    landing, out, checkpoint = (str(tmp_path / name) for name in ("landing", "rows", "state"))
    pages = sample.pages_frame(spark).withColumn("kind", F.when(F.col("page_key").startswith("results"), "search").otherwise("case"))
    page_source.write_pages(pages, landing)
    commit = incremental.State.commit

    def killed(self, batch, lines, buckets):
        raise RuntimeError("executor and driver lost")

    monkeypatch.setattr(incremental.State, "commit", killed)
    with pytest.raises(Exception, match="lost"):
        incremental.run_available(spark, landing, sample.COUNTIES, out, checkpoint)
    assert incremental.State(spark, checkpoint).committed() == []
    monkeypatch.setattr(incremental.State, "commit", commit)
    incremental.run_available(spark, landing, sample.COUNTIES, out, checkpoint)
    assert incremental.added_rows(spark, out, checkpoint).count() == 13
    assert [tuple(r) for r in jobs.finish(incremental.stored_rows(spark, out, checkpoint)).collect()] == sample.EXPECTED


def test_a_batch_reads_the_buckets_it_touches(spark, tmp_path, monkeypatch):
    landing, out, checkpoint = (str(tmp_path / name) for name in ("landing", "rows", "state"))
    county = {**sample.BLOCK, "search_pages": [f"p{i}" for i in range(9)]}
    read = []
    latest = incremental.State.latest

    def counted(self, name, ledger, ddl, only=None):
        read.append(sum(own == name and bucket in only for own, bucket in ledger) if only is not None else None)
        return latest(self, name, ledger, ddl, only)

    monkeypatch.setattr(incremental.State, "latest", counted)
    state = incremental.State(spark, checkpoint)
    counties, listing = load_counties([county]), search_pages_frame(spark, load_counties([county]))
    for i in range(9):
        page = sample.block_page(f"R{i}", "x", [], [("Claimant", "x", ["Ann Lee"])], [])
        rows = [("sorrel", "search", f"p{i}.html", sample.card_page([f"R{i}"])), ("sorrel", "case", f"R{i}.html", page)]
        batch = spark.createDataFrame(rows, schema_of_landed).withColumn("landed", F.struct(F.lit(i).alias("time")))
        incremental.process_batch(state, batch, i, counties, listing, out, 64)
    assert incremental.added_rows(spark, out, checkpoint).count() == 9
    assert all(n <= 1 for n in read), read


schema_of_landed = "county_key string, kind string, page_key string, html string"


def test_versions_are_told_apart_without_what_the_pages_hold(spark, tmp_path):
    ddl = "county_key string, page_key string, bucket int, parties string, error string, landed struct<time:int,file:string,row:int>"
    rows = [
        ("a", "1", 0, "old", None, (1, "f", 0)), ("a", "1", 0, "new", "bad", (2, "e", 0)), ("a", "1", 0, "mid", None, (1, "g", 5)),
        ("a", "2", 1, "only", None, (1, "f", 1)), ("b", "1", 2, "other", None, (1, "f", 2)),
    ]
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "records"))
    records = spark.read.schema(ddl).parquet(str(tmp_path / "records"))
    newest = incremental._newest(records)
    scan = newest._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert "error" in scan and "parties" not in scan
    assert sorted((r.county_key, r.page_key, r.now) for r in newest.collect()) == [("a", "1", "failed"), ("a", "2", "ok"), ("b", "1", "ok")]
    found = incremental._versions(records, newest)
    assert sorted((r.county_key, r.page_key, r.bucket, r.parties) for r in found.collect()) == [("a", "1", 0, "new"), ("a", "2", 1, "only"), ("b", "1", 2, "other")]


def test_what_one_batch_reads_whole_is_not_dealt_to_buckets(spark, tmp_path):
    county = {**sample.BLOCK, "search_pages": ["p0"]}
    counties, state = load_counties([county]), incremental.State(spark, str(tmp_path / "state"))
    names = [f"R{i}" for i in range(40)]
    pages = [("sorrel", "case", f"{name}.html", sample.block_page(name, "x", [], [("Claimant", "x", ["Ann Lee"])], [])) for name in names]
    rows = [("sorrel", "search", "p0.html", sample.card_page(names[:30])), *pages]
    batch = spark.createDataFrame(rows, schema_of_landed).withColumn("landed", F.struct(F.lit(1).alias("time"))).coalesce(2)
    incremental.process_batch(state, batch, 0, counties, search_pages_frame(spark, counties), str(tmp_path / "rows"), 64)
    tables = tmp_path / "state" / "tables"
    for name in ("new_refs", "new_records", "left"):
        assert not list((tables / name / "batch=0").glob("bucket=*")), name
    assert len(list((tables / "new_records" / "batch=0").glob("part-*.parquet"))) <= 2
    assert incremental.added_rows(spark, str(tmp_path / "rows"), str(tmp_path / "state")).count() == 30
    assert spark.read.parquet(str(tables / "records" / "batch=0")).count() == 10  # wait for their listing


def test_versions_are_told_apart_where_records_meet_their_references(spark):
    counties = load_counties([sample.BLOCK])
    page = lambda name, status: sample.block_page(name, "x", [("Status", status)], [], [])
    rows = [("sorrel", "R0.html", page("R0", "new"), 2), ("sorrel", "R0.html", page("R0", "old"), 1), ("sorrel", "R1.html", page("R1", "only"), 1)]
    records = extract.extract_cases(spark.createDataFrame(rows, "county_key string, page_key string, html string, landed int"), counties)
    listed = spark.createDataFrame([("sorrel", "R0", 0, 0, 2), ("sorrel", "R1", 0, 1, 1)], "county_key string, case_ref string, page_ord int, ref_pos int, last int")
    found = refs.visit(listed, records, counties)
    assert sorted((r.case_ref, r.status) for r in found.collect()) == [("R0", "new"), ("R1", "only")]


def test_ranges_of_keys_are_halved(spark):
    keys = spark.range(1000).select(F.format_string("%04d", "id").alias("key"))
    for n in (0, 1, 2, 7, 64):
        ranges = [(f"{at * 15:04d}", f"{at * 15 + at % 9:04d}") for at in range(n)]
        wanted = {f"{at * 15 + more:04d}" for at in range(n) for more in range(at % 9 + 1)}
        assert {r.key for r in keys.where(refs._in_ranges(F.col("key"), ranges)).collect()} == wanted
    assert spark.createDataFrame([(None,)], "key string").where(refs._in_ranges(F.col("key"), ranges)).count() == 0
    plan = keys.where(refs._in_ranges(F.col("key"), ranges[:8]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("0060") < plan.index("0015")  # the middle is asked first
