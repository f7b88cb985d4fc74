"""One query per operator, over the whole benchmark tables. Columns are named as in ``checks``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe.functions import text as tx
from docketframe.functions import urls
from docketframe.operators import extract, numbers, refs, rows, summary
from docketframe.plans import jobs
from docketframe.schema import ROW_COLUMNS
from docketframe.session import scratch_path
from docketframe.sources import csv_sink, pages as page_source, progress
from docketframe.streaming import incremental
from workloads import raw, tables
from workloads.tables import table


# Text functions -----------------------------------------------------------------------------------

def clean_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", tx.clean_text(F.col("text")).alias("clean"))


def placeholder_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = f"CASE WHEN c_custkey % 3 = 0 THEN {raw.name_line('c_custkey')} ELSE {raw.pick('c_custkey', raw.PLACEHOLDER_LINES)} END"
    lines = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{line} AS line")
    return lines.select("c_custkey", "line").where(~tx.names_nobody(F.col("line")))


def normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{raw.FILED_RAW} AS filed_raw")
    return orders.select("o_orderkey", tx.normalize_date(F.col("filed_raw")).alias("filed"))


def norm_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{raw.pick('p_partkey', raw.TOKENS)} AS token")
    return tokens.select("p_partkey", "token", tx.norm_suffix(F.col("token")).alias("suffix"))


def split_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{raw.odd_name('o_orderkey + o_custkey')} AS line"
    )
    return lines.select("o_orderkey", tx.split_name(F.col("line")).alias("name")).select("o_orderkey", "name.*")


def split_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = raw.pick("l_suppkey", ["\n", " \r\n ", "\n\n\t\n", f"{raw.NBSP}\n{raw.NBSP}", ""])
    cell = f"concat(' ', {raw.EVENT_DATE_RAW}, {gap}, {raw.EVENT_PLACE}, '\n', 'Floor  ', l_returnflag, '\n ')"
    cells = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", f"{cell} AS cell"
    )
    parts = tx.split_stacked(F.col("cell"))
    return cells.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        parts["date"].alias("date"), parts["location"].alias("location"),
    )


def format_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = tables.flat_events(spark, sf_dir)
    return items.select(
        "o_orderkey", "place", tx.format_event(F.struct("date", "description", "location")).alias("event")
    )


# Children, explosion, rows ------------------------------------------------------------------------

def events_primary_cont(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_cells(spark, sf_dir)


def explode_attorneys(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = tables.case_heads(spark, sf_dir).select(
        "o_orderkey", F.posexplode_outer(rows.listed_pairs(tables.listed_parties())).alias("pair_pos", "pair")
    )
    return exploded.select(
        "o_orderkey",
        F.coalesce("pair_pos", F.lit(0)).cast("bigint").alias("pair_pos"),
        tx.clean_text(F.col("pair.role")).alias("party_role"),
        tx.split_name(F.col("pair.line")).alias("name"),
    ).select("o_orderkey", "pair_pos", "party_role", "name.*")


def _final(case_rows: DataFrame, stored: bool = False) -> DataFrame:
    return jobs.in_order(case_rows, stored).select(*ROW_COLUMNS)


def attorney_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(tables.flat_case_rows(spark, sf_dir))


def nested_case_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(rows.nested_case_rows(rows.nested_cases(tables.listed_cases(spark, sf_dir))))


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row three times, once with a later place; the earliest place must survive."""
    once = tables.flat_case_rows(spark, sf_dir)
    copies = once.withColumn("later", F.explode(F.array(F.lit(1), F.lit(0), F.lit(0))))
    kept = rows.distinct_rows(copies.withColumn("row_ord", (F.col("row_ord") + F.col("later")).cast("decimal(38,0)")))
    return kept.select(*ROW_COLUMNS, F.col("row_ord").cast("string").alias("row_ord"))


def stable_sort_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rows.sorted_positions(rows.distinct_rows(tables.flat_case_rows(spark, sf_dir)))
    return ranked.select("position", "case_number", "last_name", "first_name", "middle_name", "suffix", "party_role")


# Pages of the benchmark ---------------------------------------------------------------------------

_SITES = [
    {
        "key": site,
        "county": f"Site {site}",
        "adapter": adapter,
        "base_url": f"https://records.invalid/{site}",
        "court": "",
        "selectors": {"search_result_link": "nav li a", "case_root": "article", "case_style": "h1"},
        "search_pages": ["results_1"],
        "sequences": [],
        "county_ord": order,
    }
    for order, (site, adapter) in enumerate(
        [("com", "aspnet_public_access"), ("net", "aspnet_public_access"), ("org", "nav_by_pattern")]
    )
]


def _site() -> F.Column:
    """Host of a page: .com, .net, and all others together."""
    known = F.regexp_extract("url", r"^https?://[^/?#]*\.(com|net)(?::[0-9]+)?(?:[/?#]|$)", 1)
    return F.when(known == "", "org").otherwise(known)


def _site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pages table with the site as county and the page id as page key."""
    return table(spark, sf_dir, "pages").select(
        _site().alias("county_key"), F.col("page_id").cast("string").alias("page_key"), "html"
    )


def nav_by_pattern(pages: DataFrame, counties: list[dict]) -> DataFrame:
    """A user's own reference step: link texts by one regular expression, no Python at all."""
    links = F.regexp_extract_all("html", F.lit(r'<li><a href="[^"]*">([^<]*)</a>'), F.lit(1))
    return (
        pages.select("county_key", "page_key", F.posexplode(links).alias("ref_pos", "ref"))
        .select("county_key", "page_key", "ref_pos", tx.clean_text(F.col("ref")).alias("case_ref"))
        .where(F.length("case_ref") > 0)
    )


extract.register_layout("nav_by_pattern", extract.Layout(refs=nav_by_pattern, cases=extract.styled_cases, style=extract.GRID))


def _page_refs(spark: SparkSession, sf_dir: str, adapter: str | None = None) -> DataFrame:
    sites = [{**site, "adapter": adapter or site["adapter"]} for site in _SITES]
    return extract.extract_refs(_site_pages(spark, sf_dir), sites)


def page_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links found by selector."""
    return _page_refs(spark, sf_dir, "aspnet_public_access")


def page_refs_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links found by pattern, inside the JVM."""
    return _page_refs(spark, sf_dir, "nav_by_pattern")


def user_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two named extractions in one run, chosen per site."""
    found = _page_refs(spark, sf_dir)
    return found.groupBy("county_key", "page_key").agg(F.count(F.lit(1)).alias("n_refs"))


def user_extraction_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links found by selector, asked for in SQL by the adapter's name."""
    extract.register_table_functions(spark, [{**site, "adapter": "aspnet_public_access"} for site in _SITES])
    pages = _site_pages(spark, sf_dir)
    return spark.sql(
        "SELECT p.county_key, p.page_key, r.ref_pos, r.case_ref FROM {pages} p JOIN county_questions c USING (county_key),"
        " LATERAL aspnet_public_access_refs(p.html, c.refs_question) r", pages=pages,
    )


def page_first_seen_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _page_refs(spark, sf_dir, "nav_by_pattern").withColumn("page_ord", F.col("page_key").cast("int"))
    return refs.first_seen(listed).select("county_key", "case_ref", "page_ord", "ref_pos")


def page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root and style of the block layout, retargeted to article and h1."""
    sites = [{**site, "adapter": "js_portal"} for site in _SITES]
    return extract.extract_cases(_site_pages(spark, sf_dir), sites).select("county_key", "page_key", "case_name")


def page_key_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.page_key(F.col("url")).alias("page_key"))


def build_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.concat(F.lit("https://records.invalid/n"), F.col("n_nationkey").cast("string"))
    return tables.orders_with_counties(spark, sf_dir).select(
        "o_orderkey",
        urls.search_url(base, F.concat(F.lit("results_"), F.expr(f"o_orderkey div {raw.BLOCK}").cast("string"))).alias("search_url"),
        urls.case_url(base, F.expr(raw.CASE_REF)).alias("case_url"),
    )


def refs_join_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as references, joined to the pages whose key they lead to on any site."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", _site().alias("county_key"), urls.page_key(F.col("url")).alias("page_key")
    )
    site_of_part = F.expr(raw.pick("p_partkey", ["com", "net", "org"]))
    parts = table(spark, sf_dir, "part").select(
        site_of_part.alias("county_key"), F.col("p_partkey").cast("string").alias("case_ref"),
        F.lit(0).alias("page_ord"), F.lit(0).alias("ref_pos"),
    )
    known = refs.with_case_page(parts, _SITES)
    return known.join(pages, ["county_key", "page_key"]).select("county", "case_ref", "page_id")


# Progress -----------------------------------------------------------------------------------------

def skip_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders not final yet: the final ones are done."""
    orders = table(spark, sf_dir, "orders")
    listed = orders.select(
        F.col("o_orderpriority").alias("county_key"), F.col("o_orderkey").cast("string").alias("case_ref")
    )
    done = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderpriority").alias("county_key"), F.col("o_orderkey").cast("string").alias("n")
    )
    return refs.skip_done(listed, done)


def skip_done_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label."""
    listed = table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("county_key"), F.col("doc_id").cast("string").alias("case_ref")
    )
    done = table(spark, sf_dir, "labels").select(
        F.lit("documents").alias("county_key"), F.col("doc_id").cast("string").alias("n")
    )
    return refs.skip_done(listed, done).select("case_ref")


def _written_progress(spark: SparkSession, sf_dir: str) -> str:
    """Progress lines of all documents as text: some torn, some without ``n``, some blank, many repeated."""
    line = raw.pick("doc_id", ["good", "good", "torn", "good", "other", "blank", "good"])
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "lang", f"{line} AS state")
    good = F.concat(F.lit('{"n": "'), F.col("doc_id").cast("string"), F.lit('"}'))
    shape = (
        F.when(F.col("state") == "good", good)
        .when(F.col("state") == "torn", F.concat(F.lit('{"n": "'), F.col("doc_id").cast("string")))
        .when(F.col("state") == "other", F.concat(F.lit('{"m": '), F.col("doc_id").cast("string"), F.lit("}")))
        .otherwise(" ")
    )
    path = scratch_path(spark, "progress")
    lines = docs.select(F.col("lang").alias("county_key"), shape.alias("value"))
    lines.unionByName(lines).write.partitionBy("county_key").text(path)
    return path


def checkpoint_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.read_done(spark, _written_progress(spark, sf_dir)).select("county_key", "n")


def completed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.completed_count(progress.read_done(spark, _written_progress(spark, sf_dir)))


# Candidate numbers --------------------------------------------------------------------------------

_NO_RANGES = "CAST(NULL AS map<string,struct<start:bigint,end:bigint>>)"


def _specs(customers: DataFrame, kind: str, **columns: str) -> DataFrame:
    shape = {
        "county_key": "concat('n', CAST(c_nationkey AS STRING))",
        "spec_ord": "CAST(c_custkey AS BIGINT)",
        "pattern": f"'{kind}'",
        "template": "'{branch}/{seq}.{suffix}'",
        "start": "c_custkey * 5 + 1",
        "end": "c_custkey * 5 + 1 + c_custkey % 7",
        "width": "CAST(NULL AS INT)",
        "suffixes": "CAST(NULL AS array<string>)",
        "per_suffix_ranges": _NO_RANGES,
        "extra": "map('branch', lpad(CAST(c_custkey % 3 AS STRING), 2, '0'))",
        **columns,
    }
    return customers.selectExpr(*[f"{value} AS `{name}`" for name, value in shape.items()])


def plain_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spec per customer, widths from 1 to 6; ranges of neighbours overlap."""
    return _specs(table(spark, sf_dir, "customer"), "plain", width="CAST(1 + c_custkey % 6 AS INT)")


def letter_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd customers name their suffixes, the others use the default ones."""
    return _specs(
        table(spark, sf_dir, "customer"), "letter_suffix",
        suffixes="CASE WHEN c_custkey % 2 = 1 THEN array('X', 'B', 'Z') ELSE array() END",
    )


def suffix_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges for E and G, and for one suffix that the alphabet lacks."""
    return _specs(
        table(spark, sf_dir, "customer"), "per_suffix",
        suffixes="array('G', 'F', 'E')",
        per_suffix_ranges=(
            "map('E', struct(c_custkey AS start, c_custkey + 2 AS end),"
            " 'G', struct(c_custkey * 2 AS start, c_custkey * 2 + c_custkey % 3 AS end),"
            " 'Q', struct(1L AS start, 9L AS end))"
        ),
    )


def _enumerated(specs: DataFrame) -> DataFrame:
    found = numbers.expand(numbers.runs(specs))
    return found.select("county_key", "case_number", F.col("ordinal").cast("string").alias("ordinal"))


def case_numbers_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enumerated(plain_specs(spark, sf_dir))


def case_numbers_letter_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enumerated(letter_specs(spark, sf_dir))


def case_numbers_per_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enumerated(suffix_specs(spark, sf_dir))


def _all_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("spec_ord") * 3
    return (
        plain_specs(spark, sf_dir).withColumn("spec_ord", third)
        .unionByName(letter_specs(spark, sf_dir).withColumn("spec_ord", third + 1))
        .unionByName(suffix_specs(spark, sf_dir).withColumn("spec_ord", third + 2))
    )


def case_numbers_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jobs.candidate_numbers(_all_specs(spark, sf_dir))
    return found.select("county_key", "case_number", F.col("ordinal").cast("string").alias("ordinal"))


def case_numbers_dedup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.number_counts(jobs.candidate_numbers(_all_specs(spark, sf_dir)))


def invalid_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = _specs(
        table(spark, sf_dir, "customer"), "plain",
        pattern=raw.pick("c_custkey", ["plain", "letter_suffix", "per_suffix", "zigzag", "per_suffix"]),
        start="CASE WHEN c_custkey % 7 = 0 THEN CAST(NULL AS BIGINT) ELSE c_custkey % 11 END",
        end="CASE WHEN c_custkey % 6 = 0 THEN CAST(NULL AS BIGINT) ELSE c_custkey % 13 END",
        per_suffix_ranges=(
            "CASE WHEN c_custkey % 10 < 5 THEN map('A', struct(c_custkey % 4 AS start, c_custkey % 3 AS end)) END"
        ),
    )
    return numbers.spec_errors(specs).select(
        "spec_ord", "county_key", "start", "end",
        F.coalesce("problem", F.lit("")).alias("problem"),
    )


# Whole jobs ---------------------------------------------------------------------------------------

def county_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = tables.listed_cases(spark, sf_dir)
    found = summary.run_summary(cases)
    return found.withColumn("county", F.coalesce("county", F.lit("all")))


def header_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.extracted_cases(spark, sf_dir).select(
        "county_key", "page_key", "case_number", "case_name", "filing_date", "case_type", "status",
        F.coalesce("court", F.lit("(none)")).alias("court"),
    )


def parties_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.extracted_cases(spark, sf_dir).select("page_key", F.posexplode("parties").alias("party_pos", "party"))
    named = found.select("page_key", "party_pos", "party.name", "party.role", F.posexplode_outer("party.lines").alias("line_pos", "line"))
    return named.select(
        "page_key", F.col("party_pos").cast("bigint").alias("party_pos"), "name", "role",
        F.coalesce("line_pos", F.lit(-1)).cast("bigint").alias("line_pos"), tx.clean_text(F.col("line")).alias("line"),
    )


def events_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables.extracted_cases(spark, sf_dir).select("page_key", F.posexplode("events").alias("event_pos", "event"))
    return found.select("page_key", F.col("event_pos").cast("bigint").alias("event_pos"), "event.*")


def listed_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of all rendered results pages, each at its first place."""
    found = refs.listed_refs(
        tables.result_pages(spark, sf_dir), tables.counties(spark, sf_dir), tables.search_pages(spark, sf_dir)
    )
    return refs.first_seen(found).select("county_key", "case_ref", F.col("page_ord").cast("bigint").alias("page_ord"))


def attorney_rows_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = jobs.cases_from_pages(
        tables.all_pages(spark, sf_dir), tables.counties(spark, sf_dir), tables.search_pages(spark, sf_dir)
    )
    return _final(rows.listed_case_rows(cases))


def _faulty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of orders in progress are missing, urgent ones have no content."""
    marked = table(spark, sf_dir, "orders").selectExpr(f"{raw.CASE_REF} AS case_ref", "o_orderstatus", "o_orderpriority")
    heads = tables.case_heads(spark, sf_dir).join(marked, "case_ref").where("o_orderstatus <> 'P'")  # before their pages are made
    cases = tables.case_pages(spark, sf_dir, heads, keep=["o_orderpriority"])
    faulty = cases.withColumn("html", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("html")))
    return faulty.drop("o_orderpriority").unionByName(tables.result_pages(spark, sf_dir))


def quarantine_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed reference with its state."""
    visited = jobs.cases_from_pages(
        _faulty_pages(spark, sf_dir), tables.counties(spark, sf_dir), tables.search_pages(spark, sf_dir), keep_all=True
    )
    return visited.select("county_key", "case_ref", "state")


def results_page_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every configured results page with its state; some are missing, some have no content."""
    pages = tables.result_pages(spark, sf_dir).withColumn("block", F.regexp_extract("page_key", "[0-9]+", 0).cast("int"))
    pages = pages.where("block % 5 <> 3").withColumn("html", F.when(F.col("block") % 5 != 1, F.col("html"))).drop("block")
    found = refs.results_page_states(pages, tables.counties(spark, sf_dir), tables.search_pages(spark, sf_dir))
    return found.select("county_key", F.col("page_ord").cast("bigint").alias("page_ord"), "state", F.coalesce("error", F.lit("")).alias("error"))


def page_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a page, for case pages and results pages of which some are spoilt in each known way."""
    counties = tables.counties(spark, sf_dir)
    cases = tables.case_pages(spark, sf_dir).withColumn("spoilt", F.expr("CAST(regexp_extract(page_key, '[0-9]+', 0) AS BIGINT) % 7"))
    results = tables.result_pages(spark, sf_dir).withColumn("spoilt", F.expr("CAST(regexp_extract(page_key, '[0-9]+', 0) AS BIGINT) % 7"))
    html = F.expr(
        "CASE spoilt WHEN 0 THEN NULL WHEN 1 THEN left(html, length(html) - 9) WHEN 2 THEN replace(html, '<body>', '<body>\ufffd')"
        " WHEN 3 THEN '<html><body><p>moved</p></body></html>'"
        " WHEN 4 THEN '<html><table id=\"grdParties\"><tr class=\"party-row\"><td>x</td></tr></table></html>' ELSE html END"
    )
    both = [
        extract.page_faults(pages.withColumn("html", html), counties, kind).withColumn("kind", F.lit(kind))
        for pages, kind in ((cases, "case"), (results, "search"))
    ]
    return both[0].unionByName(both[1]).select("kind", "county_key", "page_key", F.coalesce("fault", F.lit("")).alias("fault"))


def _spread_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of all parts, dealt out while narrow: in their small file they are one task's, and so would be the pages made of them.

    The number of partitions is named, since keys alone are so few bytes that adaptive execution would put them together again.
    """
    return table(spark, sf_dir, "part").select("p_partkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")


def unclosed_and_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages per part without most end tags, with tables in cells, blocks in blocks and end tags that end nothing."""
    key = F.col("p_partkey").cast("string")
    n = (F.col("p_partkey") % 4 + 1).cast("int")
    cell = F.concat(F.lit("<td>"), key, F.lit("<table><tr><td>in</table>"))
    grid = F.concat(
        F.lit('<table id=grdParties><tr class=party-row>'), F.repeat(cell, n), F.lit("</div></b><tr class='party-row x'><td>a<td>b<td>c</table><td>out"),
    )
    block = F.concat(
        F.lit("<main><div class=case-detail data-case-number='"), key, F.lit("'><h1 class=case-style>s &amp; t</h1></main><section class='parties'>"),
        F.repeat(F.concat(F.lit("<div class=party data-role=r><div></div></span><span class=party-name>"), key, F.lit("</span><ul class=attorneys><li>A B<li>C <i>D</ul></div>")), n),
        F.lit("</section><div class=party><span class=party-name>none</span></div>"),
    )
    pages = _spread_parts(spark, sf_dir).select(
        F.explode(F.array(F.struct(F.lit("n0").alias("county_key"), grid.alias("html")), F.struct(F.lit("n1").alias("county_key"), block.alias("html")))).alias("page"),
        key.alias("page_key"),
    ).select("page.county_key", "page_key", "page.html")
    found = extract.extract_cases(pages, [c for c in tables.counties(spark, sf_dir) if c["key"] in ("n0", "n1")])
    first = F.get("parties", F.lit(0))
    return found.select(
        "county_key", "page_key", "case_name", F.size("parties").cast("bigint").alias("parties"),
        F.coalesce(first["name"], F.lit("")).alias("name"), F.array_join(first["lines"], "|").alias("lines"),
    )


def resume_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over faulty pages, a second with all pages there: only what was not attempted is added."""
    counties, listing = tables.counties(spark, sf_dir), tables.search_pages(spark, sf_dir)
    rows_path, done_path = scratch_path(spark, "rows"), scratch_path(spark, "done")
    jobs.resume(_faulty_pages(spark, sf_dir), counties, rows_path, done_path, listing)
    second = jobs.resume(tables.all_pages(spark, sf_dir), counties, rows_path, done_path, listing)
    table_now = spark.read.parquet(rows_path).groupBy("county").agg(F.countDistinct("case_ref").alias("cases"))
    return table_now.withColumn("added_by_second_run", F.lit(second).cast("bigint"))


def _landed_in_turn(spark: SparkSession, sf_dir: str, pages: DataFrame) -> tuple[str, str]:
    """Later results pages and the grid counties' pages land first, all others after them. Returns rows and checkpoint."""
    counties, listing = tables.counties(spark, sf_dir), tables.search_pages(spark, sf_dir)
    landing, out, state = (scratch_path(spark, name) for name in ("landing", "rows", "stream"))
    number = "CAST(regexp_extract(page_key, '[0-9]+', 0) AS BIGINT)"
    first = F.expr(f"CASE WHEN kind = 'search' THEN {number} % 2 = 1 ELSE CAST(substr(county_key, 2) AS INT) % 2 = 0 END")
    for landed in (pages.where(first), pages.where(~first)):
        page_source.write_pages(landed, landing)
        incremental.run_available(spark, landing, counties, out, state, listing)
    return out, state


def incremental_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all pages, none twice, each at the place that a run over all pages at once gives it."""
    stored = incremental.stored_rows(spark, *_landed_in_turn(spark, sf_dir, tables.all_pages(spark, sf_dir)))
    return rows.distinct_rows(stored).select(*ROW_COLUMNS, F.col("row_ord").cast("string").alias("row_ord"))


def incremental_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed reference with its state in the stream."""
    return incremental.reference_states(spark, _landed_in_turn(spark, sf_dir, _faulty_pages(spark, sf_dir))[1])


def _two_versions(spark: SparkSession, sf_dir: str) -> str:
    """A landing table where every third case page landed with another status before."""
    landing = scratch_path(spark, "landing")
    pages = tables.all_pages(spark, sf_dir)
    old = F.expr("regexp_replace(html, '(Status:?(?:</td><td class=\"value\">|</dt><dd>))[A-Z]', '$1STALE')")
    early = pages.where("kind = 'case' AND CAST(regexp_extract(page_key, '[0-9]+', 0) AS BIGINT) % 3 = 0")
    page_source.write_pages(early.withColumn("html", old), landing)
    page_source.write_pages(pages, landing)
    return landing


def newest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every case once, from the version of its page that landed last."""
    landed = page_source.read_pages(spark, _two_versions(spark, sf_dir))
    cases = jobs.cases_from_pages(landed, tables.counties(spark, sf_dir), tables.search_pages(spark, sf_dir))
    return cases.select("county_key", "case_ref", "status")


def incremental_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the stream, both versions in one batch."""
    out, state = scratch_path(spark, "rows"), scratch_path(spark, "stream")
    counties, listing = tables.counties(spark, sf_dir), tables.search_pages(spark, sf_dir)
    incremental.run_available(spark, _two_versions(spark, sf_dir), counties, out, state, listing)
    return incremental.added_rows(spark, out, state).groupBy("county_key", "case_ref").agg(F.max("status").alias("status"))


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as written to CSV and read back."""
    path = scratch_path(spark, "csv")
    return csv_sink.write_csv(_final(tables.flat_case_rows(spark, sf_dir), stored=True), path)


def csv_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table under its exported names, as written to CSV and read back."""
    return csv_sink.write_csv(jobs.finish(tables.flat_case_rows(spark, sf_dir), stored=True), scratch_path(spark, "csv"))


def csv_of_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export of orders that have no rows: each file holds the header alone."""
    path = scratch_path(spark, "csv")
    none = tables.flat_case_rows(spark, sf_dir).where("case_number LIKE 'no such %'")
    written = csv_sink.write_csv(jobs.finish(none), path)
    header = spark.read.text(path).distinct()
    return header.select(F.col("value").alias("header"), F.lit(written.count()).cast("bigint").alias("n_rows"))


def candidate_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three specs per customer, listed over all nations, with each county's count and each number's place."""
    counties = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("county_key"), F.col("n_nationkey").alias("county_ord"),
        F.concat("n_name", F.lit(" County")).alias("county"),
    )
    return rows.with_positions(jobs.listing_of(_all_specs(spark, sf_dir), counties))


def number_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's ranges of order numbers, some without end and some twice, against the orders that are there."""
    orders = tables.orders_with_counties(spark, sf_dir).selectExpr(f"{raw.COUNTY_KEY} AS county_key", "o_orderkey AS seq", "n_nationkey AS n")
    ranges = orders.groupBy("county_key", "n").agg(F.max("seq").alias("most")).selectExpr(
        "county_key",
        "explode(array(struct(CAST(n * 10 AS BIGINT) AS lo, most - n * 7 AS hi), struct(5L AS lo, CAST(n AS BIGINT) AS hi), struct(1L AS lo, 40L AS hi))) AS part",
    )
    return numbers.number_gaps(ranges.select("county_key", "part.lo", "part.hi"), orders, chunk=1000)


def stored_party_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The party each stored row belongs to."""
    found = rows.listed_case_rows(tables.listed_cases(spark, sf_dir))
    return found.select("case_ref", "party_role", "party_name", "last_name")


def rows_and_attributes_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid page and a block page per part, with short rows, cards without their attribute, and parts without a root."""
    key = F.col("p_partkey").cast("string")
    cells = F.concat(F.lit("<td>"), key, F.lit("</td>"))
    grid = F.concat(
        F.lit('<table id="grdParties"><tr class="party-row"><td>only</td><td>two</td></tr><tr class="party-row">'),
        F.repeat(cells, (F.col("p_partkey") % 4 + 1).cast("int")), F.lit('</tr></table><table id="grdEvents"><tr class="event-row">'),
        F.repeat(cells, (F.col("p_partkey") % 3).cast("int")), F.lit("</tr></table>"),
    )
    role = F.when(F.col("p_partkey") % 2 == 0, ' data-role="Plaintiff"').otherwise("")
    body = F.concat(F.lit('<section class="parties"><div class="party"'), role, F.lit('><span class="party-name">'), key, F.lit("</span></div></section>"))
    root = F.concat(F.lit('<div class="case-detail" data-case-number="'), key, F.lit('"><h1 class="case-style">s</h1></div>'))
    block = F.concat(F.when(F.col("p_partkey") % 5 > 0, root).otherwise("<p>none</p>"), body)
    pages = _spread_parts(spark, sf_dir).select(
        F.explode(F.array(F.struct(F.lit("n0").alias("county_key"), grid.alias("html")), F.struct(F.lit("n1").alias("county_key"), block.alias("html")))).alias("page"),
        key.alias("page_key"),
    ).select("page.county_key", "page_key", "page.html")
    found = extract.extract_cases(pages, [c for c in tables.counties(spark, sf_dir) if c["key"] in ("n0", "n1")])
    first = F.get("parties", F.lit(0))
    return found.select(
        "county_key", "page_key", F.coalesce("case_number", F.lit("")).alias("case_number"), F.size("parties").cast("bigint").alias("parties"),
        F.size("events").cast("bigint").alias("events"), F.coalesce(first["name"], F.lit("")).alias("name"), F.coalesce(first["role"], F.lit("")).alias("role"),
    )


QUERIES = {
    function.__name__: function
    for function in (
        clean_text_documents, placeholder_filter, normalize_dates, norm_suffix, split_names, split_stacked,
        format_events, events_primary_cont, explode_attorneys, attorney_rows, nested_case_rows, dedup_rows,
        stable_sort_rank, page_refs, page_refs_by_pattern, user_extraction, page_first_seen_refs, page_headings,
        page_key_from_url, build_urls, refs_join_pages, skip_done, skip_done_documents, checkpoint_scan,
        completed_count, case_numbers_plain, case_numbers_letter_suffix, case_numbers_per_suffix,
        case_numbers_listing, case_numbers_dedup_count, invalid_specs, county_summary, header_from_pages,
        parties_from_pages, events_from_pages, listed_refs, attorney_rows_from_pages, quarantine_pages,
        results_page_states,        resume_rows, incremental_pages, incremental_states, csv_export, csv_titles, candidate_listing, rows_and_attributes_left_out,
        page_faults, unclosed_and_nested, newest_pages, incremental_versions,
        number_gaps, stored_party_names, user_extraction_sql, csv_of_nothing,
    )
}
