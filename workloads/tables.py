"""Case, row and page frames built by Spark from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe.functions import text as tx
from docketframe.operators import children, extract, rows
from docketframe.sources.config import load_counties
from workloads import raw


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows moved to their key while still narrow; the number of partitions is left to the session."""
    return df.repartition(*by)


def orders_with_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf_dir, "orders").drop("o_totalprice")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )


def case_heads(spark: SparkSession, sf_dir: str, by: str | None = None) -> DataFrame:
    """Case fields and listed parties of every order, without events. With ``by``, orders move there while narrow."""
    lines = ", ".join(raw.plaintiff_line(slot) for slot in range(3))
    orders = orders_with_counties(spark, sf_dir)
    return (spread(orders, by) if by else orders).selectExpr(
        "o_orderkey",
        f"{raw.COUNTY_KEY} AS county_key",
        f"{raw.COUNTY} AS county",
        "n_nationkey AS county_ord",
        f"{raw.CASE_REF} AS case_ref",
        f"{raw.CASE_NAME} AS case_name",
        f"{raw.FILED_RAW} AS filed_raw",
        "c_mktsegment AS case_type",
        "o_orderstatus AS status",
        f"{raw.COURT_RAW} AS court_raw",
        "c_name",
        f"filter(array({lines}), line -> line IS NOT NULL) AS plaintiff_lines",
        f"array({raw.DEFENDANT_LINE}) AS defendant_lines",
        f"CAST(o_orderkey div {raw.BLOCK} AS INT) AS block",
        f"CAST(o_orderkey % {raw.BLOCK} AS INT) AS block_pos",
    )


def raw_events(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    """Events as raw text. Items are moved to their order (``by``) while still narrow, and widened there."""
    items = table(spark, sf_dir, "lineitem").drop("l_extendedprice", "l_discount", "l_tax")
    return spread(items, *(by or ["l_orderkey"])).selectExpr(
        "l_orderkey AS o_orderkey",
        f"{raw.EVENT_ORDER} AS place",
        "l_linenumber AS line_place",
        f"{raw.EVENT_DATE_RAW} AS date_raw",
        f"{raw.EVENT_DESC} AS description",
        f"{raw.EVENT_PLACE} AS location",
    )


def flat_events(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    return raw_events(spark, sf_dir, *by).withColumn("date", tx.normalize_date(F.col("date_raw")))


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = flat_events(spark, sf_dir)  # all of an order in one place, so that gathering them moves nothing more
    return children.rendered_events(items, ["o_orderkey"], "line_place", together=True)


def listed_parties() -> F.Column:
    """Plaintiff and defendant with the lines that name an attorney."""
    party = "struct<name:string,role:string,lines:array<string>>"
    listed = F.array(
        F.struct(F.col("c_name").alias("name"), F.lit("Plaintiff").alias("role"), F.col("plaintiff_lines").alias("lines")).cast(party),
        F.struct(F.lit("State").alias("name"), F.lit("Defendant").alias("role"), F.col("defendant_lines").alias("lines")).cast(party),
    )
    return extract.clean_parties(listed)


def listed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with events as arrays: the form a page is extracted to, built from the tables directly."""
    event = F.struct("date", "description", "location")
    events = children.ordered_children(flat_events(spark, sf_dir), ["o_orderkey"], "place", event, "events")
    no_events = F.array().cast("array<struct<date:string,description:string,location:string>>")
    return (
        case_heads(spark, sf_dir, "o_orderkey")
        .join(events, "o_orderkey", "left")
        .select(
            "county_key", "county", "case_ref", F.col("case_ref").alias("case_number"), "case_name",
            tx.normalize_date(F.col("filed_raw")).alias("filing_date"), "case_type", "status",
            F.coalesce("court_raw", F.lit(raw.DEFAULT_COURT)).alias("court"),
            listed_parties().alias("parties"), F.coalesce("events", no_events).alias("events"),
            "county_ord", F.col("block").alias("page_ord"), F.col("block_pos").alias("ref_pos"),
        )
    )


def flat_case_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attorney rows of all orders; event text is made per item and gathered per order, then joined to the case.

    Text of the case is made once per case; only then is the case repeated per pair.
    """
    heads = case_heads(spark, sf_dir, "o_orderkey")
    cases = heads.join(event_cells(spark, sf_dir), "o_orderkey", "left").select(
        "county_key",
        "case_ref",
        tx.clean_text(F.col("county")).alias("county"),
        F.col("case_ref").alias("case_number"),
        tx.clean_text(F.col("case_name")).alias("case_name"),
        tx.normalize_date(F.col("filed_raw")).alias("filing_date"),
        "case_type",
        "status",
        F.coalesce("court_raw", F.lit(raw.DEFAULT_COURT)).alias("court"),
        "events_primary",
        "events_cont",
        "county_ord",
        "block",
        "block_pos",
        rows.listed_pairs(listed_parties()).alias("pairs"),
    )
    exploded = cases.select("*", F.posexplode_outer("pairs").alias("pair_pos", "pair")).drop("pairs")
    order = rows.first_seen_order(
        F.col("county_ord"), F.col("block"), F.col("block_pos"), F.coalesce("pair_pos", F.lit(0))
    )
    return exploded.withColumn("name", tx.split_name(F.col("pair.line"))).select(
        "county_key",
        "case_ref",
        "county",
        "case_number",
        "case_name",
        "filing_date",
        "case_type",
        "status",
        "court",
        "name.*",
        tx.clean_text(F.col("pair.role")).alias("party_role"),
        "events_primary",
        "events_cont",
        order.alias("row_ord"),
    )


def counties(spark: SparkSession, sf_dir: str) -> list[dict]:
    """One configuration entry per nation; the layouts alternate. ``load_counties`` checks the number of entries."""
    return load_counties(
        {
            "key": f"n{nation.n_nationkey}",
            "county": f"{nation.n_name} County",
            "adapter": "js_portal" if nation.n_nationkey % 2 else "aspnet_public_access",
            "base_url": f"https://records.invalid/n{nation.n_nationkey}",
            "court": raw.DEFAULT_COURT,
            "selectors": {},
            "sequences": [],
        }
        for nation in table(spark, sf_dir, "nation").orderBy("n_nationkey").toLocalIterator()
    )


def _html(column: str) -> F.Column:
    return F.replace(F.col(column), F.lit("&"), F.lit("&amp;"))


def _join(column: F.Column) -> F.Column:
    return F.array_join(column, "")


def _wrapped(lines: F.Column, before: str, after: str) -> F.Column:
    return F.transform(lines, lambda line: F.concat(F.lit(before), line, F.lit(after)))


def case_pages(spark: SparkSession, sf_dir: str, cases: DataFrame | None = None, keep: list[str] = []) -> DataFrame:
    """A detail page per order, in the layout of its county. Each page holds its own items only.

    ``cases`` are some of :func:`case_heads`, chosen before their pages are made; ``keep`` names columns of them to carry along.
    """
    grid = F.col("block_layout") == 0
    items = raw_events(spark, sf_dir)
    grid_event = F.concat(
        F.lit('<tr class="event-row"><td>'), F.col("date_raw"),
        F.when(F.col("location") != "", F.concat(F.lit("<br>\n "), F.col("location"))).otherwise(""),
        F.lit("</td><td>"), F.col("description"), F.lit("</td></tr>"),
    )
    block_event = F.concat(
        F.lit('<div class="event"><span class="event-date">'), F.col("date_raw"),
        F.lit('</span><span class="event-desc">'), F.col("description"),
        F.lit('</span><span class="event-loc">'), F.col("location"), F.lit("</span></div>"),
    )
    both = F.struct(grid_event.alias("grid"), block_event.alias("block"))
    events = children.ordered_children(items, ["o_orderkey"], "place", both, "events")

    def row(label: str, value: F.Column) -> F.Column:
        return F.concat(F.lit(f'<tr><td class="label">{label}:</td><td class="value">'), value, F.lit("</td></tr>\n"))

    def pair(term: str, value: F.Column) -> F.Column:
        return F.concat(F.lit(f"<dt>{term}</dt><dd>"), value, F.lit("</dd>\n"))

    grid_html = F.concat(
        F.lit('<!DOCTYPE html><!-- page --><html><body><div id="caseHeader"><table>'),
        row("Case Number", F.col("case_ref")), row("Style", _html("case_name")), row("Date Filed", F.col("filed_raw")),
        row("Status", F.lit("superseded")), row("Case Type", F.col("case_type")), row("Status", F.col("status")),
        F.coalesce(row("Court", F.col("court_raw")), F.lit("")),
        F.lit('</table></div><table id="grdParties"><tr><th>Party</th></tr><tr class="party-row"><td>'),
        _html("c_name"), F.lit("</td><td>Plaintiff</td><td>"), F.array_join("plaintiff_lines", "<br>"),
        F.lit('</td></tr><tr class="party-row"><td>State</td><td>Defendant</td><td>'),
        F.array_join("defendant_lines", "<br>"),
        F.lit('</td></tr></table><table id="grdEvents"><tr><th>Date</th></tr>'),
        _join(F.col("events.grid")), F.lit("</table></body></html>"),
    )
    block_html = F.concat(
        F.lit('<html><body><main><div class="case-detail" data-case-number="'), F.col("case_ref"),
        F.lit('"><h1 class="case-style">'), _html("case_name"), F.lit('</h1><dl class="case-meta">'),
        pair("Filed", F.col("filed_raw")), pair("Type", F.col("case_type")), pair("Status", F.col("status")),
        F.coalesce(pair("Court", F.col("court_raw")), F.lit("")),
        F.lit('</dl><section class="parties"><div class="party" data-role="Plaintiff"><span class="party-name">'),
        _html("c_name"), F.lit('</span><ul class="attorneys">'), _join(_wrapped(F.col("plaintiff_lines"), "<li>", "</li>")),
        F.lit('</ul></div><div class="party" data-role="Defendant"><span class="party-name">State</span><ul class="attorneys">'),
        _join(_wrapped(F.col("defendant_lines"), "<li>", "</li>")),
        F.lit('</ul></div></section><section class="events">'), _join(F.col("events.block")),
        F.lit("</section></div></main></body></html>"),
    )
    no_events = F.array().cast("array<struct<grid:string,block:string>>")
    heads = case_heads(spark, sf_dir, "o_orderkey") if cases is None else cases
    return (
        heads.withColumn("block_layout", F.col("county_ord") % 2)
        .join(events, "o_orderkey", "left")
        .withColumn("events", F.coalesce("events", no_events))
        .select(
            "county_key",
            F.concat("case_ref", F.lit(".html")).alias("page_key"),
            F.lit("case").alias("kind"),
            F.when(grid, grid_html).otherwise(block_html).alias("html"),
            *keep,
        )
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References and the results page they are on; every tenth order is listed on the next page as well."""
    heads = orders_with_counties(spark, sf_dir).selectExpr(
        "o_orderkey", f"{raw.COUNTY_KEY} AS county_key", "n_nationkey % 2 AS block_layout", f"{raw.CASE_REF} AS case_ref",
        f"CAST(o_orderkey div {raw.BLOCK} AS INT) AS block",
    )
    on_pages = F.when(
        F.col("o_orderkey") % 10 == 0, F.array(F.col("block"), F.col("block") + 1)
    ).otherwise(F.array(F.col("block")))
    return heads.withColumn("block", F.explode(on_pages))


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results pages. One page holds at most ``BLOCK`` order keys of one county, and a tenth of the block before."""
    link = F.when(
        F.col("block_layout") == 0,
        F.concat(F.lit('<tr><td><a class="case-link" href="#">'), F.col("case_ref"), F.lit("</a></td></tr>")),
    ).otherwise(F.concat(F.lit('<div class="result-card" data-case-number="'), F.col("case_ref"), F.lit('"></div>')))
    pages = children.ordered_children(
        spread(listing(spark, sf_dir), "county_key", "block"), ["county_key", "block_layout", "block"], "o_orderkey", link, "links"
    )
    grid = F.concat(F.lit('<html><body><table id="grdCases">'), _join(F.col("links")), F.lit("</table></body></html>"))
    block = F.concat(F.lit("<html><body><section>"), _join(F.col("links")), F.lit("</section></body></html>"))
    return pages.select(
        "county_key",
        F.concat(F.lit("results_"), F.col("block").cast("string"), F.lit(".html")).alias("page_key"),
        F.lit("search").alias("kind"),
        F.when(F.col("block_layout") == 0, grid).otherwise(block).alias("html"),
    )


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        listing(spark, sf_dir)
        .select("county_key", F.col("block").alias("page_ord"))
        .distinct()
        .withColumn("page", F.concat(F.lit("results_"), F.col("page_ord").cast("string")))
    )


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return case_pages(spark, sf_dir).unionByName(result_pages(spark, sf_dir))


def extracted_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_cases(case_pages(spark, sf_dir), counties(spark, sf_dir))
