"""Page extraction by column expressions over the HTML as it lies, and cleaning of what they find.

``LAYOUTS`` maps an adapter key to the DataFrame functions of that page style.
Own styles are added with :func:`register_layout`; they may use any DataFrame code.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe import schema
from docketframe.functions import html as markup
from docketframe.functions import text as tx
from docketframe.functions import urls
from docketframe.operators import layouts
from docketframe.sources.config import local_frame

_REFS_RAW = "array<string>"
_CASE_RAW = (
    f"struct<listed_ref:string,style:string,header:{schema.PAIRS_DDL},"
    f"parties:{schema.LISTED_PARTIES_DDL},events:{schema.EVENTS_DDL},fault:string>"
)
#: Configuration that goes to every task at once.
CONFIGURATION_BYTES = 64 << 20
#: Counties up to which the scan is told their keys.
NAMED_COUNTIES = 64


@dataclass(frozen=True)
class Style:
    """What is asked of pages of one style, how the answers are read, and which labels their header fields go by."""

    name: str
    asked_refs: list
    asked_case: list
    read_refs: Callable[[], str]
    read_case: Callable[[], str]
    selectors: dict[str, str]
    label: Callable[[Column], Column]
    fields: Callable[[], dict[str, Column]]


@dataclass(frozen=True)
class Layout:
    """The steps of one kind of portal.

    ``refs(pages, counties)`` gives ``county_key, page_key, ref_pos, case_ref``;
    ``cases(pages, counties)`` gives ``county_key, page_key``, the header fields,
    ``parties`` with raw attorney lines, ``events``, ``error`` and, where it can
    tell, ``fault``. A null ``case_number`` or ``court`` means "not on the page". The URL steps take and
    return columns. Counties whose layouts share a step function are given to it
    together, so their pages are read in one pass.
    """

    refs: Callable[[DataFrame, list[dict]], DataFrame]
    cases: Callable[[DataFrame, list[dict]], DataFrame]
    search_url: Callable[[Column, Column], Column] = urls.search_url
    case_url: Callable[[Column, Column], Column] = urls.case_url
    style: Style | None = None  # read by the styled_* steps


def chosen_selectors(county: dict, defaults: dict[str, str]) -> dict[str, str]:
    """Selectors of a county, configured ones before the defaults."""
    return {**defaults, **{k: str(v) for k, v in county["selectors"].items() if k in defaults}}


def _questions(county: dict, step: str) -> tuple:
    """What is asked of the county's pages, as data. Bad selectors fail here, on the driver."""
    style = get_layout(county["adapter"]).style
    chosen = chosen_selectors(county, style.selectors)
    asked = style.asked_refs if step == "refs" else style.asked_case
    question = markup.question([([chosen[name] for name in outer], [chosen[name] for name in parts]) for outer, parts in asked])
    return county["key"], style.name, question, chosen.get("party_role_attr", "")


def question_frames(spark: SparkSession, counties: list[dict], step: str) -> list[DataFrame]:
    """One row per county with what is asked of its pages, in frames of ``CONFIGURATION_BYTES`` at most."""
    parts, size = [[]], 0
    for county in counties:
        row = _questions(county, step)
        size += sum(map(len, row))
        if size > CONFIGURATION_BYTES and parts[-1]:
            parts.append([])
            size = 0
        parts[-1].append(row)
    return [local_frame(spark, rows, "county_key string, page_style string, question string, party_role_attr string") for rows in parts]


def _raw_fault(html: Column) -> Column:
    """What can be told of a page before it is read."""
    ended = F.endswith(html, F.lit("</html>")) | F.rlike(html, F.lit(r"(?i)</html\s*>"))  # the usual end is looked for first
    last = F.substring_index(html, "<", -1)
    inside_tag = (F.octet_length(last) < F.octet_length(html)) & F.rlike(last, F.lit(r"^[A-Za-z/!][^>]*\z"))
    cut_off = (F.rlike(html, F.lit(r"(?i)<html[\s>]")) & ~ended) | inside_tag
    return F.when(html.isNull(), "empty").when(F.contains(html, F.lit("\ufffd")), "undecodable").when(cut_off, "truncated")


def _read_pages(pages: DataFrame, counties: list[dict], step: str, kind: str) -> DataFrame:
    """``county_key, page_key, page_style, found, raw_fault``: every page read by its county's style and selectors.

    What to look for is a table that is joined to the pages where these lie, so the plan does not grow with the number
    of counties. Each page is scanned once, whatever the number of selectors. A null page holds nothing.
    """
    styles = {style.name: style for style in _styles(counties).values()}
    parts = []
    for asked in question_frames(pages.sparkSession, counties, step):
        known = pages.select("county_key", "page_key", "html", *_landing(pages)).join(F.broadcast(asked), "county_key")  # of a checked size
        elements = known.withColumn("found", F.coalesce(markup.select("html", "question"), F.expr("array(array(), array(), array(), array())")))
        found = F.lit(None).cast(kind)
        for name, style in styles.items():
            read = style.read_refs if step == "refs" else style.read_case
            found = F.when(F.col("page_style") == name, F.expr(read()).cast(kind)).otherwise(found)
        # Generated, so that what is found is computed once, however often the columns behind use it.
        parts.append(elements.select("county_key", "page_key", "page_style", *_landing(pages), _raw_fault(F.col("html")).alias("raw_fault"), F.explode(F.array(found)).alias("found")))
    return reduce(DataFrame.unionByName, parts)


def _landing(pages: DataFrame) -> list[str]:
    """Where pages know when they landed, what is read from them does too."""
    return ["landed"] if "landed" in pages.columns else []


def _styles(counties: list[dict]) -> dict[str, Style]:
    return {county["key"]: get_layout(county["adapter"]).style for county in counties}


def _error(fault: Column) -> Column:
    """Set where a page cannot be read at all."""
    return F.when(fault == "empty", "page has no content")


def styled_refs(pages: DataFrame, counties: list[dict]) -> DataFrame:
    """References on results pages of any built-in style."""
    return (
        _read_pages(pages, counties, "refs", _REFS_RAW)
        .select("county_key", "page_key", *_landing(pages), F.posexplode("found").alias("ref_pos", "ref"))
        .select("county_key", "page_key", *_landing(pages), "ref_pos", tx.clean_text(F.col("ref")).alias("case_ref"))
        .where(F.length("case_ref") > 0)
    )


def page_faults(pages: DataFrame, counties: list[dict], kind: str = "case") -> DataFrame:
    """``county_key, page_key, fault`` of results pages (``kind`` search) or case pages; fault is null for sound ones.

    ``empty``: no content. ``undecodable``: holds the sign that stands for bytes that are no text. ``truncated``: ends
    inside a tag or before the end of its document. ``no root``: nothing of what the layout starts from. ``short rows``:
    rows, but none with enough cells. ``no references``: a results page that lists none. The first that fits is given;
    all but ``empty`` pages are still read for what they hold.
    """
    if kind == "search":
        found = _read_pages(_of_kind(pages, kind), counties, "refs", _REFS_RAW)
        own = F.when(F.size(F.filter("found", lambda ref: tx.clean_text(ref) != "")) == 0, "no references")
    else:
        found, own = _read_pages(_of_kind(pages, kind), counties, "case", _CASE_RAW), F.col("found.fault")
    return found.select("county_key", "page_key", F.coalesce("raw_fault", own).alias("fault"))


def header_value(label: str) -> Column:
    """Value of a label in the cleaned ``header`` pairs: the last one wins, null if the label is absent."""
    return F.try_element_at(F.filter("header", lambda pair: pair["label"] == label), F.lit(-1))["value"]


def first_label(*labels: str) -> Column:
    """The first label that is present at all; a present but empty value counts."""
    return F.coalesce(*[header_value(label) for label in labels])


def clean_events(events: Column) -> Column:
    """Raw event cells to ISO date, description and location; a location of its own goes before a stacked one."""

    def tidy(event: Column) -> Column:
        return tx.bind(
            F.struct(tx.split_stacked(event["date"]).alias("cell"), tx.clean_text(event["location"]).alias("own")),
            lambda place: F.struct(
                tx.normalize_clean_date(place["cell"]["date"]).alias("date"),
                tx.clean_text(event["description"]).alias("description"),
                F.when(place["own"] != "", place["own"]).otherwise(place["cell"]["location"]).alias("location"),
            ),
        )

    return F.transform(events, tidy)


def clean_parties(parties: Column) -> Column:
    """Names and roles cleaned; attorney lines kept as text, without those that name nobody."""
    return F.transform(
        parties,
        lambda party: F.struct(
            tx.clean_text(party["name"]).alias("name"),
            tx.clean_text(party["role"]).alias("role"),
            F.filter(party["lines"], lambda line: ~tx.names_nobody(line)).alias("lines"),
        ),
    )


def styled_cases(pages: DataFrame, counties: list[dict]) -> DataFrame:
    """Case records of pages of any built-in style."""
    used = {style.name: style for style in _styles(counties).values()}

    def own(choice: Callable[[Style], Column]) -> Column:
        """What each row's own style chooses."""
        chosen = None
        for name, style in used.items():
            column = choice(style)
            chosen = column if chosen is None else F.when(F.col("page_style") == name, column).otherwise(chosen)
        return chosen

    def field(name: str) -> Column:
        return own(lambda style: style.fields()[name])

    header = F.transform(
        "header",
        lambda pair: F.struct(
            own(lambda style: style.label(pair["label"])).alias("label"), tx.clean_text(pair["value"]).alias("value")
        ),
    )
    return (
        _read_pages(pages, counties, "case", _CASE_RAW)
        .select("county_key", "page_key", "page_style", *_landing(pages), "found.*", "raw_fault")
        .withColumn("header", header)
        .withColumn("fault", F.coalesce("raw_fault", "fault"))
        .select(
            "county_key",
            "page_key",
            field("case_number").alias("case_number"),
            F.coalesce(field("case_name"), F.lit("")).alias("case_name"),
            tx.normalize_date(F.coalesce(field("filing_date"), F.lit(""))).alias("filing_date"),
            F.coalesce(field("case_type"), F.lit("")).alias("case_type"),
            F.coalesce(first_label("status"), F.lit("")).alias("status"),
            first_label("court").alias("court"),
            clean_parties(F.col("parties")).alias("parties"),
            clean_events(F.col("events")).alias("events"),
            _error(F.col("fault")).alias("error"),
            "fault",
            *_landing(pages),
        )
    )


def _grid_fields() -> dict[str, Column]:
    return {
        "case_number": first_label("case number"),
        "case_name": first_label("style", "case name"),
        "filing_date": first_label("date filed", "filed"),
        "case_type": first_label("case type", "type"),
    }


def _block_fields() -> dict[str, Column]:
    listed = tx.clean_text(F.col("listed_ref"))
    return {
        "case_number": F.when(listed != "", listed),  # an empty number on the page counts as absent
        "case_name": tx.clean_text(F.col("style")),
        "filing_date": first_label("filed", "date filed"),
        "case_type": first_label("type", "case type"),
    }


GRID = Style(
    "grid", layouts.GRID_REFS_ASKED, layouts.GRID_CASE_ASKED, layouts.grid_refs, layouts.grid_case, {**layouts.GRID_SELECTORS, **layouts.GRID_CELLS},
    label=tx.label_key, fields=_grid_fields,
)
BLOCK = Style(
    "block", layouts.BLOCK_REFS_ASKED, layouts.BLOCK_CASE_ASKED, layouts.block_refs, layouts.block_case, {**layouts.BLOCK_SELECTORS, **layouts.BLOCK_CELLS},
    label=lambda term: F.lower(tx.clean_text(term)), fields=_block_fields,
)

LAYOUTS: dict[str, Layout] = {
    "aspnet_public_access": Layout(refs=styled_refs, cases=styled_cases, style=GRID),
    "js_portal": Layout(refs=styled_refs, cases=styled_cases, style=BLOCK),
}


def register_layout(key: str, layout: Layout) -> None:
    """Make a page style available under ``key``; a known key is replaced."""
    LAYOUTS[key] = layout


def get_layout(key: str) -> Layout:
    if key not in LAYOUTS:
        raise KeyError(f"unknown adapter {key!r}; registered adapters: {sorted(LAYOUTS)}")
    return LAYOUTS[key]


def by_layout(counties: list[dict]) -> dict[str, list[dict]]:
    """Counties per adapter key. Unknown keys are an error before any job starts."""
    groups: dict[str, list[dict]] = {}
    for county in counties:
        get_layout(county["adapter"])
        groups.setdefault(county["adapter"], []).append(county)
    return groups


def _of_kind(pages: DataFrame, kind: str) -> DataFrame:
    """Only results or only case pages, where the table tells them apart (best as a partition column)."""
    return pages.where(F.col("kind") == kind) if "kind" in pages.columns else pages


def _extract(step: str, kind: str, pages: DataFrame, counties: list[dict]) -> DataFrame:
    """One branch per step function in use, each reading only its counties' pages."""
    groups: dict[Callable, list[dict]] = {}
    for adapter, members in by_layout(counties).items():
        groups.setdefault(getattr(get_layout(adapter), step), []).extend(members)
    wanted = _of_kind(pages, kind)
    parts = [_of_counties(wanted, members).transform(function, members) for function, members in groups.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def _of_counties(pages: DataFrame, members: list[dict]) -> DataFrame:
    """Pages of some counties: by a join that keeps the plan short, and for few of them by the scan's own filter too."""
    keys = [(member["key"],) for member in members]
    if len(keys) <= NAMED_COUNTIES:
        return pages.where(F.col("county_key").isin([key for key, in keys]))
    return pages.join(F.broadcast(local_frame(pages.sparkSession, keys, "county_key string")), "county_key", "left_semi")  # keys the driver holds


def extract_refs(pages: DataFrame, counties: list[dict]) -> DataFrame:
    """References listed on results pages, with their place on the page."""
    return _extract("refs", "search", pages, counties)


def extract_cases(pages: DataFrame, counties: list[dict]) -> DataFrame:
    """Header, parties and events of case pages."""
    return _extract("cases", "case", pages, counties)


def register_table_functions(spark: SparkSession, counties: list[dict], view: str = "county_questions") -> None:
    """The built-in extractions as SQL table functions, named after the adapters in use.

    ``<adapter>_refs(html, question)`` gives ``ref_pos, case_ref``; ``<adapter>_case(html, question, role_attribute)``
    gives one row with what a case page holds, uncleaned. The view has a row per county: ``county_key, adapter,
    refs_question, case_question, role_attribute``. Use them in a LATERAL join of pages and view::

        SELECT p.page_key, r.* FROM pages p JOIN county_questions c USING (county_key), LATERAL js_portal_refs(p.html, c.refs_question) r

    A query so written has the plan of the DataFrame call: pages are read where they lie.
    """
    rows = []
    for county in counties:
        key, _, refs, _ = _questions(county, "refs")
        _, _, case, role = _questions(county, "case")
        rows.append((key, county["adapter"], refs, case, role))
    ddl = "county_key string, adapter string, refs_question string, case_question string, role_attribute string"
    local_frame(spark, rows, ddl).createOrReplaceTempView(view)
    spark.udf.register("docketframe_elements", markup.select)
    for adapter in by_layout(counties):
        style = get_layout(adapter).style
        found = "SELECT docketframe_elements(html, question) AS found, html"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {adapter}_refs(html STRING, question STRING) RETURNS TABLE (ref_pos INT, case_ref STRING) RETURN"
            f" SELECT pos, case_ref FROM (SELECT pos, {tx.clean_text_sql('col')} AS case_ref FROM (SELECT posexplode({style.read_refs()}) FROM ({found})))"
            " WHERE case_ref <> ''"
        )
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {adapter}_case(html STRING, question STRING, party_role_attr STRING)"
            f" RETURNS TABLE (listed_ref STRING, style STRING, header {schema.PAIRS_DDL}, parties {schema.LISTED_PARTIES_DDL}, events {schema.EVENTS_DDL}, fault STRING)"
            f" RETURN SELECT case.* FROM (SELECT {style.read_case()} AS case FROM ({found}))"
        )
