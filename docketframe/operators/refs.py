"""Case references: listing order, first seen, skipping, and the join to their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketframe.functions import urls
from docketframe.operators.extract import by_layout, extract_refs, get_layout
from docketframe.session import materialize
from docketframe.sources.config import counties_frame

#: Ranges of page keys that a scan is narrowed to.
RANGES = 64


def listing_order(page_ord: Column, ref_pos: Column) -> Column:
    """Results page, then place on it, as one bigint: an aggregate over it stays a hash aggregate."""
    return F.shiftleft(page_ord.cast("bigint"), 32).bitwiseOR(ref_pos.cast("bigint"))


def first_seen(refs: DataFrame) -> DataFrame:
    """Each reference once per county, at its first place in listing order.

    ``min`` is combined before the shuffle, so a reference listed everywhere moves as one row per task.
    """
    place = listing_order(F.col("page_ord"), F.col("ref_pos"))
    return (
        refs.groupBy("county_key", "case_ref")
        .agg(F.min(place).alias("place"))
        .select("county_key", "case_ref", *from_listing_order(F.col("place")))
    )


def from_listing_order(place: Column) -> list[Column]:
    """Results page and place on it again."""
    return [
        F.shiftright(place, 32).cast("int").alias("page_ord"),
        place.bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint")).cast("int").alias("ref_pos"),
    ]


def newest_only(found: DataFrame, pages: DataFrame, kind: str) -> DataFrame:
    """What was read from the version of each page that landed last, where ``pages`` know when they ``landed``.

    Versions are told apart by page key and landing order alone; only pages with more than one are joined.
    """
    if "landed" not in pages.columns or "landed" not in found.columns:
        return found
    there = pages.where(F.col("kind") == kind) if "kind" in pages.columns else pages
    several = there.groupBy("county_key", "page_key").agg(F.max("landed").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return found.join(several, ["county_key", "page_key"], "left").where("last is null or landed = last").drop("last", "landed")


def _layout_url(step: str, counties: list[dict], part: Column) -> Column:
    """The URL step of each row's own adapter."""
    url = F.lit(None).cast("string")
    for adapter in by_layout(counties):
        made = getattr(get_layout(adapter), step)(F.col("base_url"), part)
        url = F.when(F.col("adapter") == adapter, made).otherwise(url)
    return url


def listed_refs(pages: DataFrame, counties: list[dict], search_pages: DataFrame) -> DataFrame:
    """All references on the configured results pages. Results pages that are not there are passed over.

    Pages are read as they lie, and only the references are joined to the listing. Where the table does not tell results
    pages apart (``kind``), case pages are read for references too.
    """
    base = counties_frame(pages.sparkSession, counties)
    url = _layout_url("search_url", counties, F.col("page"))
    listing = search_pages.join(base, "county_key").select(
        "county_key", "page_ord", urls.page_key(url).alias("page_key")
    )
    return (
        newest_only(extract_refs(pages, counties), pages, "search")
        .join(listing, ["county_key", "page_key"])
        .select("county_key", "case_ref", "page_ord", "ref_pos")
    )


def results_page_states(pages: DataFrame, counties: list[dict], search_pages: DataFrame) -> DataFrame:
    """Every configured results page: county_key, page_ord, page, state (ok, missing, failed) and error."""
    base = counties_frame(pages.sparkSession, counties)
    url = _layout_url("search_url", counties, F.col("page"))
    listing = search_pages.join(base, "county_key").select("county_key", "page_ord", "page", urls.page_key(url).alias("page_key"))
    there = pages.where("kind = 'search'") if "kind" in pages.columns else pages
    found = there.groupBy("county_key", "page_key").agg(F.max(F.col("html").isNotNull()).alias("read"))
    state = F.when(F.col("read").isNull(), "missing").when(F.col("read"), "ok").otherwise("failed")
    return listing.join(found, ["county_key", "page_key"], "left").select(
        "county_key", "page_ord", "page", state.alias("state"), F.when(state == "failed", "page has no content").alias("error")
    )


def skip_done(refs: DataFrame, done: DataFrame) -> DataFrame:
    """References not yet attempted, per county. Spark broadcasts ``done`` only while its own size limit allows."""
    known = done.select("county_key", F.col("n").alias("case_ref"))
    return refs.join(known, ["county_key", "case_ref"], "left_anti")


def with_case_page(refs: DataFrame, counties: list[dict]) -> DataFrame:
    """Adds county fields and the key of the page each reference leads to."""
    known = counties_frame(refs.sparkSession, counties)
    url = _layout_url("case_url", counties, F.col("case_ref"))
    return (
        refs.join(known, "county_key")
        .withColumn("page_key", urls.page_key(url))
        .drop("base_url", "adapter")
        .withColumnRenamed("court", "default_court")
    )


def visit(refs: DataFrame, records: DataFrame, counties: list[dict], keep_all: bool = False) -> DataFrame:
    """References with what their pages hold, and ``state``: ok, missing or failed.

    ``records`` are extracted pages: pages are read where they lie and only the
    records are shuffled, never the HTML. ``keep_all`` also returns missing and
    failed ones. Where ``refs`` say which version of its page landed ``last``,
    ``records`` may hold others too; they are left out as records are met.
    """
    known = with_case_page(refs, counties)
    found = records.withColumn("found", F.lit(True))
    visited = known.join(found, ["county_key", "page_key"], "left" if keep_all else "inner")
    if "last" in refs.columns and "landed" in records.columns:
        visited = visited.where("found is null or landed = last")
    state = (
        F.when(F.col("found").isNull(), "missing").when(F.col("error").isNotNull(), "failed").otherwise("ok")
    )
    cases = visited.select(
        "county_key",
        "county",
        "case_ref",
        F.coalesce("case_number", "case_ref").alias("case_number"),
        "case_name",
        "filing_date",
        "case_type",
        "status",
        F.coalesce("court", "default_court").alias("court"),
        "parties",
        "events",
        "county_ord",
        "page_ord",
        "ref_pos",
        state.alias("state"),
        "error",
        *(["fault"] if "fault" in records.columns else []),
    )
    return cases if keep_all else cases.where("state = 'ok'")


def only_pages_of(refs: DataFrame, pages: DataFrame, counties: list[dict]) -> tuple[DataFrame, DataFrame]:
    """Narrow ``pages`` to ranges of page keys that hold what the references lead to, before any HTML is read.

    ``RANGES`` ranges at most go into the filter of the scan, which Parquet's statistics answer by row group where pages
    lie in the order of their keys (``write_pages``). HTML is never joined.
    """
    refs = materialize(refs)
    keys = with_case_page(refs, counties).select("page_key").distinct()
    cut = keys.repartitionByRange(RANGES, "page_key").groupBy(F.spark_partition_id()).agg(F.min("page_key").alias("low"), F.max("page_key").alias("high"))
    ranges = [(row["low"], row["high"]) for row in cut.where("low is not null").orderBy("low").collect()]
    return refs, pages.where(_in_ranges(F.col("page_key"), ranges))


def _in_ranges(key: Column, ranges: list[tuple[str, str]]) -> Column:
    """True where ``key`` lies in one of some ranges in order, by halving them: a key that is derived is worked out a few times, not once a range."""
    if len(ranges) < 2:
        return key.between(*ranges[0]) if ranges else F.lit(False)
    half = len(ranges) // 2
    low = ranges[half][0]
    return ((key < low) & _in_ranges(key, ranges[:half])) | ((key >= low) & _in_ranges(key, ranges[half:]))
