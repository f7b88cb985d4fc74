"""Cases to output rows: one per attorney, distinct, in a stable order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketframe.functions import text as tx
from docketframe.operators.refs import listing_order
from docketframe.schema import CASE_SCALARS, OUTPUT_COLUMNS, ROW_COLUMNS, SORT_COLUMNS
from docketframe.session import scratch_path

_EXACT = T.DecimalType(38, 0)


def event_columns(events: Column) -> tuple[Column, Column]:
    """First event that renders to text, and the others joined by ``; ``. Both '' if there is none."""
    rendered = F.filter(F.transform(events, tx.format_event), lambda line: line != "")
    return split_rendered(rendered)


def split_rendered(rendered: Column) -> tuple[Column, Column]:
    lines = F.coalesce(rendered, F.array().cast("array<string>"))
    others = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.coalesce(F.get(lines, F.lit(0)), F.lit("")), F.array_join(others, "; ")


def listed_pairs(parties: Column) -> Column:
    """(role, attorney line, party name) over all parties, in party order then line order."""
    return F.flatten(
        F.transform(
            parties,
            lambda party: F.transform(
                party["lines"], lambda line: F.struct(party["role"].alias("role"), line.alias("line"), party["name"].alias("party_name"))
            ),
        )
    )


def attorney_pairs(parties: Column) -> Column:
    """(role, attorney) over all parties of a nested case, in party order then attorney order."""
    return F.flatten(
        F.transform(
            parties,
            lambda party: F.transform(
                party["attorneys"],
                lambda attorney: F.struct(party["role"].alias("role"), attorney.alias("attorney"), party["name"].alias("party_name")),
            ),
        )
    )


def first_seen_order(county_ord: Column, page_ord: Column, ref_pos: Column, pair_pos: Column) -> Column:
    """County, results page, place on it, place in the case: one exact number of at most 38 digits.

    A decimal keeps ``min`` in a hash aggregate; a struct would force sorting 14 text columns.
    """
    place = listing_order(page_ord, ref_pos)  # below 10**19
    return (
        county_ord.cast(_EXACT) * F.lit(Decimal(10**29))
        + place.cast(_EXACT) * F.lit(Decimal(10**10))
        + pair_pos.cast(_EXACT)
    ).cast(_EXACT)


def _explode(cases: DataFrame, pairs: Column, keep: list[str]) -> DataFrame:
    """Event text is made once per case; only then is the case repeated per pair, or kept once without one."""
    primary, others = event_columns(F.col("events"))
    return cases.select(
        "county_key",
        "case_ref",
        *[tx.clean_text(F.col(name)).alias(name) for name in CASE_SCALARS],
        primary.alias("events_primary"),
        others.alias("events_cont"),
        "county_ord",
        "page_ord",
        "ref_pos",
        *[name for name in keep if name != "pair_pos"],
        pairs.alias("pairs"),
    ).select("*", F.posexplode_outer("pairs").alias("pair_pos", "pair")).drop("pairs")


def _order_column() -> Column:
    return first_seen_order(
        F.col("county_ord"), F.col("page_ord"), F.col("ref_pos"), F.coalesce("pair_pos", F.lit(0))
    ).alias("row_ord")


def listed_case_rows(cases: DataFrame, keep: list[str] = []) -> DataFrame:
    """Rows of cases whose parties hold attorney lines as text; names are split after the explosion.

    ``keep`` names columns of the case to carry along, or ``pair_pos``. The party's name is kept on the stored row (``party_name``, null without an attorney); the exported table leaves it out.
    """
    exploded = _explode(cases, listed_pairs(F.col("parties")), keep)
    named = exploded.withColumn("name", tx.split_name(F.col("pair.line")))
    return named.select(
        "county_key",
        "case_ref",
        *CASE_SCALARS,
        "name.*",
        tx.clean_text(F.col("pair.role")).alias("party_role"),
        "events_primary",
        "events_cont",
        tx.clean_text(F.col("pair.party_name")).alias("party_name"),
        _order_column(),
        *keep,
    )


def nested_case_rows(cases: DataFrame, keep: list[str] = []) -> DataFrame:
    """Rows of cases in the nested form, attorneys already split."""
    exploded = _explode(cases, attorney_pairs(F.col("parties")), keep)
    parts = ["first_name", "middle_name", "last_name", "suffix"]
    return exploded.select(
        "county_key",
        "case_ref",
        *CASE_SCALARS,
        *[tx.clean_text(F.col("pair.attorney")[part]).alias(part) for part in parts],
        tx.clean_text(F.col("pair.role")).alias("party_role"),
        "events_primary",
        "events_cont",
        tx.clean_text(F.col("pair.party_name")).alias("party_name"),
        _order_column(),
        *keep,
    )


def nested_cases(cases: DataFrame) -> DataFrame:
    """The nested case model: attorney lines split into names."""
    parties = F.transform(
        "parties",
        lambda party: F.struct(
            party["name"].alias("name"),
            party["role"].alias("role"),
            F.transform(party["lines"], tx.split_name).alias("attorneys"),
        ),
    )
    return cases.withColumn("parties", parties)


def whole_row() -> list[Column]:
    """The columns by which rows are equal; null counts as empty."""
    return [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ROW_COLUMNS]


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Fully equal rows once, with the earliest place. Copies are combined before the shuffle."""
    return rows.select(*whole_row(), "row_ord").groupBy(*ROW_COLUMNS).agg(F.min("row_ord").alias("row_ord"))


def sort_rows(rows: DataFrame) -> DataFrame:
    """County, case number, last name, first name; ties in first-seen order."""
    return rows.orderBy(*SORT_COLUMNS, "row_ord")


def output_table(rows: DataFrame) -> DataFrame:
    """The 14 contractual columns under their exported names."""
    return rows.select(*[F.col(name).alias(title) for name, title in OUTPUT_COLUMNS.items()])


def sorted_positions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``position``, their 0-based index in the sorted table."""
    return with_positions(sort_rows(rows))


def with_positions(ordered: DataFrame) -> DataFrame:
    """An ordered table with ``position``, the 0-based index of each row, without a single-task sort.

    Each sorted range numbers its own rows and is written to the shared folder
    once, as compressed columns, so that what is read later is only what is
    asked for; the sizes of the ranges before it (one number per range) are
    added. One shuffle in all. Rows come back in the order of the files: sort by
    ``position`` where the order itself matters.
    """
    path = scratch_path(ordered.sparkSession, "ranges")
    ordered.select(
        "*",
        F.spark_partition_id().alias("range"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("within"),
    ).write.parquet(path)
    numbered = ordered.sparkSession.read.parquet(path)
    sizes = numbered.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    before = (F.sum("size").over(Window.orderBy("range")) - F.col("size")).alias("rows_before")
    return (
        numbered.join(F.broadcast(sizes.select("range", before)), "range")
        .withColumn("position", F.col("rows_before") + F.col("within"))
        .drop("range", "within", "rows_before")
    )
