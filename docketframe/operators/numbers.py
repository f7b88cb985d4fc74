"""Candidate case numbers from range specifications.

Every pattern becomes *runs* (one suffix, one range), runs become chunks of
bounded length, and chunks are spread over the cluster before they are
expanded, so one huge range is not one task's work.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketframe import schema
from docketframe.functions.text import zero_pad
from docketframe.sources.config import local_frame

# Pattern names, suffixes used where a spec names none, defaults.
PATTERNS = ["plain", "letter_suffix", "per_suffix"]
DEFAULT_SUFFIXES = ["A", "B", "C", "D", "E", "F", "G", "H"]
DEFAULT_START, DEFAULT_END, DEFAULT_WIDTH = 1, 1, 6

CHUNK = 65_536  # numbers expanded per chunk row
# A place in emission order: the spec, then the place within it, as one exact number.
_EXACT = T.DecimalType(38, 0)
_SPEC_STEP = Decimal(10**19)

# Stand-ins for the two per-number fields; noncharacters, never part of text.
_SEQ, _SUFFIX = "\ufdd0", "\ufdd1"
_PIECES = r"\{\{|\}\}|\{[^{}]*\}|[^{}]+|[{}]"


def specs_frame(spark: SparkSession, counties: Iterable[Mapping]) -> DataFrame:
    """Specs of configuration entries as a table; missing settings stay null."""
    rows = []
    for county in counties:
        for order, spec in enumerate(county["sequences"]):
            ranges = spec.get("per_suffix_ranges") or {}
            rows.append(
                (
                    county["key"],
                    order,
                    spec.get("pattern"),
                    spec.get("template"),
                    None if spec.get("start") is None else int(spec["start"]),
                    None if spec.get("end") is None else int(spec["end"]),
                    None if spec.get("width") is None else int(spec["width"]),
                    [str(s) for s in spec.get("suffixes") or []],
                    [(str(k), {"start": int(v["start"]), "end": int(v["end"])}) for k, v in ranges.items()],
                    [(str(k), str(v)) for k, v in (spec.get("extra") or {}).items()],
                )
            )
    return local_frame(spark, rows, schema.SPECS_DDL)


def with_defaults(specs: DataFrame) -> DataFrame:
    """Missing start, end, width and suffixes filled in; an empty suffix list counts as missing."""
    letters = F.array(*[F.lit(letter) for letter in DEFAULT_SUFFIXES])
    return specs.select(
        "county_key",
        F.col("spec_ord").cast("bigint").alias("spec_ord"),
        "pattern",
        "template",
        F.coalesce(F.col("start").cast("bigint"), F.lit(DEFAULT_START)).alias("start"),
        F.coalesce(F.col("end").cast("bigint"), F.lit(DEFAULT_END)).alias("end"),
        F.coalesce(F.col("width").cast("int"), F.lit(DEFAULT_WIDTH)).alias("width"),
        F.when(F.size(F.coalesce("suffixes", F.array())) > 0, F.col("suffixes")).otherwise(letters).alias("suffixes"),
        F.coalesce(
            "per_suffix_ranges", F.create_map().cast("map<string,struct<start:bigint,end:bigint>>")
        ).alias("per_suffix_ranges"),
        F.coalesce("extra", F.create_map().cast("map<string,string>")).alias("extra"),
    )


def _pieces() -> Column:
    return F.regexp_extract_all("template", F.lit(_PIECES), F.lit(0))


def spec_problem() -> Column:
    """Why a spec (after :func:`with_defaults`) cannot be enumerated; null if it can."""
    ranges = F.map_entries("per_suffix_ranges")
    backward = F.filter(ranges, lambda e: e["value"]["start"] > e["value"]["end"])
    bad = F.get(backward, F.lit(0))
    fields = F.filter(_pieces(), lambda p: p.rlike(r"^\{[^{}]*\}$") | p.isin("{", "}"))
    known = F.concat(
        F.array(F.lit("{seq}"), F.lit("{suffix}")),
        F.transform(F.map_keys("extra"), lambda k: F.concat(F.lit("{"), k, F.lit("}"))),
    )
    unknown = F.get(F.array_except(fields, known), F.lit(0))
    single_range = F.col("pattern").isin("plain", "letter_suffix")
    per_suffix = F.col("pattern") == "per_suffix"
    return (
        F.when(
            F.col("pattern").isNull() | ~F.col("pattern").isin(PATTERNS),
            F.concat(
                F.lit("no such pattern: '"),
                F.coalesce("pattern", F.lit("")),
                F.lit("' (there are " + ", ".join(PATTERNS) + ")"),
            ),
        )
        .when(
            single_range & (F.col("start") > F.col("end")),
            F.concat(
                F.lit("range runs backwards: "), F.col("start").cast("string"), F.lit(" to "), F.col("end").cast("string"),
            ),
        )
        .when(per_suffix & (F.size(ranges) == 0), "no range for any suffix")
        .when(
            per_suffix & bad.isNotNull(),
            F.concat(
                F.lit("range of suffix "), bad["key"], F.lit(" runs backwards: "), bad["value"]["start"].cast("string"),
                F.lit(" to "), bad["value"]["end"].cast("string"),
            ),
        )
        .when(F.col("template").isNull(), "template is missing")
        .when(F.arrays_overlap(F.map_keys("extra"), F.array(F.lit("seq"), F.lit("suffix"))), "extra redefines seq or suffix")
        .when(unknown.isNotNull(), F.concat(F.lit("template field without a value: "), unknown))
    )


def _span(lo: Column, hi: Column) -> Column:
    return hi - lo + 1


def _suffix_spans() -> Column:
    """Length of each suffix's own range, 0 where it has none."""

    def span(suffix: Column) -> Column:
        own = F.try_element_at("per_suffix_ranges", suffix)
        return F.coalesce(_span(own["start"], own["end"]), F.lit(0).cast("bigint"))

    return F.transform("suffixes", span)


def spec_errors(specs: DataFrame) -> DataFrame:
    """Every spec with ``problem``, null for the good ones."""
    return with_defaults(specs).withColumn("problem", spec_problem())


def _resolved_template() -> Column:
    """Constants filled in, doubled braces undone, the two per-number fields as stand-ins."""

    def resolve(piece: Column) -> Column:
        name = F.substring(piece, F.lit(2), F.length(piece) - 2)
        return (
            F.when(piece == "{{", "{")
            .when(piece == "}}", "}")
            .when(piece == "{seq}", _SEQ)
            .when(piece == "{suffix}", _SUFFIX)
            .when(piece.startswith("{"), F.try_element_at("extra", name))
            .otherwise(piece)
        )

    return F.array_join(F.transform(_pieces(), resolve), "")


def runs(specs: DataFrame) -> DataFrame:
    """One row per (spec, suffix, range). ``base + (seq - lo) * stride`` is a number's place within its spec.

    An invalid spec stops the job with its problem.
    """
    checked = with_defaults(specs).withColumn("problem", spec_problem())
    good = checked.withColumn(
        "pattern", F.when(F.col("problem").isNull(), F.col("pattern")).otherwise(F.raise_error(F.col("problem")))
    )
    whole = F.struct(
        F.lit("").alias("suffix"), F.col("start").alias("lo"), F.col("end").alias("hi"),
        F.lit(0).cast("bigint").alias("base"), F.lit(1).alias("stride"),
    )

    def crossed(suffix: Column, place: Column) -> Column:
        return F.struct(
            suffix.alias("suffix"), F.col("start").alias("lo"), F.col("end").alias("hi"),
            place.cast("bigint").alias("base"), F.size("suffixes").alias("stride"),
        )

    def own(suffix: Column, place: Column) -> Column:
        span = F.try_element_at("per_suffix_ranges", suffix)
        before = F.aggregate(
            F.slice(_suffix_spans(), F.lit(1), place), F.lit(0).cast("bigint"), lambda total, n: total + n
        )
        return F.struct(
            suffix.alias("suffix"), span["start"].alias("lo"), span["end"].alias("hi"),
            before.alias("base"), F.lit(1).alias("stride"),
        )

    spec_runs = (
        F.when(F.col("pattern") == "plain", F.array(whole))
        .when(F.col("pattern") == "letter_suffix", F.transform("suffixes", crossed))
        .otherwise(F.filter(F.transform("suffixes", own), lambda run: run["lo"].isNotNull()))
    )
    return good.select(
        "county_key", "spec_ord", "width", _resolved_template().alias("template"), F.explode(spec_runs).alias("run")
    ).select("county_key", "spec_ord", "width", "template", "run.*")


def expand(spec_runs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """All numbers of all runs with their ``ordinal`` in emission order."""
    last_chunk = F.floor((F.col("hi") - F.col("lo")) / chunk).cast("bigint")
    chunks = spec_runs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk))).repartition(
        "county_key", "spec_ord", "suffix", "part"
    )
    start = F.col("lo") + F.col("part") * chunk
    numbers = chunks.withColumn("seq", F.explode(F.sequence(start, F.least(F.col("hi"), start + (chunk - 1)))))
    digits = zero_pad(F.col("seq"), F.col("width"))
    number = F.replace(F.replace(F.col("template"), F.lit(_SEQ), digits), F.lit(_SUFFIX), F.col("suffix"))
    place = F.col("base") + (F.col("seq") - F.col("lo")) * F.col("stride")
    return numbers.select(
        "county_key",
        number.alias("case_number"),
        (F.col("spec_ord").cast(_EXACT) * F.lit(_SPEC_STEP) + place.cast(_EXACT)).cast(_EXACT).alias("ordinal"),
    )


def distinct_numbers(numbers: DataFrame) -> DataFrame:
    """Each number once per county, at its first place; combined before the shuffle."""
    return numbers.groupBy("county_key", "case_number").agg(F.min("ordinal").alias("ordinal"))


def number_counts(numbers: DataFrame) -> DataFrame:
    """Unique numbers per county (after :func:`distinct_numbers`)."""
    return numbers.groupBy("county_key").agg(F.count(F.lit(1)).alias("candidates"))


def number_gaps(expected: DataFrame, listed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Ranges of numbers on which enumeration and listing differ: county_key, side, first, last, n.

    ``expected`` (county_key, lo, hi) are ranges that were enumerated, ``listed`` (county_key, seq) numbers that were
    found; overlaps and copies count once, nulls and empty ranges not at all. ``side`` is ``missing`` for expected
    numbers that are not listed and ``unexpected`` for the reverse. Numbers are cut into chunks that are compared one by
    one, so a county with most numbers is spread; only the ends of what a chunk finds are then joined over its edges.
    In a chunk only the places where a range or a listed number begins or ends are put in order: what is expected is
    never written out number by number.
    """
    sound = expected.where("county_key is not null and lo <= hi")
    edges = F.sequence(F.floor(F.col("lo") / chunk), F.floor(F.col("hi") / chunk))
    parts = sound.select("county_key", "lo", "hi", F.explode(edges).alias("chunk")).repartition("county_key", "chunk")
    bounds = [F.greatest(F.col("lo"), F.col("chunk") * chunk).cast("bigint"), F.least(F.col("hi"), F.col("chunk") * chunk + (chunk - 1)).cast("bigint")]
    seq = F.col("seq").cast("bigint")
    found = listed.where("county_key is not null and seq is not null").select("county_key", F.floor(F.col("seq") / chunk).alias("chunk"), seq.alias("first"), seq.alias("last"))
    ranges = parts.select("county_key", "chunk", bounds[0].alias("first"), bounds[1].alias("last"))

    def ends(sides: DataFrame, expects: int, lists: int) -> DataFrame:
        """Where something begins and where it is over; what reaches the end of its chunk is over there."""
        changes = [F.struct(F.col("first").alias("at"), F.lit(expects).alias("expects"), F.lit(lists).alias("lists")),
                   F.when((F.col("last") + 1) % chunk != 0, F.struct((F.col("last") + 1).alias("at"), F.lit(-expects).alias("expects"), F.lit(-lists).alias("lists")))]
        return sides.select("county_key", "chunk", F.inline(F.filter(F.array(*changes), lambda change: change.isNotNull())))

    both = ends(ranges, 1, 0).unionByName(ends(found, 0, 1))
    places = both.groupBy("county_key", "chunk", "at").agg(F.sum("expects").alias("expects"), F.sum("lists").alias("lists"))
    within = Window.partitionBy("county_key", "chunk").orderBy("at")
    expects, lists = (F.sum(name).over(within) > 0 for name in ("expects", "lists"))
    side = F.when(expects & ~lists, 1).when(lists & ~expects, 2).otherwise(0)
    turns = places.select("county_key", "chunk", "at", side.alias("side")).withColumn("before", F.lag("side", 1, 0).over(within)).where("side <> before")
    over = F.lead("at").over(within)
    pieces = turns.select("county_key", "chunk", "side", F.col("at").alias("first"), (F.coalesce(over, (F.col("chunk") + 1) * chunk) - 1).alias("last")).where("side > 0").drop("chunk")
    # A piece goes on in the next chunk if it reaches its edge; only those at an edge are put in order.
    at_edge = (F.col("first") % chunk == 0) | ((F.col("last") + 1) % chunk == 0)
    inner = pieces.where(~at_edge).select("county_key", "side", "first", "last")
    over = Window.partitionBy("county_key", "side").orderBy("first")
    begins = F.coalesce(F.lag("last").over(over) + 1 != F.col("first"), F.lit(True))
    joined = pieces.where(at_edge).withColumn("begins", begins.cast("int")).withColumn("gap", F.sum("begins").over(over))
    edge = joined.groupBy("county_key", "side", "gap").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("gap")
    name = F.when(F.col("side") == 1, "missing").otherwise("unexpected")
    return inner.unionByName(edge).select("county_key", name.alias("side"), "first", "last", (F.col("last") - F.col("first") + 1).alias("n"))
