"""Counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.operators import rows
from docketframe.schema import ROW_COLUMNS

_METRICS = ["cases", "parties", "attorneys", "rows_before_dedup", "rows"]


def run_summary(cases: DataFrame) -> DataFrame:
    """Cases, parties, attorneys, rows before and after dedup: per county, and in total (county null).

    ``cases`` hold parties with raw lines or with split attorneys; a case without attorneys makes one row. Every count is
    taken on the way: rows are made once, a case counts on its first row, and equal rows add up as they meet.
    """
    listed = "lines" in cases.select("parties").schema["parties"].dataType.elementType.names
    child = "lines" if listed else "attorneys"
    attorneys = F.aggregate(F.transform("parties", lambda party: F.size(party[child])), F.lit(0), lambda total, n: total + n)
    counted = cases.withColumn("n_parties", F.size("parties")).withColumn("n_attorneys", attorneys)
    make = rows.listed_case_rows if listed else rows.nested_case_rows
    made = make(counted, keep=["n_parties", "n_attorneys", "pair_pos"])
    first = F.coalesce("pair_pos", F.lit(0)) == 0
    own = {"cases": F.lit(1), "parties": F.col("n_parties"), "attorneys": F.col("n_attorneys")}
    once = made.select(*rows.whole_row(), *[F.when(first, value).otherwise(0).cast("bigint").alias(f"own_{name}") for name, value in own.items()])
    distinct = once.groupBy(*ROW_COLUMNS).agg(*[F.sum(f"own_{name}").alias(f"own_{name}") for name in own], F.count(F.lit(1)).alias("own_rows_before_dedup"))
    total = [F.sum(f"own_{name}").alias(name) for name in _METRICS[:-1]]
    per_county = distinct.groupBy("county").agg(*total, F.count(F.lit(1)).alias("rows"))
    return per_county.rollup("county").agg(*[F.sum(name).alias(name) for name in _METRICS])


def completed_count(done: DataFrame) -> DataFrame:
    """Distinct completed references per county."""
    return done.select("county_key", "n").distinct().groupBy("county_key").agg(F.count(F.lit(1)).alias("completed"))
