"""Progress: which references were attempted. JSON lines ``{"n": "<reference>"}``, one folder or file per county."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from docketframe import schema


def _usable(lines: DataFrame) -> DataFrame:
    """Blank and torn lines and records without ``n`` read as null and are skipped."""
    return lines.where(F.col("n").isNotNull()).distinct()


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """Progress table below ``path/county_key=<key>/``. A folder that does not exist yet is empty progress."""
    try:
        lines = spark.read.schema("n string, state string, county_key string").json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "county_key string, n string")
    return _usable(lines.select("county_key", "n"))


def read_done_files(spark: SparkSession, path: str) -> DataFrame:
    """Progress kept as one file per county, ``<path>/<county key>.jsonl``."""
    lines = spark.read.schema(schema.DONE_DDL).option("pathGlobFilter", "*.jsonl").json(path)
    key = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.jsonl$", 1)
    return _usable(lines.select(key.alias("county_key"), "n"))


def append_done(refs: DataFrame, path: str) -> None:
    """Add ``county_key, n[, state]`` records; earlier ones are left as they are."""
    refs.write.mode("append").partitionBy("county_key").json(path)


def reset_done(spark: SparkSession, path: str) -> None:
    """Forget all progress."""
    empty = spark.createDataFrame([], "n string, state string")
    empty.write.mode("overwrite").json(path)
