"""County configuration: a short list of mappings, as loaded from one file per county."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docketframe import schema

REQUIRED = ("key", "county", "adapter", "base_url", "selectors", "sequences")
DEFAULT_SEARCH_PAGES = ["results_1"]


def load_counties(entries: Iterable[Mapping]) -> list[dict]:
    """Checked configuration entries in run order, with defaults filled in."""
    counties = []
    for order, entry in enumerate(entries):
        missing = sorted(set(REQUIRED) - entry.keys())
        if missing:
            raise ValueError(f"a county lacks the settings {missing}")
        counties.append(
            {
                **entry,
                "county_ord": order,
                "court": entry.get("court", ""),
                "search_pages": entry.get("search_pages", DEFAULT_SEARCH_PAGES),
            }
        )
    if not counties:
        raise ValueError("the configuration lists no county")
    return counties


def local_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Driver-side rows as a local relation, whose exact size lets Spark choose broadcast or shuffle."""
    fields = to_arrow_schema(T.StructType.fromDDL(ddl))
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields))


def counties_frame(spark: SparkSession, counties: list[dict]) -> DataFrame:
    """One row per county."""
    rows = [
        (c["key"], c["county_ord"], c["county"], c["adapter"], c["base_url"], c["court"])
        for c in counties
    ]
    return local_frame(spark, rows, schema.COUNTIES_DDL)


def search_pages_frame(spark: SparkSession, counties: list[dict]) -> DataFrame:
    """One row per configured results page, in configured order."""
    rows = [(c["key"], order, page) for c in counties for order, page in enumerate(c["search_pages"])]
    return local_frame(spark, rows, schema.SEARCH_PAGES_DDL)
