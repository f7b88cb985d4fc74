"""Pages: a table ``county_key, page_key, html`` and, where known, ``kind`` (``search`` or ``case``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe import schema
from docketframe.functions import urls
from docketframe.sources.config import counties_frame, search_pages_frame


def read_page_directory(spark: SparkSession, root: str, counties: list[dict] | None = None) -> DataFrame:
    """``<root>/<county key>/<page>.html``, one whole file per row.

    With ``counties`` their configured results pages are told from case pages (``kind``), so that each is read once.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.html")
        .text(root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    )
    # Paths are percent-encoded; a plus sign is itself.
    path = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    parts = F.split(path, "/")
    pages = files.select(F.element_at(parts, -2).alias("county_key"), F.element_at(parts, -1).alias("page_key"), "html")
    if counties is None:
        return pages
    listed = search_pages_frame(spark, counties).select("county_key", urls.page_key(F.col("page")).alias("page_key")).distinct()
    known = F.broadcast(listed.withColumn("listed", F.lit(True)))  # configuration, held by the driver
    kind = F.when(F.col("listed"), "search").otherwise("case")
    return pages.join(known, ["county_key", "page_key"], "left").select("county_key", "page_key", kind.alias("kind"), "html")


def page_table(pages: DataFrame, counties: list[dict]) -> DataFrame:
    """A table ``url, html`` in page form: the county whose base URL it lies under, page key, kind.

    Pages below no configured base URL are left out.
    """
    address = F.regexp_replace("url", "[?#].*$", "")
    known = counties_frame(pages.sparkSession, counties).select("county_key", "base_url")
    kind = F.regexp_extract(address, "/(Search|Case)/[^/]*$", 1)
    return (
        pages.withColumn("base_url", F.regexp_replace(address, "/(Search|Case)/[^/]*$", ""))
        .join(known, "base_url")
        .select("county_key", urls.page_key(F.col("url")).alias("page_key"), F.lower(kind).alias("kind"), "html")
    )


def write_pages(pages: DataFrame, path: str, rebalance: bool = False) -> None:
    """Add pages to a landing table partitioned by county and kind, so that each step reads only its own pages.

    ``rebalance`` first gathers the pages of a partition into files of even
    size (large partitions are split, small ones merged); worth its shuffle
    where the pages come from many small inputs. Pages lie in the order of
    their keys in each file, so that a scan for some keys passes over the rest.
    """
    if rebalance:
        pages = pages.hint("rebalance", "county_key", "kind")
    ordered = pages.sortWithinPartitions("county_key", "kind", "page_key")
    ordered.write.mode("append").partitionBy("county_key", "kind").parquet(path)


def with_landing_order(pages: DataFrame) -> DataFrame:
    """Pages of a file source with ``landed``: time and name of their file, place in it. The greatest version is the newest."""
    place = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return pages.select("*", place.alias("landed"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The landing table, each page with its landing order."""
    return with_landing_order(spark.read.schema(schema.LANDED_DDL).parquet(path))
