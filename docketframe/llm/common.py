"""What the operators share: reading a table, writing a frame to the shared folder, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe.session import scratch_path

#: A word: a run of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, *columns) -> DataFrame:
    """The columns and a ``row_id`` unique in the frame, written once so that the number stays with its row."""
    return written(df.select(*columns, F.monotonically_increasing_id().alias("row_id")), name)


def row_key() -> Column:
    """What tells documents apart where whole rows are not numbered: id, source and text. Nulls are equal to nulls."""
    return F.struct("doc_id", "source", F.xxhash64("text")).alias("row_key")


def unused(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column starts with it."""
    while any(column.lower().startswith(name) for column in columns):
        name += "_"
    return name


def by_key(documents: DataFrame, keys: DataFrame, how: str, once: bool = False) -> DataFrame:
    """``documents`` joined to ``keys`` (row_key and what else it holds), one row a key if ``once``."""
    own = "row_key"
    while own in {column.lower() for column in documents.columns}:
        own += "_"
    joined = documents.withColumn(own, row_key()).join(keys.withColumnRenamed("row_key", own), own, how)
    return (joined.dropDuplicates([own]) if once else joined).drop(own)


def one_per_key(documents: DataFrame, decided: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns. ``decided``: row_key, stays, and n, the rows of a key.

    A key that stays with more than one row leaves one; only such rows, and keys that go, are looked for.
    """
    decided = written(decided, "decided")
    left = by_key(documents, decided.where("not stays or n > 1").select("row_key"), "left_anti")
    repeated = decided.where("stays and n > 1").select("row_key")
    return left if repeated.isEmpty() else left.unionByName(by_key(documents, repeated, "left_semi", once=True))


def parts_for(rows: int, each: int) -> int:
    """Number of parts that hold about ``each`` rows."""
    return max(1, -(-rows // each))
