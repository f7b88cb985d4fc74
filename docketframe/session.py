"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Whether files of a shuffle go when the query that wrote them ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docketframe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config(CHECKPOINT_DIR, conf.pop(CHECKPOINT_DIR, None) or tempfile.mkdtemp(prefix="docketframe-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; where it names none, one in the warehouse, which executors share as well."""
    return spark.conf.get(CHECKPOINT_DIR, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written files.

    Cuts lineage reliably: a lost executor costs a re-read, not a recomputation.
    """
    root, context = checkpoint_root(df.sparkSession), df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that start here remove what they shuffled when they end.

    The setting is the session's, so queries that other threads start meanwhile do so as well.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as compressed columns and go on from these; what was shuffled for it is removed.

    For rows that are shuffled again and written whole: on disk are the columns and one shuffle then, not all of them.
    """
    path = scratch_path(df.sparkSession, "stored")
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
