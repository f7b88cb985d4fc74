"""Pages as they land: a file stream whose batches keep a state table in buckets, each batch reading only those it touches.

References and waiting records are dealt to buckets by a hash of the county and the key of the case page. A batch writes
what its pages hold, reads the latest state of the buckets that this touches, adds the rows of references whose pages are
there, and writes the new state of those buckets. The ledger of a batch comes last: it says for every bucket which batch
wrote its latest state, and it commits the batch. All a batch writes lies in folders of its own number, which a batch that
is run again replaces, so no rerun leaves copies; what no ledger names is not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe import schema
from docketframe.operators import refs, rows
from docketframe.operators.extract import extract_cases
from docketframe.sources.config import load_counties, local_frame, search_pages_frame
from docketframe.sources.pages import with_landing_order

#: Buckets of the state of a new stream.
BUCKETS = 64
_LEDGER = "name string, bucket int, batch bigint, buckets int"
_REFS = "county_key string, case_ref string, page_key string, page_ord int, ref_pos int, state string, bucket int"
_KEY = ["county_key", "page_key"]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*_KEY), F.lit(buckets)).cast("int").alias("bucket")


class State:
    """The folders beside a stream's checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.root = spark, f"{checkpoint.rstrip('/')}/tables"

    def folder(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/batch={batch}"

    def committed(self) -> list[int]:
        """Numbers of the batches with a ledger, in order."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/ledger")
        system = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(hadoop):
            return []
        names = [entry.getPath().getName() for entry in system.listStatus(hadoop)]
        done = [name for name in names if name.startswith("batch=") and system.exists(hadoop.suffix(f"/{name}/_SUCCESS"))]
        return sorted(int(name.removeprefix("batch=")) for name in done)

    def ledger(self, before: int | None = None) -> dict[tuple[str, int], int]:
        """The batch that wrote the latest state, by table and bucket: of the last committed batch, or the last before one."""
        known = [batch for batch in self.committed() if before is None or batch < before]
        if not known:
            return {}
        lines = self.spark.read.schema(_LEDGER).parquet(self.folder("ledger", known[-1])).collect()  # two lines a bucket at most
        return {(line["name"], line["bucket"]): line["batch"] for line in lines}

    def commit(self, batch: int, lines: dict[tuple[str, int], int], buckets: int) -> None:
        frame = local_frame(self.spark, [(name, bucket, number, buckets) for (name, bucket), number in lines.items()], _LEDGER)
        frame.coalesce(1).write.mode("overwrite").parquet(self.folder("ledger", batch))

    def latest(self, name: str, ledger: dict, ddl: str, only: set[int] | None = None) -> DataFrame:
        """The latest state of a table, or of some buckets of it: no other folder is listed or read."""
        paths = [f"{self.folder(name, batch)}/bucket={bucket}" for (own, bucket), batch in ledger.items() if own == name and (only is None or bucket in only)]
        if not paths:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).option("basePath", f"{self.root}/{name}").parquet(*paths).drop("batch")

    def write(self, df: DataFrame, name: str, batch: int, whole: bool = False) -> DataFrame:
        """One batch's part of a table, replaced if it was there, and read back.

        What only this batch reads, and reads ``whole``, is not dealt to folders: no sort, and a file a task instead of one a bucket.
        """
        written = df.write.mode("overwrite")
        (written if whole else written.partitionBy("bucket")).parquet(self.folder(name, batch))
        return self.spark.read.schema(df.schema).parquet(self.folder(name, batch))

    def buckets(self) -> int | None:
        """The number of buckets the stream was started with."""
        known = self.committed()
        first = self.spark.read.schema(_LEDGER).parquet(self.folder("ledger", known[-1])).first() if known else None
        return first["buckets"] if first else None


def _touched(*frames: DataFrame) -> set[int]:
    return {row["bucket"] for frame in frames for row in frame.select("bucket").distinct().collect()}  # numbers of buckets


def _merged_refs(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each reference once, at its first place by now."""
    place = refs.listing_order(F.col("page_ord"), F.col("ref_pos"))
    both = old.unionByName(new.withColumn("state", F.lit(None).cast("string")))
    first = both.groupBy("county_key", "case_ref", "page_key", "bucket").agg(F.min(place).alias("place"), F.max("state").alias("state"))
    return first.select("county_key", "case_ref", "page_key", "bucket", *refs.from_listing_order(F.col("place")), "state")


def _newest(records: DataFrame) -> DataFrame:
    """Of several versions of a page when the last one landed, and whether it could be read; no other column is touched."""
    outcome = F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("now")
    return records.select(*_KEY, "landed", outcome).groupBy(*_KEY).agg(F.max_by("now", "landed").alias("now"), F.max("landed").alias("last"))


def _versions(records: DataFrame, newest: DataFrame) -> DataFrame:
    """The records of some pages, each from the version that landed last."""
    return records.join(newest.select(*_KEY, "last"), _KEY).where("landed = last").drop("last")


def process_batch(state: State, batch: DataFrame, number: int, counties: list[dict], listing: DataFrame, out: str, buckets: int) -> None:
    """One batch of landed pages (with ``landed``). Running it again replaces what it wrote."""
    ledger = state.ledger(before=number)
    listed = refs.with_case_page(refs.first_seen(refs.listed_refs(batch, counties, listing)), counties)
    new_refs = state.write(listed.select("county_key", "case_ref", "page_key", "page_ord", "ref_pos", _bucket(buckets)), "new_refs", number, whole=True)
    new_records = state.write(extract_cases(batch, counties).select("*", _bucket(buckets)), "new_records", number, whole=True)
    touched = _touched(new_refs, new_records)
    known = _merged_refs(state.latest("refs", ledger, _REFS, touched), new_refs)
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in new_records.schema.fields)
    landed = state.latest("records", ledger, ddl, touched).unionByName(new_records)
    newest = _newest(landed)
    new_state = F.when(F.col("state") == "ok", "ok").otherwise(F.coalesce("now", "state"))
    told = known.join(newest, _KEY, "left")
    told = told.withColumn("fresh", (F.col("now") == "ok") & ~F.col("state").eqNullSafe("ok")).withColumn("state", new_state).drop("now")
    told = told.withColumn("last", F.when(F.col("fresh"), F.col("last")))
    told = state.write(told.hint("rebalance", "bucket"), "refs", number)
    done = told.where("state = 'ok'").select(*_KEY).distinct()
    left = newest.join(done, _KEY, "left_anti")  # failed ones too: their listing may come later
    left = state.write(left, "left", number, whole=True)  # written first, so that few or none move no record
    waiting = state.write(_versions(landed, left), "records", number)
    fresh = told.where("fresh").select("county_key", "case_ref", "page_ord", "ref_pos", "last")  # whole records move once
    rows.listed_case_rows(refs.visit(fresh, landed, counties)).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    lines = {key: wrote for key, wrote in ledger.items() if key[1] not in touched}
    for name, frame in (("refs", told), ("records", waiting)):
        lines |= {(name, bucket): number for bucket in _touched(frame)}
    state.commit(number, lines, buckets)


def run_available(
    spark: SparkSession,
    landing: str,
    counties: Iterable[Mapping],
    out: str,
    checkpoint: str,
    search_pages: DataFrame | None = None,
    files_per_batch: int | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Process all that has landed and not been processed, add the rows to ``out``, and stop.

    A page that lands after its listing, or again after a failure, is picked up then. Of several versions of a page that
    land before it is done the one landed last counts (``with_landing_order``), also within a batch; a case that is done is
    not read again. A batch reads the buckets its pages touch, so its work grows with a bucket, not with all that has
    landed; ``buckets`` is fixed when the stream starts. References that lead to one page are done by one batch or wait
    for the page to land again.
    """
    counties = load_counties(counties)
    listing = search_pages_frame(spark, counties) if search_pages is None else search_pages
    state = State(spark, checkpoint)
    dealt = state.buckets() or buckets

    def process(batch: DataFrame, number: int) -> None:
        process_batch(state, batch, number, counties, listing, out, dealt)

    reader = spark.readStream.schema(schema.LANDED_DDL)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = with_landing_order(reader.parquet(landing)).writeStream.foreachBatch(process)
    stream.option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream").trigger(availableNow=True).start().awaitTermination()


def added_rows(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """The rows of all committed batches as they were added."""
    batches = State(spark, checkpoint).committed()
    if not batches:
        raise FileNotFoundError(f"no batch of {checkpoint} is committed")
    return spark.read.option("basePath", out).parquet(*[f"{out.rstrip('/')}/batch={number}" for number in batches]).drop("batch")


def listed_references(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Every listed reference with its first place by now and its state."""
    state = State(spark, checkpoint)
    return state.latest("refs", state.ledger(), _REFS)


def stored_rows(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """All rows so far, each at the first place that its reference has by now, whenever that results page landed."""
    first = listed_references(spark, checkpoint).select("county_key", "case_ref", "page_ord", "ref_pos")
    stored = added_rows(spark, out, checkpoint)
    county = F.floor(F.col("row_ord") / F.lit(Decimal(10**29))).cast("int")
    pair = (F.col("row_ord") % F.lit(Decimal(10**10))).cast("bigint")
    place = rows.first_seen_order(county, F.col("page_ord"), F.col("ref_pos"), pair)
    return stored.join(first, ["county_key", "case_ref"]).withColumn("row_ord", place).select(*stored.columns)


def reference_states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Every listed reference with its state by now: ok, failed, or missing while its page has not landed."""
    return listed_references(spark, checkpoint).select("county_key", "case_ref", F.coalesce("state", F.lit("missing")).alias("state"))
