"""Exact duplicates: a new batch against immutable snapshots, screened by static binary fuse filters.

1. Each row's digest is taken where the row lies; from then on only narrow rows move.
2. The rows of a snapshot are reduced to distinct digests, dealt into buckets by the digest, and each bucket gets one
   filter, which never changes.
3. The new batch is reduced to distinct digests first: its own copies are grouped here, apart from the snapshots.
   The digests meet the filters of their bucket; only positives go on to the exact buckets.
4. Digests with more than one row, in either or both, are byte-checked and grouped: their rows, and no others, are
   grouped by SHA-256, and the texts of these rows by their bytes. A static bitmap of these digests is tested where the
   texts lie, so others never move. Grouping combines before it moves, so a text that makes up a third of all rows moves
   once per task.

Equal: identical texts; null counts as the empty text. Of equal texts the row with the largest ``doc_id`` stays (a null
id only if there is no other); of rows that repeat id and text, one. An empty table gives an empty result. Other columns
of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketframe.llm import fuse_filter
from docketframe.llm.common import numbered, one_per_key, parts_for, row_key, written

#: Distinct digests a bucket of a snapshot holds on average.
BUCKET_DIGESTS = 2048
#: Rows of 512 bytes of the bitmap that tells which texts move.
BITMAP_BUCKETS = 1 << 17


def short_digest(text: Column) -> Column:
    return F.xxhash64(text)


def snapshot_filters(digests: DataFrame) -> DataFrame:
    """One filter per (snapshot, bucket) of distinct (snapshot, bucket, digest) rows."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, length, segments, prints = fuse_filter.build(np.unique(pdf["digest"].to_numpy(np.int64).view(np.uint64)))
        place = {"snapshot": [pdf["snapshot"].iloc[0]], "bucket": [pdf["bucket"].iloc[0]]}
        return pd.DataFrame(place | {"seed": [seed], "length": [length], "segments": [segments], "prints": [prints]})

    schema = "snapshot int, bucket long, seed int, length int, segments int, prints binary"
    return digests.groupBy("snapshot", "bucket").applyInPandas(build, schema)


def screen(digests: DataFrame, filters: DataFrame) -> DataFrame:
    """The distinct (bucket, digest) rows that some snapshot's filter may hold."""

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys = left["digest"].to_numpy(np.int64).view(np.uint64)
        found = np.zeros(len(keys), dtype=bool)
        for row in right.itertuples():
            found |= fuse_filter.contains(keys, row.seed, row.length, row.segments, row.prints)
        return left.loc[found, ["digest"]]

    return digests.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest long")


def shared_digests(heads: DataFrame) -> DataFrame:
    """Digests of more than one row: within the new batch, within the snapshots, or across."""
    old = heads.where("snapshot is not null").groupBy("snapshot", "digest").agg(F.count("*").alias("n"))
    new = heads.where("snapshot is null").groupBy("digest").agg(F.count("*").alias("n"))
    old, new = written(old, "snapshots"), written(new, "batch")
    buckets = parts_for(old.count(), BUCKET_DIGESTS)
    bucket = F.pmod("digest", F.lit(buckets)).alias("bucket")
    filters = snapshot_filters(old.select("snapshot", "digest", bucket))
    positives = screen(new.select("digest", bucket), filters)
    known = old.join(positives, "digest", "left_semi").select("digest")
    copies = old.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest")
    return known.unionByName(copies).unionByName(new.where("n > 1").select("digest")).distinct()


def bitmap(digests: DataFrame, rows: int) -> DataFrame:
    """A static bitmap of ``rows`` digests: bucket and words (64 longs), eight bits a digest, ``BITMAP_BUCKETS`` rows at most."""
    buckets = min(BITMAP_BUCKETS, 1 << max(4, (8 * rows // 4096).bit_length()))
    bucket, word, bit = _bit_of(F.col("digest"), buckets)
    words = digests.select(bucket.alias("bucket"), word.alias("word"), bit.alias("bit")).groupBy("bucket", "word")
    words = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
    pairs = words.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("of"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("of", i), F.lit(0).cast("long")))
    return pairs.select("bucket", filled.alias("words"), F.lit(buckets).alias("buckets"))


def _bit_of(digest: Column, buckets: int | Column) -> tuple[Column, Column, Column]:
    """Bucket, word and bit of a digest, by a hash of its own: the screening filters share no bits with it."""
    mixed = F.xxhash64(F.lit(9), digest)
    low = F.shiftright(mixed, 12)
    return F.pmod(low, F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int"), F.shiftright(mixed, 6).bitwiseAND(F.lit(63).cast("long")).cast("int"), mixed.bitwiseAND(F.lit(63).cast("long")).cast("int")


def passing(texts: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows of ``texts`` (with ``digest``) that may have one of the digests, told where they lie by a bitmap.

    The bitmap is broadcast: ``BITMAP_BUCKETS`` rows of 512 bytes at most. Past what that holds well it lets more rows
    through, never fewer.
    """
    digests = written(digests.distinct(), "digests")
    bits = written(bitmap(digests, digests.count()), "bitmap")
    buckets = bits.select("buckets").first()
    if buckets is None:
        return texts.limit(0)
    bucket, word, bit = _bit_of(F.col("digest"), buckets[0])
    marked = texts.withColumn("bitmap_bucket", bucket).join(F.broadcast(bits.select(F.col("bucket").alias("bitmap_bucket"), "words")), "bitmap_bucket")
    return marked.where(F.call_function("getbit", F.get("words", word), bit) == 1).drop("bitmap_bucket", "words")


def exact_groups(documents: DataFrame, snapshot: Column, digest=short_digest, *carried) -> DataFrame:
    """Every row of ``documents`` (doc_id, text) with its group.

    ``snapshot``: int column, the immutable snapshot that a row is part of; null for the new batch.
    ``digest``: text to a long. Different texts may share a digest; the byte check keeps them apart.
    Returns doc_id, keep_id, group_size, kept, text_sha256, and the columns ``carried``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    heads = numbered(
        documents,
        "heads",
        "doc_id",
        digest(text).alias("digest"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        snapshot.cast("int").alias("snapshot"),
        *carried,
    )
    held = heads.columns[4:-1]
    shared = written(shared_digests(heads), "shared")
    # Texts are fetched by id and digest, which spreads them evenly; grouping by the bytes combines before it moves.
    screened = heads.join(shared, "digest", "left_semi")
    wanted = screened.select(F.col("doc_id").alias("id"), F.col("digest").alias("of")).distinct()
    texts = documents.select("doc_id", text.alias("text"), digest(text).alias("digest"))
    # Most texts are of digests that occur once; they stay where they lie.
    copies = (
        passing(texts, shared).join(wanted, F.expr("doc_id <=> id and digest = of"))  # a semi join would be moved below the bitmap
        .groupBy("digest", "text")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(F.unhex(F.sha2("text", 256)).alias("sha"))
    )
    # Grouped before the join, so that the rows of one text meet as one row per task.
    keepers = (
        screened.groupBy("sha")
        .agg(
            F.max("doc_id").alias("keep_id"),
            F.max_by("row_id", "doc_id").alias("keep_row"),
            F.max("row_id").alias("any_row"),
            F.count("*").alias("group_size"),
        )
        .where("group_size > 1")
        .join(copies, "sha", "left_semi")
        .select("sha", "keep_id", F.coalesce("keep_row", "any_row").alias("keep_row"), "group_size")
    )
    single = F.col("keep_row").isNull()
    return heads.join(written(keepers, "keepers"), "sha", "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(single, 1).otherwise(F.col("group_size")).cast("long").alias("group_size"),
        F.when(single, True).otherwise(F.col("keep_row") == F.col("row_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *held,
    )


def by_landing(snapshots: int) -> Column:
    """Deals documents by id: ``snapshots`` snapshots as if landed before, and one new batch."""
    deal = F.pmod(F.xxhash64("doc_id"), F.lit(snapshots + 1))
    return F.when(deal < snapshots, deal).cast("int")


def one_of_each(documents: DataFrame, snapshots: int = 2) -> DataFrame:
    """The rows that stay, with all their columns."""
    groups = exact_groups(documents, by_landing(snapshots), short_digest, row_key())
    return one_per_key(documents, groups.groupBy("row_key").agg(F.max("kept").alias("stays"), F.count("*").alias("n")))
