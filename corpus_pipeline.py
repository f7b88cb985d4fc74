"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. All but the last hand on the columns of
``documents``. Between stages the rows are a Parquet table in the shared folder.

An empty table stays empty at every stage. Columns of any other name are carried along, also where a stage uses such a name
itself; null ids, langs and sources are values like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketframe.llm import exact_dedup, language_id, mixing, near_dedup, packing
from docketframe.llm.common import read_table, written

#: The mix draws pseudorandom numbers and the last stage encodes tokens; SQL can express neither.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without letters or of an ambiguous language go; a null text has no letters. Rows that repeat go or stay together."""
    return language_id.known_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays, a null id only if there is no other; of rows that repeat, one. Null is the empty text."""
    return exact_dedup.one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that share 80 % of their five-word shingles, directly or over others, the smallest id stays; of rows that repeat, one.

    Texts without words are linked with nothing and stay.
    """
    return near_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks are drawn from the sources to their target weights; a null source is one of its own. Texts without words are not drawn."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens are packed into windows; one row per piece. A null text is its end id alone; rows that repeat are packed each by itself."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
