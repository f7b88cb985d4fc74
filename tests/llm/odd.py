"""Rows that go wrong easily: nulls, empty and long texts, repeated rows, ties, extra columns with clashing names."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_WORDS = "river stone light house green cloud paper train winter music garden table open quiet bread salt north field glass road".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choices(_WORDS, k=words)) + "."


def odd_rows() -> list[tuple]:
    base = prose(1, 120)
    long_text = "\n".join(prose(100 + i, 40) for i in range(700))
    rows = [
        (1, base, "en", "b", 1),
        (2, base, "en", "a", 2),
        (2, base, "en", "a", 2),  # a repeated row
        (3, base.replace("river", "lake", 1), "en", None, 3),
        (4, base.upper(), None, "a", None),
        (5, None, "en", "a", None),
        (6, None, None, None, None),
        (7, "", "de", "b", 0),
        (8, " \t\n", "de", "b", 3),
        (9, "word", "en", "c", 4),
        (10, "word", "en", "c", 4),
        (None, prose(2, 60), "en", "a", 5),
        (None, prose(2, 60), "en", "b", 5),
        (None, "", "en", "b", 0),
        (11, long_text, "en", "c", 6),
        (12, long_text + " more", "en", "c", 6),
        (13, "1234 !! 5678", "en", "a", 7),
        (14, "grüße   日本語 😀 naïve", "de", "b", 8),
    ]
    rows += [(100 + i, prose(1000 + i, 80 + i), "en" if i % 3 else "de", "abc"[i % 3], i) for i in range(40)]
    return rows


def odd_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(odd_rows(), SCHEMA)


def with_clashes(df: DataFrame) -> DataFrame:
    """The same rows with columns that the operators might use themselves."""
    for name in ("row_id", "Score", "lang_pred", "digest", "key", "size", "label", "node", "shard", "start", "place", "rep", "pass", "block"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
