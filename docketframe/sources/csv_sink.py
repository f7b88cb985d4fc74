"""The CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docketframe.session import shuffles_removed

# Quotes are doubled, empty cells stay empty, spaces at the ends are kept.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(table: DataFrame, path: str) -> DataFrame:
    """Replace ``path`` by the table as CSV part files, each with the header; file order is table order.

    Returns the table read back from what was written.
    """
    with shuffles_removed(table.sparkSession):
        table.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    written = table.sparkSession.read.schema(table.schema).options(**CSV_OPTIONS).csv(path)
    return written.na.fill("")
