"""Run queries next to their checks and compare: row count, column names, values in any order.

    python -m workloads.compare [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import time
from collections import Counter
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def check_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def compare(spark, sf_dir: str, name: str, connection) -> str:
    """'' if query and check agree, else what differs."""
    from workloads.checks import CHECKS
    from workloads.queries import QUERIES

    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    got = Counter(tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect())
    cursor = connection.execute(CHECKS[name])
    order = {item[0]: i for i, item in enumerate(cursor.description)}
    if sorted(order) != columns:
        return f"columns {columns} against {sorted(order)}"
    wanted = Counter(tuple(row[order[c]] for c in columns) for row in cursor.fetchall())
    if got == wanted:
        return "" if got else "no rows"
    extra, lacking = list((got - wanted).items())[:2], list((wanted - got).items())[:2]
    return f"{sum(got.values())} rows against {sum(wanted.values())}; only query {extra}; only check {lacking}"


def main() -> None:
    from docketframe.session import local_session
    from workloads.queries import QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    sf_dir = f"/root/testdata/sf{options.sf}"
    spark, connection = local_session(8, 8), check_connection(sf_dir)
    for name in options.names or QUERIES:
        start = time.time()
        try:
            difference = compare(spark, sf_dir, name, connection)
        except Exception as problem:
            difference = f"{type(problem).__name__}: {str(problem)[:1500]}"
        print(f"{'ok  ' if not difference else 'FAIL'} {time.time() - start:6.1f}s {name} {difference}", flush=True)


if __name__ == "__main__":
    main()
