"""Run the registered queries beside their SQL and report differences.

Usage: python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from carebasin.session import build_session
from checks import QUERIES, SQL

VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPE_NAMES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
}


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for view in VIEWS:
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    return connection


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """A description of the first difference, or None if the results agree."""
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    got = sorted(map(repr, (tuple(row[n] for n in names) for row in df.collect())))
    if name not in SQL:
        return None if got else "no rows"
    relation = connection.sql(SQL[name])
    if sorted(relation.columns) != names:
        return f"columns differ: {sorted(set(relation.columns) ^ set(names))}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    wrong = {
        n: (t, types[n]) for n, t in df.dtypes if TYPE_NAMES.get(t, t) != types[n]
    }
    places = [relation.columns.index(n) for n in names]
    rows = connection.execute(SQL[name]).fetchall()
    want = sorted(map(repr, (tuple(row[i] for i in places) for row in rows)))
    if got != want:
        extra = [g for g, w in zip(got, want) if g != w][:1]
        missing = [w for g, w in zip(got, want) if g != w][:1]
        return f"{len(got)} rows against {len(want)}; {names}\n   got  {extra}\n   want {missing}"
    return f"types differ: {wrong}" if wrong else None


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = build_session(
        "checks", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = engine(sf_dir)
    failed = 0
    for name in arguments[1:] or QUERIES:
        start = time.time()
        try:
            found = difference(spark, connection, sf_dir, name)
        except Exception as error:  # a broken query must not hide the others
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        kind = "sql" if name in SQL else "rows"
        print(f"{'ok ' if found is None else 'BAD'} {kind:4} {time.time() - start:6.1f}s {name}"
              + (f"\n   {found}" if found else ""), flush=True)
    print(f"{failed} of {len(arguments[1:] or QUERIES)} differ")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
