"""Runs registered queries beside their SQL counterpart and compares the results."""

from __future__ import annotations

import argparse
import math
import time

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def _table(columns: list[str], rows: list) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, row count and every value agree exactly."""
    answer = con.execute(sql)
    want_columns, want = _table([d[0] for d in answer.description], answer.fetchall())
    got_columns, got = _table(df.columns, [tuple(r) for r in df.collect()])
    if got_columns != want_columns:
        return [f"columns {got_columns} instead of {want_columns}"]
    if len(got) != len(want):
        return [f"{len(got)} rows instead of {len(want)}"]
    wrong = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    return [f"{len(wrong)} of {len(got)} rows, first {wrong[0]}"] if wrong else []


def main() -> None:
    from tidemark.plans.session import local_session
    from workload.registry import oracle_sql, queries

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf_dir)
    statements = oracle_sql()
    for name, query in queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = query(spark, args.sf_dir)
            if name in statements:
                found = differences(df, con, statements[name])
                verdict = f"DIFFERS {found[0][:1500]}" if found else "equal"
            else:
                verdict = f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
