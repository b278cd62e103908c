"""Run registered queries in Spark and their SQL in DuckDB, and compare exactly.

    python tests/compare.py [--folder /root/testdata/sf0.01] [--broadcast-bytes N] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("millrace")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def kind(value) -> str:
    return type(value).__name__


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def oracle_rows(folder: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    table = con.sql(sql).to_arrow_table()
    return table.column_names, [tuple(d.values()) for d in table.to_pylist()], table.schema


def compare(frame, folder: str, sql: str) -> str:
    """Empty when equal, else what differs."""
    got_columns, got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    names, rows, schema = oracle_rows(folder, sql)
    want_columns, want = canonical(names, rows)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    short = {"bigint": "int64", "int": "int32", "double": "double", "string": "string",
             "boolean": "bool", "timestamp_ntz": "timestamp[us]"}
    arrow = {n: str(schema.field(n).type) for n in names}
    odd = [f"{n}: {k} != {arrow[n]}" for n, k in frame.dtypes if short.get(k, k) != arrow[n]]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0][0]} != {bad[0][1]}"
    return f"types {odd}" if odd else ""


def main() -> int:
    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    parser.add_argument("--broadcast-bytes", type=int, help="limit above which lookups are shuffled")
    parser.add_argument("names", nargs="*", help="prefixes of query names")
    options = parser.parse_args()
    folder, args = options.folder, options.names
    if options.broadcast_bytes is not None:
        from millrace.operators import joins

        joins.BROADCAST_BYTES = options.broadcast_bytes
    spark, sqls, failures = session(), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            frame = build(spark, folder)
            if name in sqls:
                problem = compare(frame, folder, sqls[name])
                note = "equal" if not problem else problem
            else:
                problem, note = "", f"{len(frame.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            problem = note = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {note}", flush=True)
    print(f"{failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
