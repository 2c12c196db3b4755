"""Run registered queries next to their SQL and report differences: ``python -m verification.compare``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from verification.queries import CASES
from verification.scratch import ensure_folder

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


# Spark type -> type name on the SQL side
_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
          "boolean": "BOOLEAN"}


def _value(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows),
                  key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when names, types of values and all rows agree; otherwise what differs."""
    query, expected = CASES[name]
    got = query(spark, sf_dir)
    rows = [tuple(r) for r in got.collect()]
    if expected is None:
        return None if rows else "no rows"
    result = con.execute(expected)
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(columns) == sorted(got.columns):
        differing = {c: (k, kinds[c]) for c, k in got.dtypes if _TYPES.get(k) != kinds[c]}
        if differing:
            return f"column types {differing}"
    else:
        return f"columns {sorted(got.columns)} instead of {sorted(columns)}"
    a, b = _rows(got.columns, rows), _rows(columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows instead of {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} instead of {y}"
        if [type(v) for v in x] != [type(v) for v in y]:
            return f"types {[type(v).__name__ for v in x]} vs {[type(v).__name__ for v in y]}"
    return None if b else "both empty"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(CASES)
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_folder(spark)
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # keep going: one report over all queries
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
