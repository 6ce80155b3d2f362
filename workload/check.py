"""Run registered queries against their DuckDB oracles: python -m workload.check FOLDER [names...]"""

from __future__ import annotations

import collections
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

import workload.queries  # noqa: F401
from workload.registry import ORACLES, QUERIES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v + 0.0 if isinstance(v, float) else v


def _bag(columns, rows) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, folder: str, name: str) -> str | None:
    """None if equal, else what differs."""
    df = QUERIES[name](spark, folder)
    spark_rows = df.collect()
    if name not in ORACLES:
        return None if spark_rows else "no rows"
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    ours, theirs = _bag(df.columns, spark_rows), _bag(columns, cursor.fetchall())
    if ours == theirs:
        return None if ours else "no rows"
    a, b = list((ours - theirs).elements()), list((theirs - ours).elements())
    return f"rows {len(spark_rows)} vs {sum(theirs.values())}; only Spark {len(a)} {sorted(a, key=str)[:2]}; only oracle {len(b)} {sorted(b, key=str)[:2]}; order {sorted(columns)}"


def main(folder: str, names: list[str]) -> int:
    from tidemark.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": os.environ.get("CHECKPOINT_DIR", "/tmp/tidemark-shared")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(folder), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names or QUERIES)}; {len(ORACLES)} oracles, {len(QUERIES)} queries")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
