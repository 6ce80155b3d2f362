"""Loads that take place once: a journal of (table, day, run).

A load is written beside its table, its files are then moved in, and last its journal entry is
made. A run that is repeated goes on where it died: nothing is there before all rows are written, a
file moves once, and a run in the journal is not loaded again. Readers of the table need not know.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.layout import _path, list_files
from tidemark.sinks.tables import LANDED, _balanced, _delete, _filesystem, counted

ENTRY = "table string, day string, run string, rows bigint"


def _name(*parts: str) -> str:
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()[:32]


def _committed(spark: SparkSession, folder: str) -> bool:
    fs, marker = _filesystem(spark, f"{folder}/_SUCCESS")
    return fs.exists(marker)


def entries(spark: SparkSession, journal: str) -> DataFrame:
    """table, day, run, rows of every finished load."""
    schema = T.StructType.fromDDL(ENTRY)
    fs, folder = _filesystem(spark, journal)
    done = [s.getPath().toString() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [d for d in done if _committed(spark, d)]
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)


def load_run(df: DataFrame, path: str, partition: Sequence[str], journal: str, table: str, day: str, run: str, landed: bool = False) -> int:
    """Appends df to the table at path unless the journal has the run; returns the run's rows.

    landed: as for tables.append. Repeated with the same table, day and run, it finishes what the first attempt began."""
    spark, name = df.sparkSession, _name(table, day, run)
    entry, beside = f"{journal}/{name}", f"{path.rstrip('/')}.load-{name}"
    ready = f"{beside}/_entry"  # committed once all rows are written; Spark does not read it as data
    fs, aside = _filesystem(spark, beside)
    if _committed(spark, entry):
        if fs.exists(aside):
            _delete(spark, beside)
        return spark.read.parquet(entry).first()["rows"]
    if not _committed(spark, ready):
        rows = counted(df, lambda d: (d if landed else _balanced(d, partition)).write.options(**LANDED if landed else {}).mode(
            "overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition).parquet(f"{beside}/rows"))
        made = spark.range(1).select(F.lit(table).alias("table"), F.lit(day).alias("day"), F.lit(run).alias("run"), F.lit(rows).cast("bigint").alias("rows"))
        made.write.mode("overwrite").parquet(ready)
    move_files(spark, f"{beside}/rows", path)
    spark.read.schema(ENTRY).parquet(ready).coalesce(1).write.mode("overwrite").parquet(entry)
    rows = spark.read.parquet(entry).first()["rows"]
    _delete(spark, beside)
    return rows


def move_files(spark: SparkSession, source: str, path: str) -> None:
    """Moves the data files under source to the same places under path; can be repeated."""
    fs, folder = _filesystem(spark, source)
    root, names = fs.makeQualified(folder).toString(), spark._jvm.org.apache.hadoop.fs.Path
    for row in list_files(spark, source).select("file_path").toLocalIterator():
        file = _path(spark, row["file_path"])
        to = names(f"{path}{fs.makeQualified(file).toString().removeprefix(root)}")
        fs.mkdirs(to.getParent())
        if not fs.rename(file, to):
            raise OSError(f"cannot move {file} to {to}")
