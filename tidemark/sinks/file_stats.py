"""File skipping: each file's smallest and largest values, kept as a table, choose the files of a scan.

The statistics know the files they are of. Files without any are read, files that are gone
are forgotten, so the table beside the data can be old and never wrong. Only names of the chosen files reach
the driver, where a scan's file list is kept anyway.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.layout import list_files, stats_per_file
from tidemark.sinks.tables import exists
from tidemark.sources.lake import read_table


def stats_path(path: str) -> str:
    return f"{path.rstrip('/')}.stats"


def _plain_path(spark: SparkSession, uri: str) -> str:
    """A file's path, from the URI that file metadata has."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(uri)).toString()


def _read_files(spark: SparkSession, path: str, uris: Sequence[str], schema: T.StructType) -> DataFrame:
    """The table's rows in some of its files."""
    if not uris:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[_plain_path(spark, u) for u in uris])


def refresh_stats(spark: SparkSession, path: str, columns: Sequence[str]) -> int:
    """Reads the files without statistics and adds theirs, unknown values for one without rows; returns how many there were."""
    files = list_files(spark, path).select("file_path")
    if exists(spark, stats_path(path)):
        known = spark.read.parquet(stats_path(path))
        if any(f"{c}_min" not in known.columns for c in columns):
            raise ValueError(f"{stats_path(path)} has statistics of other columns")
        files = files.join(known.select("file_path"), "file_path", "left_anti")
    new = [r["file_path"] for r in files.toLocalIterator()]
    if new:
        rows = _read_files(spark, path, new, read_table(spark, path).schema)
        found = stats_per_file(rows, columns).select("file_path", *[f"{c}_{m}" for c in columns for m in ("min", "max", "nulls")])
        files.join(found, "file_path", "left").hint("rebalance").write.mode("append").parquet(stats_path(path))
    return len(new)


def files_within(spark: SparkSession, path: str, ranges: dict[str, tuple[Any, Any]]) -> DataFrame:
    """file_path of files that can hold a row whose columns are all within their ranges (first, last; None is open)."""
    files = list_files(spark, path).select("file_path")
    if not exists(spark, stats_path(path)):
        return files
    stats = spark.read.parquet(stats_path(path))
    tests = [F.lit(True)]
    for c, (first, last) in ranges.items():
        low, high = F.col(f"{c}_min"), F.col(f"{c}_max")
        tests += [high >= F.lit(first) if first is not None else high.isNotNull(), low <= F.lit(last) if last is not None else low.isNotNull()]
    # All values unknown: no row of the file is within a range.
    can = F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
    return files.join(stats.where(~can).select("file_path"), "file_path", "left_anti")


def scan_within(spark: SparkSession, path: str, ranges: dict[str, tuple[Any, Any]], schema: T.StructType | None = None) -> DataFrame:
    """Rows whose columns are within their ranges, from the files that can hold some; the ranges are pushed into their scan too."""
    schema = schema or read_table(spark, path).schema
    rows = _read_files(spark, path, [r["file_path"] for r in files_within(spark, path, ranges).toLocalIterator()], schema)
    for c, (first, last) in ranges.items():
        rows = rows.where((F.col(c) >= F.lit(first) if first is not None else F.col(c).isNotNull())
                          & (F.col(c) <= F.lit(last) if last is not None else F.col(c).isNotNull()))
    return rows
