"""Reading lake tables: slices, projections, namespaces."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import as_date, as_timestamp


def _utc(schema: T.StructType) -> T.StructType:
    def utc(t: T.DataType) -> T.DataType:
        return T.TimestampType() if isinstance(t, T.TimestampNTZType) else t

    return T.StructType([T.StructField(f.name, utc(f.dataType), f.nullable) for f in schema])


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet table. Zone-less timestamps are read as UTC instants by the scan itself.

    A declared schema saves the schema lookup and fixes the types of partition columns.
    """
    found = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    if schema is None and any(isinstance(f.dataType, T.TimestampNTZType) for f in found.schema):
        found = spark.read.schema(_utc(found.schema)).parquet(path)
    return found.select(*columns) if columns else found


def day_slice(df: DataFrame, column: str, day: dt.date | str) -> DataFrame:
    """Rows whose date column equals a day."""
    return df.where(F.col(column) == as_date(day))


def time_slice(df: DataFrame, column: str, day: dt.date | str, days: int = 1) -> DataFrame:
    """Rows with day 00:00 <= ts < day + days, as a half-open range the scan can prune on."""
    first = dt.date.fromisoformat(str(day))
    lo, hi = as_timestamp(first), as_timestamp(first + dt.timedelta(days=days))
    return df.where((F.col(column) >= lo) & (F.col(column) < hi))


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("parquet").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def has_rows(df: DataFrame, condition: Column | None = None) -> bool:
    """True if any row (matching the condition) exists; stops at the first one."""
    return not (df if condition is None else df.where(condition)).isEmpty()


def namespace(domain: str, layer: str) -> str:
    return f"{domain}_{layer}"


def table_path(root: str, domain: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{namespace(domain, layer)}/{table}"


def register_table(spark: SparkSession, root: str, domain: str, layer: str, table: str) -> str:
    """Create the namespace and an external catalog entry for a lake table; returns its name."""
    name = f"{namespace(domain, layer)}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace(domain, layer)}")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, table_path(root, domain, layer, table), source="parquet")
    return name


def list_tables(spark: SparkSession) -> DataFrame:
    """Every (namespace, table) of the session catalog."""
    names = [d.name for d in spark.catalog.listDatabases()]
    listed = [(n, t.name) for n in names for t in spark.catalog.listTables(n) if not t.isTemporary]
    return spark.createDataFrame(listed, "namespace string, table string").orderBy("namespace", "table")
