"""Keyed table operators: latest row, upsert, delete, replace, change detection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import record_hash


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    row_number() = 1 lets Spark keep one row per key on the map side before the
    shuffle, so a key holding much of the table sends at most one row per task.
    Pass a total order; ties beyond it are broken arbitrarily.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with every source row inserted or replacing its key. Source keys must be unique."""
    untouched = target.join(source.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(source.select(*target.columns))


def upsert_newest(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Upsert that keeps, per key, the first row in the given order, wherever it comes from.

    For sources that may deliver an older state late; on a tie the source wins.
    """
    both = target.withColumn("_arrived", F.lit(0)).unionByName(
        source.select(*target.columns, F.lit(1).alias("_arrived"))
    )
    return latest_per_key(both, keys, [*order, F.desc("_arrived")]).drop("_arrived")


def _differs(columns: Sequence[str], left: str, right: str) -> Column:
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows_inserted, rows_updated (really changed), rows_unchanged."""
    values = [c for c in source.columns if c not in keys]
    marked = target.withColumn("_in_target", F.lit(True)).alias("t")
    on = reduce(lambda a, b: a & b, [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys])
    joined = source.alias("s").join(marked, on, "left")
    known = F.col("t._in_target").isNotNull()
    changed = _differs(values, "s", "t")
    return joined.agg(
        F.count_if(~known).alias("rows_inserted"),
        F.count_if(known & changed).alias("rows_updated"),
        F.count_if(known & ~changed).alias("rows_unchanged"),
    )


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Target plus the first source row of every key the target lacks.

    The source is reduced to one row per key first, so a repeated key is cheap and the
    anti join reuses the partitioning of that step.
    """
    first = latest_per_key(source, keys, order)
    new = first.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the source's keys, plus all source rows (several per key allowed)."""
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true; unknown keeps the row."""
    return target.where(~F.coalesce(predicate, F.lit(False)))


def with_record_hash(df: DataFrame, columns: Sequence[str], null_safe: bool = False) -> DataFrame:
    return df.withColumn("_record_hash", record_hash(columns, null_safe))


def changed_rows(
    source: DataFrame, current: DataFrame, keys: Sequence[str], hash_col: str = "_record_hash"
) -> DataFrame:
    """Source rows whose key is new or whose hash differs from the current row."""
    on = [*keys, hash_col]
    return source.join(current.select(*on), on, "left_anti")
