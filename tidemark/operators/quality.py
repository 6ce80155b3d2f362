"""Data-quality checks. Each returns the violating rows, lazily."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their count. NULL keys are left to check_not_null."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where("n_rows > 1")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with a value outside the list; NULL is accepted."""
    return df.where(~F.col(column).isin(*values))


def check_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(parents, child_key, "left_anti")


def check_temporal(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, child_ts: str, parent_ts: str
) -> DataFrame:
    """Child rows dated before their parent existed. Parent keys must be unique."""
    parents = parent.select(F.col(parent_key).alias("_pk"), F.col(parent_ts).alias("_parent_ts"))
    early = (F.col(child_key) == F.col("_pk")) & (F.col(child_ts) < F.col("_parent_ts"))
    return child.join(parents, early).drop("_pk")


def column_report(
    df: DataFrame, not_null: Sequence[str] = (), accepted: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """All row-level tests of a table in one pass: rows (test, column_name, failures)."""
    tests: list[tuple[str, str, Column]] = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [("accepted_values", c, ~F.col(c).isin(*vs)) for c, vs in (accepted or {}).items()]
    counted = df.agg(*[F.count_if(failed).alias(f"_{i}") for i, (_, _, failed) in enumerate(tests)])
    rows = [
        F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"), F.col(f"_{i}").alias("failures"))
        for i, (t, c, _) in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*rows)))


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and order-insensitive content sums, one row.

    The 64-bit row hash is summed in three parts of at most 22 bits, so the sums stay
    in bigint for about 10^12 rows and count duplicates.
    """
    row_hash = F.xxhash64(*sorted(df.columns))
    parts = [F.shiftrightunsigned(row_hash, shift).bitwiseAND(F.lit((1 << 22) - 1)) for shift in (0, 22, 44)]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(*[F.sum(part) for part in parts]).alias("content"),
    )


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: counts on both sides and whether the content is the same."""
    sides = (
        fingerprint(before).withColumn("side", F.lit("before"))
        .unionByName(fingerprint(after).withColumn("side", F.lit("after")))
    )

    def pick(column: str, side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    rows_before, rows_after = pick("n_rows", "before"), pick("n_rows", "after")
    same_content = pick("content", "before").eqNullSafe(pick("content", "after"))
    return sides.agg(
        rows_before.alias("rows_before"),
        rows_after.alias("rows_after"),
        (same_content & (rows_before == rows_after)).alias("same_content"),
    )
