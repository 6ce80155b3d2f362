"""Table versions kept as a change log.

A log row is a full row plus `version` (long, one per commit) and `op` ('U' for
insert or update, 'D' for delete); a key has at most one row per version.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keyed import latest_per_key


def as_of(log: DataFrame, keys: Sequence[str], version: int | Column) -> DataFrame:
    """Table content after a version. The version may be a literal or a column of the log."""
    seen = log.where(F.col("version") <= version)
    return latest_per_key(seen, keys, [F.desc("version")]).where("op <> 'D'").drop("op")


def read_tag(log: DataFrame, tags: DataFrame, tag: str, keys: Sequence[str]) -> DataFrame:
    """Table content at a tagged version; tags: tag (unique), tagged_version. An unknown tag is an error."""
    pinned = tags.where(F.col("tag") == tag).agg(F.max("tagged_version").alias("v"))
    known = F.when(F.col("v").isNull(), F.raise_error(F.lit(f"no tag {tag}")).cast("long")).otherwise(F.col("v"))
    seen = log.where(F.col("version") <= pinned.select(known).scalar())
    return latest_per_key(seen, keys, [F.desc("version")]).where("op <> 'D'").drop("op")


def rollback(log: DataFrame, keys: Sequence[str], to_version: int, new_version: int) -> DataFrame:
    """Log rows that, appended as new_version, restore the content of to_version.

    Only keys touched after to_version are written: back to their old row, or
    deleted if they did not exist then.
    """
    values = [c for c in log.columns if c not in (*keys, "version", "op")]
    touched = log.where(F.col("version") > to_version).select(*keys).distinct()
    old = as_of(log, keys, to_version).select(*keys, F.struct(*values).alias("_old"), F.lit(True).alias("_had"))
    restored = touched.join(old, list(keys), "left")
    return restored.select(
        *keys,
        *[F.col(f"_old.{c}").alias(c) for c in values],
        F.lit(new_version).cast("long").alias("version"),
        F.when(F.col("_had"), "U").otherwise("D").alias("op"),
    ).select(*log.columns)


def diff_versions(
    older: DataFrame, newer: DataFrame, keys: Sequence[str], compare: Sequence[str] = ()
) -> DataFrame:
    """Keys with a change label: added, removed, changed (in `compare`) or shared."""
    def side(df: DataFrame, name: str) -> DataFrame:
        values = F.struct(*compare) if compare else F.struct(F.lit(1).alias("_one"))
        return df.select(*keys, values.alias(name))

    both = side(older, "_a").join(side(newer, "_b"), list(keys), "full")
    label = (
        F.when(F.col("_a").isNull(), "added")
        .when(F.col("_b").isNull(), "removed")
        .when(F.col("_a") == F.col("_b"), "shared")
        .otherwise("changed")
    )
    return both.select(*keys, label.alias("change"))


def key_sets(older: DataFrame, newer: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """Set difference both ways and intersection of the distinct keys."""
    a, b = older.select(*keys), newer.select(*keys)
    return {"added": b.subtract(a), "removed": a.subtract(b), "shared": a.intersect(b)}


def branch_view(main: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Main overlaid with a branch's own changes (latest row per key of its log, with op)."""
    untouched = main.join(delta.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(delta.where("op <> 'D'").select(*main.columns))


#: Versions whose running figures one task works out; the step from one such stretch to the next goes over
#: a row per stretch.
STRETCH = 10_000


def _running(df: DataFrame, value: str, total: str) -> DataFrame:
    """df (one row per version) with the sum of value up to each version and the version before (`parent`)."""
    df = df.withColumn("_stretch", F.floor(F.col("version") / STRETCH))
    whole = df.groupBy("_stretch").agg(F.sum(value).alias("_sum"), F.max("version").alias("_last"))
    before = Window.orderBy("_stretch")
    whole = whole.select(
        "_stretch", F.lag("_last").over(before).alias("_last"),
        F.coalesce(F.sum("_sum").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"),
    )
    within = Window.partitionBy("_stretch").orderBy("version")
    return (
        df.withColumn(total, F.sum(value).over(within)).withColumn("parent", F.lag("version").over(within))
        .join(whole, "_stretch")
        .withColumn(total, F.col(total) + F.col("_ahead")).withColumn("parent", F.coalesce("parent", "_last"))
        .drop("_stretch", "_ahead", "_last")
    )


def version_log(log: DataFrame, commits: DataFrame, keys: Sequence[str], message_like: str) -> DataFrame:
    """Commits whose message contains a text, newest first, with changes and rows after each.

    commits: version (unique), committed_at, message. The running total goes over one row
    per version, in stretches; the window before it over one key's versions.
    """
    by_key = Window.partitionBy(*keys).orderBy("version")
    previous = F.coalesce(F.lag("op").over(by_key), F.lit("D"))
    growth = (F.col("op") != "D").cast("int") - (previous != "D").cast("int")
    per_version = (
        log.withColumn("_growth", growth)
        .groupBy("version")
        .agg(F.count(F.lit(1)).alias("rows_changed"), F.sum("_growth").alias("_growth"))
    )
    joined = commits.join(per_version, "version", "left").fillna(0, ["_growth"])
    return (
        _running(joined, "_growth", "row_count")
        .withColumn("column_count", F.lit(len(log.columns) - 2))
        .where(F.contains("message", F.lit(message_like)))
        .select(
            "version", "committed_at", "message",
            F.coalesce("rows_changed", F.lit(0)).alias("rows_changed"), "row_count", "column_count",
        )
        .orderBy(F.desc("version"))
    )


def snapshots(log: DataFrame, commits: DataFrame) -> DataFrame:
    """One row per version: version, committed_at, parent (the version before), upserted, deleted."""
    changes = log.groupBy("version").agg(F.count_if(F.col("op") != "D").alias("upserted"), F.count_if(F.col("op") == "D").alias("deleted"))
    joined = commits.select("version", "committed_at").join(changes, "version", "left").fillna(0, ["upserted", "deleted"])
    return _running(joined, "upserted", "_total").drop("_total")


def partition_metrics(files: DataFrame) -> DataFrame:
    """Per partition of a file listing: files and bytes."""
    return files.groupBy("partition").agg(F.count(F.lit(1)).alias("files"), F.sum("file_bytes").alias("bytes"))


def join_counts(parts: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Full outer join of (key, value) summaries, one column per name, missing as 0."""
    named = [df.select(key, F.col(value).alias(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.join(b, key, "full"), named).fillna(0, list(parts))
