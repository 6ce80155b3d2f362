"""Writing lake tables.

Partitioned tables are rewritten by dynamic partition overwrite: Spark writes all
new files beside the table and swaps in only the partitions of the result when every
task has finished, so a job may read the partitions it replaces and lost executors
cost only retries. Unpartitioned tables are written to a sibling folder and renamed;
a run that died between the renames is put right before the table is next used.
Partition values keep the type of the source; folders are those that the files are in,
so NULL, escaped and number-like values are found. An empty text is stored as NULL.
One writer per table and run is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keyed import upsert, upsert_newest
from tidemark.operators.scd import OPEN_END, open_versions, scd2_apply
from tidemark.session import shared_folder
from tidemark.sources.lake import has_rows, read_table, table_exists

class EmptySourceError(ValueError):
    """Raised instead of replacing a slice by nothing."""


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder that must be there."""
    fs, p = _filesystem(spark, path)
    if not fs.delete(p, True):
        raise FileNotFoundError(path)


def _delete_folders(folders: DataFrame) -> None:
    """Deletes folders (column folder, as URI), a few in memory at a time."""
    spark = folders.sparkSession
    for row in folders.toLocalIterator():
        uri = spark._jvm.java.net.URI.create(row["folder"])
        _delete(spark, spark._jvm.org.apache.hadoop.fs.Path(uri).toString())


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = _filesystem(spark, src)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"cannot rename {src} to {dst}")


def recover(spark: SparkSession, path: str) -> None:
    """Undoes a full swap that died after moving the table away: its old state comes back."""
    fs, p = _filesystem(spark, path)
    if fs.exists(p) or not fs.exists(p.getParent()):
        return
    left = [f.getPath() for f in fs.listStatus(p.getParent()) if f.getPath().getName().startswith(f"{p.getName()}.old-")]
    if left:
        _rename(spark, left[0].toString(), path)


def exists(spark: SparkSession, path: str) -> bool:
    """table_exists after recover."""
    recover(spark, path)
    return table_exists(spark, path)


def _stored(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Partition values as storage keeps them: an empty text is NULL."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)} & set(partition)
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts}) if texts else df


def _balanced(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Few, evenly sized files per partition; AQE splits partitions that are too large."""
    return df.hint("rebalance", *[F.col(c) for c in partition]) if partition else df.hint("rebalance")


#: Write options of landed rows: their payloads are repetitive texts.
LANDED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def append(df: DataFrame, path: str, partition: Sequence[str] = (), landed: bool = False) -> None:
    """landed: rows of one partition, written by the tasks that read them, with no shuffle."""
    rows = df if landed else _balanced(df, partition)
    rows.write.options(**LANDED if landed else {}).mode("append").partitionBy(*partition).parquet(path)


def overwrite_slice(df: DataFrame, path: str, partition: Sequence[str], landed: bool = False) -> None:
    """Replace exactly the partitions present in df; landed: as for append."""
    rows = df if landed else _balanced(df, partition)
    writer = rows.write.options(**LANDED if landed else {}).mode("overwrite").partitionBy(*partition)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and return the number of rows, observed during the write itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    try:
        return seen.get["rows"]
    except Py4JJavaError as e:
        # From a plan it finds to be empty Spark drops the metric; its row has no columns then.
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def overwrite_slice_checked(df: DataFrame, path: str, partition: Sequence[str], landed: bool = False) -> int:
    """overwrite_slice that reports an empty source; no partition is touched then."""
    rows = counted(df, lambda d: overwrite_slice(d, path, partition, landed))
    if rows == 0:
        raise EmptySourceError(f"no source rows for {path}")
    return rows


def swap_full(df: DataFrame, path: str) -> None:
    """Replace a whole unpartitioned table; df may read the table itself.

    An empty result is refused and leaves the table as it is.
    """
    spark, tag = df.sparkSession, uuid.uuid4().hex
    staged, old = f"{path}.staged-{tag}", f"{path}.old-{tag}"
    if counted(df, lambda d: _balanced(d, ()).write.parquet(staged)) == 0:
        _delete(spark, staged)
        raise EmptySourceError(f"no source rows for {path}")
    if exists(spark, path):
        _rename(spark, path, old)
        _rename(spark, staged, path)
        _delete(spark, old)
    else:
        _rename(spark, staged, path)


def recreate(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Drop the table, if there is one, and write it anew."""
    if exists(df.sparkSession, path):
        _delete(df.sparkSession, path)
    append(df, path, partition)


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    """All columns equal, NULL equal to NULL."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


#: Partitions that are named one by one when a scan is cut to them.
PARTS_NAMED = 2_000


def _in_partitions(table: DataFrame, parts: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Rows of the given partitions (a frame of partition values).

    Up to PARTS_NAMED values are named, which prunes folders at planning however far apart
    they are; of more, the scan is cut to the smallest and largest value of each column, or
    NULL. A semi join does what is left: by equality, so that Spark can prune by its values as
    well, and NULL-safe only for values with a NULL.
    """
    values = parts.select(*partition).distinct().limit(PARTS_NAMED + 1).collect()
    named = len(values) <= PARTS_NAMED
    for c in partition:
        known = {r[c] for r in values if r[c] is not None}
        if named:
            within = F.col(c).isin(list(known)) if known else F.lit(False)
            nulls = any(r[c] is None for r in values)
        else:
            row = parts.agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count_if(F.isnull(c)).alias("nulls")).first()
            within = F.col(c).between(F.lit(row["lo"]), F.lit(row["hi"])) if row["lo"] is not None else F.lit(False)
            nulls = row["nulls"] > 0
        table = table.where(within | F.col(c).isNull() if nulls else within)
    if named and len(partition) == 1:
        return table
    wanted = parts.select(*partition).distinct()
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in partition])
    found = table.join(wanted.where(whole), list(partition), "left_semi").select(*table.columns)
    if named and all(r[c] is not None for r in values for c in partition):
        return found
    odd = table.where(~whole).alias("_table").join(wanted.where(~whole).alias("_wanted"), _same(partition, "_table", "_wanted"), "left_semi")
    return found.unionByName(odd)


def _with_folder(table: DataFrame) -> DataFrame:
    """The table's rows with the folder of their file, as URI."""
    file = F.col("_metadata.file_path")
    return table.select("*", F.regexp_replace(file, "/[^/]*$", "").alias("folder"))


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The frame written once to the shared folder, so several passes do not recompute it."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "stage")
    df.write.parquet(folder)
    try:
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        _delete(spark, folder)


def upsert_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition: Sequence[str] = (),
    moves: bool = False,
    order: Sequence[Column] = (),
    among: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Insert or replace by key, rewriting only partitions that hold or receive source keys.

    With moves=False the partition of a key is fixed (it is part of the key) and the
    source's partitions are all that is touched. With moves=True the old rows of a key
    are also looked for in other partitions: in all, or where a function of the source
    (`among`, as of a key index) names those that can hold its keys. With an order, a source row replaces the
    table's row only if it comes first in that order. The table's columns have the
    source's types.
    """
    def merge(target: DataFrame, rows: DataFrame) -> DataFrame:
        return upsert_newest(target, rows, keys, order) if order else upsert(target, rows, keys)

    if not exists(source.sparkSession, path):
        append(source, path, partition)
        return
    with staged(_stored(source, partition)) as rows:
        if not partition:
            swap_full(merge(read_table(rows.sparkSession, path), rows), path)
        else:
            _upsert_partitions(rows, path, list(keys), list(partition), moves, merge, among and among(rows))


def _upsert_partitions(
    source: DataFrame,
    path: str,
    keys: list[str],
    partition: list[str],
    moves: bool,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    among: DataFrame | None = None,
) -> None:
    """among: the only partitions besides the source's that can hold its keys; None if that is not known."""
    target = read_table(source.sparkSession, path, schema=source.schema)
    parts = source.select(*partition).distinct()
    if not moves:
        overwrite_slice(merge(_in_partitions(target, parts, partition), source), path, partition)
        return
    searched = target if among is None else _in_partitions(target, among, partition)
    held = searched.select(*dict.fromkeys([*keys, *partition])).join(source.select(*keys), keys, "left_semi")
    with staged(parts.union(held.select(*partition)).distinct()) as parts, \
            staged(merge(_in_partitions(target, parts, partition), source)) as merged:
        used = merged.select(*partition).distinct().alias("_used")
        emptied = parts.alias("_parts").join(used, _same(partition, "_parts", "_used"), "left_anti")
        with staged(_folders(target, emptied, partition)) as folders:
            overwrite_slice(merged, path, partition)
            _delete_folders(folders)


def _folders(table: DataFrame, parts: DataFrame, partition: Sequence[str]) -> DataFrame:
    """The folders of the partitions that the table has files in."""
    return _in_partitions(_with_folder(table).select(*partition, "folder"), parts, partition).select("folder").distinct()


def delete_from_table(
    spark: SparkSession, path: str, predicate: Column, partition: Sequence[str], schema: T.StructType | None = None
) -> None:
    """Delete rows of a partitioned table, rewriting only partitions that lose rows.

    The predicate is pushed into the scan that finds them. Without a schema partition
    values have the types that Spark guesses ('01' becomes 1, and is written back so):
    give it where texts look like numbers.
    """
    table, gone = read_table(spark, path, schema=schema), F.coalesce(predicate, F.lit(False))
    with staged(table.where(predicate).select(*partition).distinct()) as touched:
        if not has_rows(touched):
            return
        kept = _in_partitions(table, touched, partition).where(~gone)
        used = kept.select(*partition).distinct().alias("_used")
        emptied = touched.alias("_touched").join(used, _same(partition, "_touched", "_used"), "left_anti")
        with staged(_folders(table, emptied, partition)) as folders:
            overwrite_slice(kept, path, partition)
            _delete_folders(folders)


def load_once(df: DataFrame, path: str, day_column: str, day: Column, partition: Sequence[str]) -> bool:
    """Append a day unless the table already holds rows of it; True if written."""
    spark = df.sparkSession
    if exists(spark, path) and has_rows(read_table(spark, path), F.col(day_column) == day):
        return False
    append(df, path, partition)
    return True


def scd2_table(
    source: DataFrame, path: str, key: str, tracked: Sequence[str], effective: str, sk: str,
    close_missing: bool = False,
) -> None:
    """One SCD2 run on a table partitioned by the day a version was closed.

    Open versions share one partition and every run closes into its own, so a run
    reads and rewrites these two and never the older history.
    """
    if close_missing and source.isEmpty():
        raise EmptySourceError(f"an empty source would close every open version of {path}")
    spark, closed_on = source.sparkSession, F.to_date("_effective_to").alias("_closed_on")
    if exists(spark, path):
        dim = read_table(spark, path)
        recent = dim.where(F.col("_closed_on").isin(OPEN_END[:10], effective)).drop("_closed_on")
        result = scd2_apply(recent, source, key, tracked, effective, sk, close_missing)
    else:
        result = open_versions(source, key, tracked, effective, sk)
    overwrite_slice(result.select("*", closed_on), path, ["_closed_on"])
