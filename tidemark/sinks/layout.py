"""File layout: statistics, small-file compaction, orphan files.

File lists come from Spark's own sources, so they are distributed data; only the
number of output files of a compaction reaches the driver. Files are named by the URI
that Spark's file metadata gives, on every side alike; partitions by their folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import join_counts
from tidemark.sinks.tables import _delete, _filesystem, _in_partitions, staged
from tidemark.sources.lake import read_table

# Defaults for production tables.
TARGET_FILE_BYTES = 128 * 1024 * 1024
MIN_INPUT_FILES = 5


def _plain(uri: Column) -> Column:
    """A URI's path as storage has it; a plus sign is no blank in a path."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def _partition_of(uri: Column) -> Column:
    """The key=value folders of a data file."""
    inner = F.regexp_extract(_plain(uri), r"((?:[^/=]+=[^/]+/)+)[^/]+$", 1)
    return F.rtrim(inner, F.lit("/"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """file_path, file_bytes, partition of every data file, from the listing alone."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return listing.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_bytes"),
        _partition_of(F.col("_metadata.file_path")).alias("partition"),
    )


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """file_path and its row count."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file_path"))
    return rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count"))


def file_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per partition: files, rows, bytes, average file size."""
    data = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_bytes")
    )
    files = data.groupBy("file_path", "file_bytes").agg(F.count(F.lit(1)).alias("row_count"))
    return (
        files.groupBy(_partition_of(F.col("file_path")).alias("partition"))
        .agg(
            F.count(F.lit(1)).alias("file_count"),
            F.sum("row_count").alias("total_rows"),
            F.sum("file_bytes").alias("total_bytes"),
            F.floor(F.avg("file_bytes")).alias("avg_bytes_per_file"),
        )
    )


def footprint(summary: DataFrame) -> DataFrame:
    """Whole-table files, rows and bytes of a file_summary."""
    return summary.agg(
        F.sum("file_count").alias("files"), F.sum("total_rows").alias("rows"), F.sum("total_bytes").alias("bytes")
    )


def column_stats(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """file_path and per column c: c_min, c_max (of the column's type), c_nulls, c_values."""
    return stats_per_file(spark.read.parquet(path), columns)


def stats_per_file(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_stats of rows that were read from files.

    Spark sorts all rows of a task for the smallest of texts, as it has no hash aggregate of
    them. So texts are first reduced to a row for each file of a batch; the rest needs no sort.
    """
    kinds = {f.name: f.dataType for f in rows.select(*columns).schema}
    texts = [c for c in columns if isinstance(kinds[c], (T.StringType, T.BinaryType))]
    file = F.col("_metadata.file_path").alias("file_path")
    measures = []
    for c in columns:
        ends = [] if c in texts else [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
        measures += [*ends, F.count_if(F.isnull(c)).alias(f"{c}_nulls"), F.count(c).alias(f"{c}_values")]
    found = rows.groupBy(file).agg(*measures)
    if texts:
        found = found.join(_text_ends(rows.select(file, *texts), texts, kinds), "file_path")
    return found.select("file_path", *[f"{c}_{m}" for c in columns for m in ("min", "max", "nulls", "values")])


def _text_ends(rows: DataFrame, texts: Sequence[str], kinds: dict[str, T.DataType]) -> DataFrame:
    """file_path, c_min and c_max of each of texts, compared by their bytes; rows: file_path and the texts."""
    ends = [(n, m) for n in range(len(texts)) for m in ("min", "max")]

    def reduce_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.Table.from_batches([batch]).rename_columns(["file_path", *[f"c{n}" for n in range(len(texts))]])
            least = plain.group_by("file_path").aggregate([(f"c{n}", m) for n, m in ends])
            yield from least.select(["file_path", *[f"c{n}_{m}" for n, m in ends]]).combine_chunks().to_batches()

    schema = T.StructType([T.StructField("file_path", T.StringType()), *[T.StructField(f"c{n}_{m}", kinds[texts[n]]) for n, m in ends]])
    reduced = rows.mapInArrow(reduce_, schema)
    named = [(F.min if m == "min" else F.max)(f"c{n}_{m}").alias(f"{texts[n]}_{m}") for n, m in ends]
    return reduced.groupBy("file_path").agg(*named)


def merge_stats(stats: DataFrame, columns: Sequence[str], by: Sequence[Column] = ()) -> DataFrame:
    """Statistics of files put together, for the table or per group."""
    measures = []
    for c in columns:
        measures += [
            F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max"),
            F.sum(f"{c}_nulls").alias(f"{c}_nulls"), F.sum(f"{c}_values").alias(f"{c}_values"),
        ]
    return stats.groupBy(*by).agg(*measures)


def orphan_files(listing: DataFrame, referenced: DataFrame) -> DataFrame:
    """Files on storage that no table version references; a report, nothing is deleted."""
    return listing.join(referenced.select("file_path"), "file_path", "left_anti")


def compare_layouts(summaries: dict[str, DataFrame]) -> DataFrame:
    """File count per partition at several moments, 0 where a partition is absent."""
    return join_counts(summaries, "partition", "file_count")


def compaction_plan(
    spark: SparkSession, path: str, min_input_files: int = MIN_INPUT_FILES, target_bytes: int = TARGET_FILE_BYTES
) -> DataFrame:
    """Partitions with enough files under half the target size: partition, files_before, files_after."""
    small = F.col("file_bytes") < target_bytes / 2
    per_part = list_files(spark, path).groupBy("partition").agg(
        F.count_if(small).alias("small_files"),
        F.count(F.lit(1)).alias("files_before"),
        F.sum("file_bytes").alias("total_bytes"),
    )
    return per_part.where(F.col("small_files") >= min_input_files).select(
        "partition", "files_before", "total_bytes",
        F.ceil(F.col("total_bytes") / F.lit(target_bytes)).cast("int").alias("files_after"),
    )


def compact(
    spark: SparkSession,
    path: str,
    partition: Sequence[str],
    min_input_files: int = MIN_INPUT_FILES,
    target_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite partitions with many small files into files of about the target size.

    Returns the number of files asked for (0: nothing to do). Rows of a partition are
    spread over its files by a hash of their position in the old files, which is the
    same in every retry; a partition of any size is written by many tasks.
    """
    plan = compaction_plan(spark, path, min_input_files, target_bytes).select("partition", "files_after")
    table = read_table(spark, path)
    present = table.select(*partition, F.col("_metadata.file_path").alias("file_path")).distinct()
    present = present.select(*partition, _partition_of(F.col("file_path")).alias("partition")).distinct()
    # Output files are numbered through; the numbering goes over a row per partition.
    upto = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("files_after").over(upto), F.lit(0)).cast("int")
    with staged(present.join(plan, "partition").withColumn("first_file", first)) as chosen:
        files = chosen.agg(F.sum("files_after")).first()[0]
        if not files:
            return 0
        at = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        rows = _in_partitions(table.select("*", at.alias("_at")), chosen, partition)
        named = [F.col(c).alias(f"_p{n}") for n, c in enumerate(partition)]
        here = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p{n}")) for n, c in enumerate(partition)])
        numbered = rows.join(chosen.select(*named, "files_after", "first_file"), here)
        slot = (F.col("first_file") + F.pmod("_at", F.col("files_after"))).cast("int")
        result = numbered.repartitionById(int(files), slot).select(*table.columns)
        writer = result.write.mode("overwrite").partitionBy(*partition)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return int(files)


# --- small files only -----------------------------------------------------------

#: Files that one round of pack_small_files names to the scan.
FILES_AT_ONCE = 10_000


def bins(files: DataFrame, target_bytes: int = TARGET_FILE_BYTES, min_input_files: int = 2) -> DataFrame:
    """partition, bin, file_path, file_bytes: whole small files packed into bins of about the target size.

    Files of half the target or more are left alone. A partition's small files are taken by
    size, largest first, and cut into bins where their running size passes the target, so a
    bin is under one and a half targets. Bins of fewer than min_input_files are not made.
    """
    small = files.where(F.col("file_bytes") < target_bytes / 2)
    before = Window.partitionBy("partition").orderBy(F.desc("file_bytes"), "file_path").rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum("file_bytes").over(before), F.lit(0))
    packed = small.withColumn("bin", F.floor(running / F.lit(target_bytes)).cast("long"))
    count = F.count(F.lit(1)).over(Window.partitionBy("partition", "bin"))
    return packed.withColumn("n", count).where(F.col("n") >= min_input_files).select("partition", "bin", "file_path", "file_bytes")


def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(uri))


def _pending(spark: SparkSession, path: str) -> list[str]:
    """Folders of packings that were planned and not finished."""
    fs, p = _filesystem(spark, path)
    start = f"{p.getName()}.packed-"
    found = [f.getPath() for f in fs.listStatus(p.getParent()) if f.getPath().getName().startswith(start)]
    return [f.toString() for f in found]


def finish_packing(spark: SparkSession, path: str) -> None:
    """Puts right a packing that died: one whose files were all written is carried through, another is dropped."""
    for folder in _pending(spark, path):
        fs, done = _filesystem(spark, f"{folder}/old/_SUCCESS")
        if fs.exists(done):
            _put_in_place(spark, path, folder)
        else:
            _delete(spark, folder)


def _put_in_place(spark: SparkSession, path: str, folder: str) -> None:
    """Old files go before new ones come in, so that no row is there twice; every step can be repeated."""
    fs, _ = _filesystem(spark, path)
    for row in spark.read.parquet(f"{folder}/old").toLocalIterator():
        fs.delete(_path(spark, row["file_path"]), False)
    root = fs.makeQualified(_filesystem(spark, f"{folder}/new")[1]).toString()
    names = spark._jvm.org.apache.hadoop.fs.Path
    for row in list_files(spark, f"{folder}/new").select("file_path").toLocalIterator():
        new = _path(spark, row["file_path"])
        to = names(f"{path}{fs.makeQualified(new).toString().removeprefix(root)}")
        fs.mkdirs(to.getParent())
        fs.rename(new, to)
    _delete(spark, folder)


def pack_small_files(
    spark: SparkSession, path: str, partition: Sequence[str], target_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = 2, schema: T.StructType | None = None,
) -> int:
    """Writes each bin of small files as one file; larger files are neither read nor moved. Returns the number of bins.

    New files are written beside the table, then the list of old ones; from then on the packing is
    carried through, if need be by the next call (finish_packing). Between the two the table lacks
    rows: nothing else may read or write it meanwhile.
    """
    finish_packing(spark, path)
    schema = schema or read_table(spark, path).schema
    made = 0
    with staged(bins(list_files(spark, path), target_bytes, min_input_files)) as plan:
        number = Window.orderBy("partition", "bin")  # over a row per bin
        numbered = plan.groupBy("partition", "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("slot", F.row_number().over(number) - 1)
        upto = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        rounds = numbered.withColumn("round", F.floor(F.coalesce(F.sum("n").over(upto), F.lit(0)) / FILES_AT_ONCE))
        with staged(plan.join(rounds.select("partition", "bin", "slot", "round"), ["partition", "bin"])) as chosen:
            for (n,) in chosen.select("round").distinct().orderBy("round").collect():
                made += _pack(spark, path, partition, chosen.where(F.col("round") == n), schema)
    return made


def _pack(spark: SparkSession, path: str, partition: Sequence[str], chosen: DataFrame, schema: T.StructType) -> int:
    folder = f"{path.rstrip('/')}.packed-{uuid.uuid4().hex}"
    names = [_path(spark, r["file_path"]).toString() for r in chosen.select("file_path").collect()]  # FILES_AT_ONCE and a bin at most
    ends = chosen.agg(F.min("slot"), F.max("slot")).first()
    rows = spark.read.schema(schema).option("basePath", path).parquet(*names)
    slots = chosen.select("file_path", (F.col("slot") - ends[0]).cast("int").alias("_slot"))
    placed = rows.select("*", F.col("_metadata.file_path").alias("file_path")).join(slots, "file_path")
    n_bins = ends[1] - ends[0] + 1
    one_each = placed.repartitionById(n_bins, F.col("_slot")).select(*schema.names)
    one_each.write.partitionBy(*partition).parquet(f"{folder}/new")
    chosen.select("file_path").write.parquet(f"{folder}/old")
    _put_in_place(spark, path, folder)
    return n_bins
