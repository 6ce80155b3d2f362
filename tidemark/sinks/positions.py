"""Deleting rows by their position: no data file is rewritten.

A delete appends the deleted rows' files and row numbers to a small table beside the data.
Reading leaves these rows out; a fold rewrites the partitions that have some. File names are never
used twice, so positions in files that are gone match nothing, and a fold that dies after it
has replaced its partitions leaves nothing wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.tables import _delete, _folders, _delete_folders, _in_partitions, _same, exists, overwrite_slice, staged
from tidemark.sources.lake import has_rows, read_table

POSITION = T.StructType([T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType())])


def positions_path(path: str) -> str:
    return f"{path.rstrip('/')}.deleted"


def deleted(spark: SparkSession, path: str) -> DataFrame:
    """_file, _row of every deleted row; a row that was deleted twice is there twice."""
    if not exists(spark, positions_path(path)):
        return spark.createDataFrame([], POSITION)
    return spark.read.schema(POSITION).parquet(positions_path(path))


def _placed(table: DataFrame) -> DataFrame:
    return table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def read_live(spark: SparkSession, path: str, schema: T.StructType | None = None, where: Column | None = None) -> DataFrame:
    """The table without its deleted rows; the condition is pushed into the scan. Without deletes it is a plain scan."""
    table = read_table(spark, path, schema=schema)
    chosen = _placed(table if where is None else table.where(where))
    if not exists(spark, positions_path(path)):
        return chosen.select(*table.columns)
    return chosen.join(deleted(spark, path), ["_file", "_row"], "left_anti").select(*table.columns)


def delete_by_position(spark: SparkSession, path: str, predicate: Column, schema: T.StructType | None = None) -> None:
    """Deletes the rows for which the predicate is true. Its own files hold their positions and nothing else."""
    found = _placed(read_table(spark, path, schema=schema).where(predicate)).select("_file", "_row")
    found.join(deleted(spark, path), ["_file", "_row"], "left_anti").hint("rebalance").write.mode("append").parquet(positions_path(path))


def fold_deletes(spark: SparkSession, path: str, partition: Sequence[str], schema: T.StructType | None = None) -> bool:
    """Rewrites the partitions with deleted rows without them, and forgets the positions; False if there are none."""
    gone = deleted(spark, path)
    if not has_rows(gone):
        return False
    table = read_table(spark, path, schema=schema)
    files = gone.select("_file").distinct()
    placed = table.select(*partition, F.col("_metadata.file_path").alias("_file")).distinct()
    with staged(placed.join(files, "_file", "left_semi").select(*partition).distinct()) as touched:
        live = _placed(table).join(gone, ["_file", "_row"], "left_anti").select(*table.columns)
        kept = _in_partitions(live, touched, partition)
        used = kept.select(*partition).distinct().alias("_used")
        emptied = touched.alias("_touched").join(used, _same(partition, "_touched", "_used"), "left_anti")
        with staged(_folders(table, emptied, partition)) as folders:
            overwrite_slice(kept, path, partition)
            _delete_folders(folders)
    _delete(spark, positions_path(path))
    return True
