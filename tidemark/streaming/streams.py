"""Structured Streaming over landed files: append, deduplicate, window, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.keyed import latest_per_key
from tidemark.sinks.delta_log import MOST_BATCHES, MOST_SHARE, DeltaLog
from tidemark.sinks.tables import overwrite_slice, upsert_table


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files of a folder as a stream, in batches of at most `files_per_batch` files."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival per key; a key's state is dropped `delay` after its event time."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(
    stream: DataFrame, ts: str, delay: str, width: str, group: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """Tumbling windows; a window is emitted once the watermark has passed its end."""
    window = F.window(ts, width).alias("window")
    return stream.withWatermark(ts, delay).groupBy(window, *group).agg(*measures)


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, partition: Sequence[str] = ()
) -> StreamingQuery:
    """Append all available data to a table, exactly once, then stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition:
        writer = writer.partitionBy(*partition)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def land_stream(stream: DataFrame, path: str, checkpoint: str, partition: Sequence[str] = ()) -> StreamingQuery:
    """Land every micro-batch in partitions of its own (column _batch); compact them from time to time.

    A replayed batch replaces what its first attempt wrote. One checkpoint per table.
    """
    def land(batch: DataFrame, number: int) -> None:
        overwrite_slice(batch.withColumn("_batch", F.lit(number).cast("long")), path, [*partition, "_batch"])

    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[Column],
    partition: Sequence[str] = (),
    buckets: int = 64,
) -> StreamingQuery:
    """The newest row per key over everything that has arrived.

    A row that arrives late and is older than the table's row is ignored; a replayed
    batch changes nothing. Without a partition the table is cut into buckets of keys
    (column _bucket), and a batch rewrites the buckets it has keys of.
    """
    def merge(batch: DataFrame, _: int) -> None:
        newest = latest_per_key(batch, keys, order)
        if partition:
            upsert_table(newest, path, keys, partition, order=order)
        else:
            bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
            upsert_table(newest.withColumn("_bucket", bucket), path, keys, ["_bucket"], order=order)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def log_stream(
    stream: DataFrame, table: DeltaLog, checkpoint: str, most_batches: int = MOST_BATCHES, most_share: float = MOST_SHARE
) -> StreamingQuery:
    """The newest row per key by merge on read: a batch writes its own rows, whatever the table's size.

    Batches carry the stream's numbers, so a replayed one replaces what its first attempt
    wrote. The log is folded when it is long or large beside the base. Read with DeltaLog.read.
    """
    def merge(batch: DataFrame, number: int) -> None:
        table.write(batch, number)
        table.fold_if_large(most_batches, most_share)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
