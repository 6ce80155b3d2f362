"""A key index beside a partitioned table: which partitions can hold a key.

Each partition has bitmaps of its keys' hashes. A hash picks one of the partition's buckets
and a bit in it; a partition has so many buckets that a bitmap holds KEYS_PER_BITMAP keys on
average. A source becomes bitmaps of the same form, one set for each number of buckets that
occurs, and a partition is named where two bitmaps have a bit in common. Few bits of a bitmap
are set, so it is kept as the list of their places, some ten bytes a key. A partition
that is named in vain costs a read of its keys; none that holds a key is left out.

The index knows the files that it was made from. A partition whose files are others now,
by whatever writer, counts as one that can hold any key until it is indexed again: the index
can be old, and never wrong.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.tables import _delete_folders, _folders, _in_partitions, _same, append, exists, overwrite_slice, staged, upsert_table
from tidemark.sources.lake import read_table

#: Bits of a bitmap, as Spark's bitmap functions have them, and keys that one holds on average.
BITS, KEYS_PER_BITMAP = 32_768, 8
INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}.key-bits"


@contextmanager
def _texts(spark: SparkSession):
    """Partition values are read as the texts that folders are named by."""
    before = spark.conf.get(INFERENCE)
    spark.conf.set(INFERENCE, "false")
    try:
        yield
    finally:
        spark.conf.set(INFERENCE, before)


def listed_files(spark: SparkSession, path: str, types: Sequence[T.StructField]) -> DataFrame:
    """The partition columns, file_path and file_bytes of every data file, from the listing alone."""
    with _texts(spark):
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    values = [F.col(f.name).cast(f.dataType).alias(f.name) for f in types]
    return listing.select(*values, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_bytes"))


def _fields(schema: T.StructType, names: Sequence[str]) -> list[T.StructField]:
    return [schema[n] for n in names]


def _state(spark: SparkSession, path: str, types: Sequence[T.StructField]) -> DataFrame:
    """The partitions, and files: a fingerprint of the files that each has."""
    mark = F.bit_xor(F.xxhash64("file_path", "file_bytes"))
    return listed_files(spark, path, types).groupBy(*[f.name for f in types]).agg(mark.alias("files"))


def _read(spark: SparkSession, path: str, types: Sequence[T.StructField]) -> DataFrame:
    own = T.StructType.fromDDL("files bigint, buckets bigint, bucket bigint, bits array<int>")
    schema = T.StructType([*own.fields, *types])
    if not exists(spark, index_path(path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(index_path(path))


def _place(h: Column, buckets: Column) -> tuple[Column, Column]:
    """Bucket and bit of a hash."""
    return F.pmod(h, buckets), F.pmod(F.shiftrightunsigned(h, 40), F.lit(BITS))


def _bitmaps(hashes: DataFrame, by: Sequence[str]) -> DataFrame:
    bucket, bit = _place(F.col("h"), F.col("buckets"))
    return hashes.withColumns({"bucket": bucket, "bit": bit}).groupBy(*by, "buckets", "bucket").agg(F.sort_array(F.collect_set(F.col("bit").cast("int"))).alias("bits"))


def _not_indexed(state: DataFrame, index: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Partitions whose files are not those of their index."""
    known = index.select(*partition, "files").distinct()
    return state.alias("_now").join(known.alias("_known"), _same([*partition, "files"], "_now", "_known"), "left_anti").select(*partition)


def refresh(spark: SparkSession, path: str, keys: Sequence[str], partition: Sequence[str], schema: T.StructType) -> None:
    """Indexes the partitions whose files have changed, and forgets those that are gone."""
    types = _fields(schema, partition)
    with staged(_state(spark, path, types)) as state, \
            staged(_not_indexed(state, _read(spark, path, types), partition)) as stale:
        table = read_table(spark, path, schema=schema).select(*keys, *[p for p in partition if p not in keys])
        rows = _in_partitions(table, stale, partition).select(*partition, F.xxhash64(*keys).alias("h"))
        with staged(rows) as hashes:
            # Numbers of buckets are powers of two, so that few of them occur.
            size = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), F.count(F.lit(1)) / KEYS_PER_BITMAP)))).cast("bigint")
            sizes = hashes.groupBy(*partition).agg(size.alias("buckets"))
            marked = state.alias("s").join(sizes.alias("n"), _same(partition, "s", "n")).select("s.*", "n.buckets")
            sized = hashes.alias("h").join(marked.alias("m"), _same(partition, "h", "m")).select("h.*", "m.files", "m.buckets")
            made = _bitmaps(sized, [*partition, "files"])
            overwrite_slice(made, index_path(path), partition)
        index = _read(spark, path, types)
        held = index.select(*partition).distinct().alias("_held")
        gone = held.join(state.alias("_now"), _same(partition, "_held", "_now"), "left_anti")
        with staged(_folders(index, gone, partition)) as folders:
            _delete_folders(folders)


def candidates(source: DataFrame, path: str, keys: Sequence[str], partition: Sequence[str], schema: T.StructType) -> DataFrame:
    """Partitions of the table that can hold a key of the source."""
    spark, types = source.sparkSession, _fields(schema, partition)
    index, state = _read(spark, path, types), _state(spark, path, types)
    unknown = _not_indexed(state, index, partition)
    sizes = [r[0] for r in index.select("buckets").distinct().collect()]  # powers of two: 63 at most
    asked = source.select(F.xxhash64(*keys).alias("h"), F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<bigint>")).alias("buckets"))
    asked = _bitmaps(asked, []).withColumnRenamed("bits", "asked")
    hit = index.join(asked, ["buckets", "bucket"]).where(F.arrays_overlap("bits", "asked")).select(*partition)
    return hit.union(unknown).distinct()


def upsert_indexed(source: DataFrame, path: str, keys: Sequence[str], partition: Sequence[str], order: Sequence[Column] = ()) -> None:
    """upsert_table with keys that may move, which searches and rewrites only partitions that the index names.

    The table's first upsert writes it; afterwards the index is brought up to date. One that
    dies before that leaves the index old. Texts that storage keeps as NULL are as in upsert_table.
    """
    spark = source.sparkSession
    if exists(spark, path):
        upsert_table(source, path, keys, partition, moves=True, order=order,
                     among=lambda rows: candidates(rows, path, keys, partition, source.schema))
    else:
        append(source, path, partition)
    refresh(spark, path, keys, partition, source.schema)
