"""Finding the keys that differ between two copies of a table by a tree of checksums.

Rows are stored by ranges of their key's hash. A leaf of the tree is one of 65,536 ranges with
its row count and order-free content sums; every node above sums up 16 below it. Comparison
goes down from the root and only under nodes that differ, on tables of at most 70,000 rows;
then only the ranges of leaves that differ are read, by the names of their folders. Equal
copies are never read again after their trees were written.

The row hash has 64 bits and takes NULLs into account by column; it is summed in three parts of 22
bits at most, so repeated rows count and sums stay in bigint for 10^12 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import written_once

#: Levels under the root, bits of the key hash per level, and the first bits that name a folder (of a large table).
DEPTH, BITS, FOLDER_BITS = 4, 4, 8
SUMS = ("n_rows", "c0", "c1", "c2")


def _leading(keys: Sequence[str], bits: int) -> Column:
    nulls = [F.col(k).isNull() for k in keys]
    return F.shiftrightunsigned(F.xxhash64(*keys, *nulls), 64 - bits).cast("int")


def _sums(columns: Sequence[str], only: Column | None = None) -> list[Column]:
    """Row count and content sums, of the rows for which a condition holds."""
    h = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    parts = [F.lit(1).cast("long"), *[F.shiftrightunsigned(h, s).bitwiseAND(F.lit((1 << 22) - 1)) for s in (0, 22, 44)]]
    return [F.coalesce(F.sum(p if only is None else F.when(only, p)), F.lit(0)) for p in parts]


def write(df: DataFrame, keys: Sequence[str], path: str, folder_bits: int = FOLDER_BITS) -> None:
    """Writes rows by ranges of the key hash (2 ** folder_bits folders), and their tree, to a fresh folder."""
    ranged = df.withColumn("_range", _leading(keys, folder_bits))
    ranged.hint("rebalance", F.col("_range")).write.partitionBy("_range").parquet(f"{path}/rows")
    ranged.where(F.lit(False)).write.parquet(f"{path}/columns")  # an empty copy has no other file that tells them
    stored = df.sparkSession.read.schema(ranged.schema).parquet(f"{path}/rows")
    names = sorted(df.columns)
    leaves = stored.groupBy(_leading(keys, DEPTH * BITS).alias("leaf")).agg(
        *[c.alias(n) for n, c in zip(SUMS, _sums(names))])
    above = F.array(*[
        F.struct(F.lit(level).alias("level"), F.shiftright("leaf", BITS * (DEPTH - level)).alias("node"))
        for level in range(DEPTH + 1)
    ])
    nodes = leaves.select(F.inline(above), *SUMS).groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in SUMS])
    nodes.coalesce(1).write.parquet(f"{path}/tree")


def differing_leaves(spark: SparkSession, before: str, after: str) -> DataFrame:
    """leaf: leaves that differ between two written copies, found from the root down."""
    trees = [spark.read.parquet(f"{path}/tree") for path in (before, after)]
    under = None
    for level in range(DEPTH + 1):
        sides = []
        for name, tree in zip("ab", trees):
            nodes = tree.where(F.col("level") == level).select("node", F.struct(*SUMS).alias(name))
            if under is not None:
                nodes = nodes.join(under, F.shiftright("node", BITS) == F.col("parent"), "left_semi")
            sides.append(nodes)
        apart = sides[0].join(sides[1], "node", "full").where(~F.col("a").eqNullSafe(F.col("b")))
        under = apart.select(F.col("node").alias("parent"))
    return under.withColumnRenamed("parent", "leaf")


def changed_keys(spark: SparkSession, before: str, after: str, keys: Sequence[str], folder_bits: int = FOLDER_BITS) -> DataFrame:
    """keys and change (added, removed, changed) of two written copies with the same columns and types.

    NULL is a key like any other; a key of several rows is changed if they differ as a bag.
    """
    leaves = differing_leaves(spark, before, after)
    leaves = written_once(leaves, "leaves")
    first = F.shiftright("leaf", DEPTH * BITS - folder_bits).alias("range")
    ranges = [r["range"] for r in leaves.select(first).distinct().collect()]  # at most 2 ** folder_bits
    schemas = [spark.read.parquet(f"{path}/columns").schema for path in (before, after)]
    if sorted((f.name, f.dataType.simpleString()) for f in schemas[0]) != sorted((f.name, f.dataType.simpleString()) for f in schemas[1]):
        raise ValueError("the two copies have different columns")
    names = sorted(c for c in schemas[0].names if c != "_range")

    def side(path: str, schema, is_before: bool) -> DataFrame:
        rows = spark.read.schema(schema).parquet(f"{path}/rows").where(F.col("_range").isin(ranges) if ranges else F.lit(False))
        rows = rows.withColumn("_leaf", _leading(keys, DEPTH * BITS)).join(leaves, F.col("_leaf") == F.col("leaf"), "left_semi")
        return rows.select(*names, F.lit(is_before).alias("_before"))

    both = side(before, schemas[0], True).unionByName(side(after, schemas[1], False))
    totals = both.groupBy(*keys).agg(
        F.struct(*_sums(names, F.col("_before"))).alias("_a"), F.struct(*_sums(names, ~F.col("_before"))).alias("_b"))
    change = F.when(F.col("_a.col1") == 0, "added").when(F.col("_b.col1") == 0, "removed").otherwise("changed")
    return totals.where("_a <> _b").select(*keys, change.alias("change"))
