"""Keyed tables as a base and a log of batches, merged when they are read.

A batch writes its own rows and nothing else: a folder per batch, replaced as a whole when the
batch is repeated. Reading takes, per key, the first row in the table's order over the base
and the batches after it; only rows whose key the log holds are shuffled. A fold writes
what is read as a new base. Folders count once their writer has committed them (the marker
file that Spark writes last), so a batch or a fold that dies leaves the table as it was.

Layout: base/_upto=N holds batches up to N, log/_batch=N the rows of batch N. What a
fold made needless is deleted by the fold after it, so that a reader which began before
a fold can finish. One writer per table; batches are numbered upwards.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keyed import latest_per_key
from tidemark.sinks.tables import _balanced, _delete, _filesystem

#: A log is folded when it has so many batches, or so large a share of the base's bytes.
MOST_BATCHES, MOST_SHARE = 50, 0.25


def committed(spark: SparkSession, folder: str, column: str) -> list[int]:
    """Numbers N of the committed folders column=N, rising."""
    fs, root = _filesystem(spark, folder)
    if not fs.exists(root):
        return []
    found = [(re.fullmatch(rf"{column}=(\d+)", s.getPath().getName()), s.getPath()) for s in fs.listStatus(root)]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(m[1]) for m, p in found if m and fs.exists(marker(p, "_SUCCESS")))


def matching(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows joined to other's keys, NULL as a key like any other; how: left_semi or left_anti."""
    other = other.select(*keys).alias("_other")
    same = reduce(lambda a, b: a & b, [F.col(f"_rows.{k}").eqNullSafe(F.col(f"_other.{k}")) for k in keys])
    return rows.alias("_rows").join(other, same, how)


@dataclass(frozen=True)
class DeltaLog:
    """keys: NULL is a key like any other. order: which of a key's rows counts, the newest batch where it is
    empty or does not decide. partition: of the base, for readers that pass a condition on it."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    order: Sequence[Column] = ()
    partition: Sequence[str] = ()

    def _committed(self, kind: str, column: str) -> list[int]:
        return committed(self.spark, f"{self.path}/{kind}", column)

    def bases(self) -> list[int]:
        return self._committed("base", "_upto")

    def batches(self) -> list[int]:
        """Batches that are not in the newest base."""
        upto = (self.bases() or [-1])[-1]
        return [n for n in self._committed("log", "_batch") if n > upto]

    def has(self, batch: int) -> bool:
        """True once the batch is committed, in the log or in a base."""
        return batch <= (self.bases() or [-1])[-1] or batch in self.batches()

    def _folder(self, kind: str, n: int) -> str:
        return f"{self.path}/base/_upto={n}" if kind == "base" else f"{self.path}/log/_batch={n}"

    def write(self, rows: DataFrame, batch: int) -> bool:
        """Writes a batch: the first row of every key. False for one that a base has taken in already.

        Only the last batch can be repeated, as later ones may have been derived from it."""
        if batch <= (self.bases() or [-1])[-1]:
            return False
        if any(n > batch for n in self.batches()):
            raise ValueError(f"batch {batch} of {self.path} comes after a later one")
        names = self.schema.names
        first = latest_per_key(rows.select(*names), self.keys, self.order or [F.lit(1)])
        first.write.mode("overwrite").parquet(self._folder("log", batch))  # dealt by key: even
        return True

    def _log(self, numbers: list[int]) -> DataFrame:
        """Rows of batches with their number, _batch."""
        if not numbers:
            return self.spark.createDataFrame([], self.schema).withColumn("_batch", F.lit(0).cast("long"))
        reader = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_batch", T.LongType())]))
        return reader.option("basePath", f"{self.path}/log").parquet(*[self._folder("log", n) for n in numbers])

    def read(self, before: int | None = None, where: Column | None = None) -> DataFrame:
        """The table, or what it was before a batch; where: a condition on key or partition columns,
        which base and log are cut by before they meet."""
        bases = [n for n in self.bases() if before is None or n < before]
        numbers = [n for n in self._committed("log", "_batch") if n > (bases or [-1])[-1] and (before is None or n < before)]
        if before is not None and not bases and self.bases():
            raise ValueError(f"{self.path} was folded after batch {before}")
        log = self._log(numbers)
        base = self.spark.read.schema(self.schema).parquet(self._folder("base", bases[-1])) if bases else None
        if where is not None:
            log, base = log.where(where), base.where(where) if base is not None else None
        # One batch holds each key once.
        newest = latest_per_key(log, self.keys, [*self.order, F.desc("_batch")]) if len(numbers) > 1 else log
        names = self.schema.names
        if base is None:
            return newest.select(*names)
        if not numbers:
            return base.select(*names)
        if self.order:  # a batch may hold a row that is older than the base's
            held = matching(base, newest, self.keys, "left_semi").withColumn("_batch", F.lit(-1).cast("long"))
            newest = latest_per_key(newest.unionByName(held), self.keys, [*self.order, F.desc("_batch")])
        return matching(base, log, self.keys, "left_anti").select(*names).unionByName(newest.select(*names))

    def after(self, known: DataFrame, batch: int) -> DataFrame:
        """What a written batch makes of rows that were there before it, which hold all that were of its keys."""
        both = known.select(*self.schema.names).withColumn("_batch", F.lit(-1).cast("long")).unionByName(self._log([batch]))
        return latest_per_key(both, self.keys, [*self.order, F.desc("_batch")]).drop("_batch")

    def _matching(self, rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
        return matching(rows, other, self.keys, how)

    def fold(self) -> bool:
        """Writes the table as a new base; False if the log is empty. Repeating a fold that died is safe."""
        numbers, bases = self.batches(), self.bases()
        if not numbers:
            return False
        writer = _balanced(self.read(), self.partition).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "static").partitionBy(*self.partition).parquet(self._folder("base", numbers[-1]))
        kept = (bases or [-1])[-1]  # readers may still be on this one
        for n in bases[:-1]:
            _delete(self.spark, self._folder("base", n))
        for n in self._committed("log", "_batch"):
            if n <= kept:
                _delete(self.spark, self._folder("log", n))
        return True

    def _bytes(self, kind: str, numbers: Sequence[int]) -> int:
        fs, _ = _filesystem(self.spark, self.path)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return sum(fs.getContentSummary(path(self._folder(kind, n))).getLength() for n in numbers)

    def fold_if_large(self, most_batches: int = MOST_BATCHES, most_share: float = MOST_SHARE) -> bool:
        numbers = self.batches()
        large = len(numbers) >= most_batches or (
            numbers and self._bytes("log", numbers) > most_share * self._bytes("base", self.bases()[-1:]))
        return bool(large) and self.fold()
