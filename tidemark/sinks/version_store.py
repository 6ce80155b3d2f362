"""A table's versions: a change log, a folder per version, and full states at every so many versions.

Reading a version takes the newest state up to it and the changes after that state: at most
`every` folders of the log however many versions there are. Only rows whose key those changes
hold are shuffled. Folders count once Spark has committed them, so a commit that dies leaves
the table as it was; its version can be written again. A state that died is written by the next
commit. One writer per table; versions are numbered upwards, numbers may be left out.

Layout: log/_version=N holds the changes of version N (op: 'U' or 'D'), state/_upto=N the
table after it. States repeat what the log says: they can be deleted at any time, except for
versions that reads should be quick for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import diff_versions
from tidemark.operators.keyed import latest_per_key
from tidemark.sinks.delta_log import committed, matching
from tidemark.sinks.tables import _balanced, _delete


@dataclass(frozen=True)
class VersionStore:
    """schema: of the table's rows, keys included. every: versions from one full state to the next."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    every: int = 10

    def versions(self) -> list[int]:
        return committed(self.spark, f"{self.path}/log", "_version")

    def states(self) -> list[int]:
        return committed(self.spark, f"{self.path}/state", "_upto")

    def commit(self, changes: DataFrame, version: int) -> None:
        """Writes a version: changes hold a row per key (repeated keys are an error) and op.

        The last version may be written again, and is then replaced as a whole."""
        known = self.versions()
        if any(n > version for n in known):
            raise ValueError(f"version {version} of {self.path} comes after a later one")
        if version in self.states():
            _delete(self.spark, f"{self.path}/state/_upto={version}")
        names = [*self.schema.names, "op"]
        counted = changes.select(*names, F.count(F.lit(1)).over(Window.partitionBy(*self.keys)).alias("_n"))
        once = F.when(F.col("_n") > 1, F.raise_error(F.lit("two changes of one key")).cast("string")).otherwise(F.col("op"))
        _balanced(counted.select(*self.schema.names, once.alias("op")), ()).write.mode("overwrite").parquet(
            f"{self.path}/log/_version={version}")
        since = [n for n in known if n > (self.states() or [-1])[-1] and n < version]
        if len(since) + 1 >= self.every:
            _balanced(self.read(version), ()).write.mode("overwrite").parquet(f"{self.path}/state/_upto={version}")

    def changes(self, after: int, upto: int) -> DataFrame:
        """Rows of the log with version and op, of the versions after one and up to another."""
        fields = [*self.schema.fields, T.StructField("op", T.StringType()), T.StructField("_version", T.LongType())]
        folders = [f"{self.path}/log/_version={n}" for n in self.versions() if after < n <= upto]
        if not folders:
            return self.spark.createDataFrame([], T.StructType(fields)).withColumnRenamed("_version", "version")
        reader = self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.path}/log")
        return reader.parquet(*folders).withColumnRenamed("_version", "version")

    def read(self, version: int) -> DataFrame:
        """The table after a version, or after the last one before that number, with the version that
        wrote each row."""
        state = max((n for n in self.states() if n <= version), default=None)
        changes = self.changes(-1 if state is None else state, version)
        newest = latest_per_key(changes, self.keys, [F.desc("version")]).where("op <> 'D'").drop("op")
        if state is None:
            return newest
        fields = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        full = self.spark.read.schema(fields).parquet(f"{self.path}/state/_upto={state}")
        return matching(full, changes, self.keys, "left_anti").unionByName(newest)

    def rollback(self, to_version: int, new_version: int) -> None:
        """Commits a version that restores an older one; only keys touched since are written."""
        touched = self.changes(to_version, new_version - 1).select(*self.schema.names).dropDuplicates(list(self.keys))
        old = self.read(to_version)
        back = matching(old, touched, self.keys, "left_semi").select(*self.schema.names, F.lit("U").alias("op"))
        gone = matching(touched, old, self.keys, "left_anti").withColumn("op", F.lit("D"))
        self.commit(back.unionByName(gone), new_version)

    def diff(self, older: int, newer: int, compare: Sequence[str]) -> DataFrame:
        """Keys that were added, removed or changed (in compare) from one version to another.

        Only keys that the log names between the two take part. NULL keys are left out."""
        touched = self.changes(older, newer).select(*self.keys).dropna().distinct()
        sides = [matching(self.read(n), touched, self.keys, "left_semi") for n in (older, newer)]
        return diff_versions(*sides, self.keys, compare).where("change <> 'shared'")
