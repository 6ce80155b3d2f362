"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, shared_folder

#: Characters that end a word: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \t-\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module: str) -> None:
    """Send the module's functions to executors whole: they need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


#: Rows that Python functions are given at a time; texts can be long.
BATCH_ROWS = "1000"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_once(df: DataFrame, path: str, **options: str) -> None:
    """Writes df, and drops its shuffle files: nothing else will read them."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(CLEAN_UP, before)


def staged(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The frame written to a fresh folder that all executors share, and read back.

    Cuts the lineage: what follows survives lost executors without computing df again.
    """
    path = shared_folder(df.sparkSession, purpose)
    write_once(df, path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Maximal runs of characters outside SPACE; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """body(value) with value computed once; body is a higher-order function over its uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
