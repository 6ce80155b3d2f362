"""Given tables and domain views as DataFrames."""

from __future__ import annotations

import datetime as dt
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import configure
from tidemark.sources.lake import read_table
from workload.views import VIEWS

RUN_TS = dt.datetime(2024, 2, 1)


def names_in(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(text) if name})


class Frames:
    """Lazy access to the tables of one folder: frames.orders, frames.pay_payments."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in VIEWS:
                inputs = {n: getattr(self, n) for n in names_in(VIEWS[name])}
                self._known[name] = self.spark.sql(VIEWS[name], **inputs)
            else:
                self._known[name] = read_table(self.spark, f"{self.folder}/{name}.parquet")
        return self._known[name]


def present(df: DataFrame, doubles: frozenset[str] = frozenset()) -> DataFrame:
    """Plain output types: dates and times as text, exact and float numbers as rounded
    doubles, integers and flags as bigint, or double where named (columns with NULLs)."""
    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if f.name in doubles:
            return F.round(c.cast("double"), 6).alias(f.name)
        match f.dataType:
            case T.DateType():
                c = F.date_format(c, "yyyy-MM-dd")
            case T.TimestampType() | T.TimestampNTZType():
                c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            case T.DecimalType() | T.DoubleType() | T.FloatType():
                c = F.round(c.cast("double"), 6)
            case T.IntegerType() | T.ShortType() | T.ByteType() | T.LongType():
                c = c.cast("bigint")
            case T.BooleanType():
                c = c.cast("int").cast("bigint")
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema])
