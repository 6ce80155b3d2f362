"""Schema evolution applied on read: old files through the newest schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class AddColumn:
    name: str
    type: str


@dataclass(frozen=True)
class RenameColumn:
    old: str
    new: str


@dataclass(frozen=True)
class WidenColumn:
    name: str
    type: str


@dataclass(frozen=True)
class ReorderColumns:
    order: tuple[str, ...]


@dataclass(frozen=True)
class DropColumn:
    name: str


Step = AddColumn | RenameColumn | WidenColumn | ReorderColumns | DropColumn


def is_widening(old: T.DataType, new: T.DataType) -> bool:
    """int to long, float to double, or a decimal with more integer digits and equal scale."""
    if isinstance(old, T.IntegerType):
        return isinstance(new, T.LongType)
    if isinstance(old, T.FloatType):
        return isinstance(new, T.DoubleType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old.scale == new.scale and old.precision <= new.precision
    return False


def _apply(df: DataFrame, step: Step) -> DataFrame:
    match step:
        case AddColumn(name, type_):
            return df.withColumn(name, F.lit(None).cast(type_))
        case RenameColumn(old, new):
            return df.withColumnRenamed(old, new)
        case WidenColumn(name, type_):
            widened = df.withColumn(name, F.col(name).cast(type_))
            old, new = df.schema[name].dataType, widened.schema[name].dataType
            if old != new and not is_widening(old, new):
                raise ValueError(f"{name}: {old.simpleString()} to {new.simpleString()} is not a widening")
            return widened
        case ReorderColumns(order):
            return df.select(*order, *[c for c in df.columns if c not in order])
        case DropColumn(name):
            return df.drop(name)


def conform(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Read data written before the given steps through the schema after them."""
    return reduce(_apply, steps, df)


def read_generations(generations: Sequence[tuple[DataFrame, int]], steps: Sequence[Step]) -> DataFrame:
    """Union of data generations; each was written after the first `n` steps."""
    frames = [conform(df, steps[n:]) for df, n in generations]
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_layouts(layouts: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """One table from parts laid out by different partition columns; missing columns read NULL."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layouts)
    return union.select(*columns)
