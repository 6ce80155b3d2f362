"""Lifetime states of entities, kept up by signed changes instead of recomputed.

A unit is a row that counts towards one entity: a payment, a ride. A run knows the units that
it touches before and after; their difference by entity and day is added to the states.
Counts and sums are subtracted as they are added. First and last day and the number of
active days cannot be, so a state holds its active days as a bitmap, a mask of days for each
month, and a table of units per entity and day tells when a day begins or ceases to be active.

Both tables are delta logs: a run writes the states it changes and nothing else, reads what was
there before it, and so can be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import written_once
from tidemark.sinks.delta_log import DeltaLog


@dataclass(frozen=True)
class Lifetime:
    """entity, day: columns of a unit; without a day no days are kept. sums: name -> (SQL of a
    unit's value, type of the sum); an unknown value adds nothing."""

    entity: str
    entity_type: str
    day: str | None = None
    sums: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def measures(self) -> list[str]:
        return ["n", *self.sums]

    def types(self) -> dict[str, str]:
        return {"n": "bigint"} | {name: kind for name, (_, kind) in self.sums.items()}

    def _ddl(self, *columns: str) -> T.StructType:
        return T.StructType.fromDDL(", ".join([f"entity {self.entity_type}", *columns, *(f"{c} {t}" for c, t in self.types().items())]))

    def days_log(self, spark: SparkSession, path: str) -> DeltaLog:
        """n and sums of each entity and day; a day without units stays with n = 0 until it is folded."""
        return DeltaLog(spark, path, self._ddl("day date", "month int"), ["entity", "day"], partition=["month"])

    def states_log(self, spark: SparkSession, path: str) -> DeltaLog:
        return DeltaLog(spark, path, self._ddl("days array<struct<month:int,mask:bigint>>"), ["entity"])


def contributions(units: DataFrame, spec: Lifetime, sign: int) -> DataFrame:
    day = F.to_date(spec.day) if spec.day else F.lit(None).cast("date")
    one = F.lit(sign).cast("bigint").alias("n")
    sums = [F.coalesce(F.expr(f"({sql}) * {sign}").cast(kind), F.lit(0).cast(kind)).alias(c) for c, (sql, kind) in spec.sums.items()]
    return units.select(F.col(spec.entity).cast(spec.entity_type).alias("entity"), day.alias("day"), one, *sums)


def _total(rows: DataFrame, by: list[str], spec: Lifetime) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in spec.types().items()])


def changes(before: DataFrame, after: DataFrame, spec: Lifetime) -> DataFrame:
    """entity, day and the difference of every measure, where there is one."""
    total = _total(contributions(after, spec, 1).unionByName(contributions(before, spec, -1)), ["entity", "day"], spec)
    return total.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in spec.measures]))


def _month(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day) - 1).cast("int")


def active_days(days: str = "days") -> dict[str, Column]:
    """first_day, last_day and active_days of a state's bitmap."""
    low = "int(log2(m.mask & -m.mask))"
    high = "length(conv(m.mask, 10, 2)) - 1"
    date = "date_add(make_date(m.month div 12, m.month % 12 + 1, 1), {})"
    return {
        "first_day": F.expr(f"array_min(transform({days}, m -> {date.format(low)}))"),
        "last_day": F.expr(f"array_max(transform({days}, m -> {date.format(high)}))"),
        "active_days": F.expr(f"aggregate({days}, 0L, (n, m) -> n + bit_count(m.mask))"),
    }


def advance(spec: Lifetime, before: DataFrame, after: DataFrame, states: DeltaLog, days: DeltaLog | None, batch: int) -> None:
    """One run: the units it touches, as they were and as they are. Repeating the last run changes nothing."""
    change = written_once(changes(before, after, spec), "lifetime-changes")
    marks = None
    if spec.day:
        marks = _advance_days(spec, change, days, batch)
    delta = _total(change, ["entity"], spec)
    touched = delta.select("entity") if marks is None else delta.select("entity").union(marks.select("entity")).distinct()
    old = states._matching(states.read(before=batch), touched, "left_semi")
    measures = _total(old.select("entity", *spec.measures).unionByName(delta), ["entity"], spec)
    masks = old.select("entity", F.inline("days")).select("entity", "month", F.col("mask").alias("was"), F.lit(0).cast("bigint").alias("on"),
                                                          F.lit(0).cast("bigint").alias("off"))
    if marks is not None:
        masks = masks.unionByName(marks.select("entity", "month", F.lit(0).cast("bigint").alias("was"), "on", "off"))
    merged = masks.groupBy("entity", "month").agg(F.expr("(bit_or(was) & ~bit_or(off)) | bit_or(on)").alias("mask")).where("mask <> 0")
    bitmap = merged.groupBy("entity").agg(F.sort_array(F.collect_list(F.struct("month", "mask"))).alias("days"))
    empty = F.array().cast("array<struct<month:int,mask:bigint>>")
    joined = measures.alias("m").join(bitmap.alias("b"), F.col("m.entity").eqNullSafe(F.col("b.entity")), "left")
    states.write(joined.select("m.*", F.coalesce("b.days", empty).alias("days")), batch)


def _advance_days(spec: Lifetime, change: DataFrame, days: DeltaLog, batch: int) -> DataFrame:
    """Writes the days that change; entity, month, on, off: masks of days that became or ceased to be active."""
    change = change.withColumn("month", _month(F.col("day")))
    # A run's months: a list as short as the calendar, which cuts the base to their partitions.
    months = [r[0] for r in change.select("month").distinct().collect()]
    known = [m for m in months if m is not None]
    where = F.col("month").isin(known) if known else F.lit(False)
    old = days._matching(days.read(before=batch, where=where | F.col("month").isNull() if None in months else where), change, "left_semi")
    both = old.withColumn("was", F.col("n")).unionByName(change.withColumn("was", F.lit(0).cast("bigint")))
    sums = [F.sum(c).cast(kind).alias(c) for c, kind in spec.types().items()]
    now = written_once(both.groupBy("entity", "day", "month").agg(*sums, F.sum("was").alias("was")), "lifetime-days")
    days.write(now.drop("was"), batch)
    bit = F.expr("shiftleft(1L, dayofmonth(day) - 1)")
    zero = F.lit(0).cast("bigint")
    return now.where("day IS NOT NULL AND (n > 0) <> (was > 0)").groupBy("entity", "month").agg(
        F.bit_or(F.when(F.col("n") > 0, bit).otherwise(zero)).alias("on"), F.bit_or(F.when(F.col("n") <= 0, bit).otherwise(zero)).alias("off"))


def current(states: DeltaLog, spec: Lifetime) -> DataFrame:
    """The entity, n, sums, first_day, last_day and active_days of every entity that has units."""
    rows = states.read().where("n > 0").select(F.col("entity").alias(spec.entity), *spec.measures, "days")
    return rows.withColumns(active_days()).drop("days")
