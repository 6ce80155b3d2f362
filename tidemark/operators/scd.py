"""Type 2 dimensions: daily step, one-shot rebuild, point-in-time join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import as_timestamp, known_or_unknown, record_hash, surrogate_key

OPEN_END = "9999-12-31 00:00:00"
META = ("_record_hash", "_effective_from", "_effective_to", "_is_current")


def open_versions(
    src: DataFrame, key: str, tracked: Sequence[str], effective: dt.date | str | Column, sk: str
) -> DataFrame:
    """Every source row as a version that starts at `effective` and is still open."""
    start = as_timestamp(effective)
    return src.select(
        surrogate_key(key, start).alias(sk),
        *src.columns,
        record_hash(tracked).alias("_record_hash"),
        start.alias("_effective_from"),
        F.lit(OPEN_END).cast("timestamp").alias("_effective_to"),
        F.lit(True).alias("_is_current"),
    )


def scd2_apply(
    dim: DataFrame,
    src: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: dt.date | str,
    sk: str = "sk",
    close_missing: bool = False,
) -> DataFrame:
    """The dimension after one run with the source state of a day.

    A changed key closes its open version and opens a new one. A second change on
    the day a version was opened replaces that version, a run dated before the open
    version is ignored, and keys absent from the source are closed on request.
    """
    new = open_versions(src, key, tracked, effective, sk).select(*dim.columns)
    start = as_timestamp(effective)
    cur = dim.where("_is_current").select(F.struct(*dim.columns).alias("cur"), F.col(key).alias("_ck"))
    nxt = new.select(F.struct(*dim.columns).alias("nxt"), F.col(key).alias("_nk"))
    pair = cur.join(nxt, F.col("_ck").eqNullSafe(F.col("_nk")), "full")

    closed = F.col("cur").withField("_is_current", F.lit(False)).withField("_effective_to", start)
    is_new, is_gone = F.col("cur").isNull(), F.col("nxt").isNull()
    changed = F.col("cur._record_hash") != F.col("nxt._record_hash")
    later = start > F.col("cur._effective_from")
    same_start = start == F.col("cur._effective_from")
    gone = F.array(closed) if close_missing else F.array("cur")
    rows = (
        F.when(is_new, F.array("nxt"))
        .when(is_gone, F.when(later, gone).otherwise(F.array("cur")))
        .when(changed & later, F.array(closed, "nxt"))
        .when(changed & same_start, F.array("nxt"))
        .otherwise(F.array("cur"))
    )
    stepped = pair.select(F.inline(rows)).toDF(*dim.columns)
    return dim.where("NOT _is_current").unionByName(stepped)


def scd2_rebuild(
    states: DataFrame, key: str, tracked: Sequence[str], day: str, sk: str = "sk"
) -> DataFrame:
    """All versions from dated states, at most one state per key and day.

    Equal to folding scd2_apply over the days. The window of a key holds one row
    per day however many raw rows the key has, because states are already daily.
    """
    attrs = [c for c in states.columns if c != day]
    w = Window.partitionBy(key).orderBy(day)
    hashed = states.withColumn("_record_hash", record_hash(tracked))
    starts = hashed.withColumn("_previous", F.lag("_record_hash").over(w)).where(
        F.col("_previous").isNull() | (F.col("_previous") != F.col("_record_hash"))
    )
    start = F.col(day).cast("timestamp")
    until = F.lead(start).over(w)
    return starts.select(
        surrogate_key(key, start).alias(sk),
        *attrs,
        "_record_hash",
        start.alias("_effective_from"),
        F.coalesce(until, F.lit(OPEN_END).cast("timestamp")).alias("_effective_to"),
        until.isNull().alias("_is_current"),
    )


def scd2_splice(
    dim: DataFrame,
    states: DataFrame,
    src: DataFrame,
    key: str,
    tracked: Sequence[str],
    day: str,
    effective: dt.date | str,
    sk: str = "sk",
) -> DataFrame:
    """The dimension after the source states of a day that may lie inside its closed history.

    states: the dated states (day and src's columns, one per key and day) that dim was made of;
    those of the day itself are replaced by src. A late state opens a version where it differs
    from the state before it, and the state after it opens one where that differs from the late
    one; versions of the key that touch the time between are cut or taken out, all others
    stay as they are. Days applied in any order, each once its states are known to the next, equal
    scd2_rebuild. A NULL key is a key; src has one row per key; versions of dim have no gaps.

    A key's group holds at most three versions and two new ones; its states meet in a partial
    aggregate of the nearest on either side.
    """
    start, on = as_timestamp(effective), F.lit(effective).cast("date")
    late = src.select(F.col(key).alias("_k"), F.struct(*src.columns).alias("_new"), record_hash(tracked).alias("_new_hash"))
    others = states.where(F.col(day) != on).withColumn("_hash", record_hash(tracked))
    others = others.join(late.select("_k"), F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    around = others.groupBy(F.col(key).alias("_ak")).agg(
        F.max_by("_hash", F.when(F.col(day) < on, F.col(day))).alias("_before"),
        F.min_by(F.struct(day, *src.columns), F.when(F.col(day) > on, F.col(day))).alias("_next"),
        F.min_by("_hash", F.when(F.col(day) > on, F.col(day))).alias("_next_hash"),
    )
    placed = late.join(around, F.col("_k").eqNullSafe(F.col("_ak")), "left")
    opens = placed.where("_before IS NULL OR _before <> _new_hash").select("_new.*")
    reopens = placed.where("_next_hash <> _new_hash").select("_next.*")
    new = open_versions(opens, key, tracked, effective, sk).select(*dim.columns).unionByName(
        open_versions(reopens, key, tracked, F.col(day).cast("timestamp"), sk).select(*dim.columns))

    until = F.coalesce(F.col(f"_next.{day}").cast("timestamp"), F.lit(OPEN_END).cast("timestamp"))
    spans = placed.select("_k", until.alias("_until"), F.lit(True).alias("_late"))
    pair = dim.join(spans, F.col(key).eqNullSafe(F.col("_k")), "left")
    touched = F.coalesce(F.col("_late") & (F.col("_effective_from") <= F.col("_until")) & (F.col("_effective_to") >= start), F.lit(False))
    pair = pair.withColumn("_touched", touched)
    pieces = pair.where("_touched").select(*dim.columns, (F.col("_effective_from") >= start).alias("_gone")).unionByName(
        new.withColumns({"_gone": F.lit(False), "_effective_to": F.lit(None).cast("timestamp")}))
    pieces = pieces.withColumn("_end", F.max("_effective_to").over(Window.partitionBy(key))).where("NOT _gone")
    following = F.lead("_effective_from").over(Window.partitionBy(key).orderBy("_effective_from"))
    pieces = pieces.withColumn("_effective_to", F.coalesce(following, "_end", F.lit(OPEN_END).cast("timestamp")))
    pieces = pieces.withColumn("_is_current", F.col("_effective_to") == F.lit(OPEN_END).cast("timestamp"))
    return pair.where("NOT _touched").select(*dim.columns).unionByName(pieces.select(*dim.columns))


def pit_join_direct(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    nk: str,
    sk: str = "sk",
    valid_from: str = "_effective_from",
    valid_to: str = "_effective_to",
) -> DataFrame:
    """Point-in-time key by one range join; good while a key has few versions.

    Facts without a key do not take part: they would all meet in one task.
    """
    versions = dim.select(
        F.col(nk).alias("_nk"),
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        F.col(sk).alias("_sk"),
    )
    hit = (F.col(key) == F.col("_nk")) & (F.col("_from") <= F.col(ts)) & (F.col(ts) < F.col("_to"))
    joined = fact.where(F.col(key).isNotNull()).join(versions, hit, "left")
    found = joined.withColumn(sk, known_or_unknown("_sk")).drop("_nk", "_from", "_to", "_sk")
    return found.unionByName(_without_key(fact, key, sk))


def _without_key(fact: DataFrame, key: str, sk: str) -> DataFrame:
    return fact.where(F.col(key).isNull()).withColumn(sk, known_or_unknown(F.lit(None).cast("string")))


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    nk: str,
    sk: str = "sk",
    slice_unit: str = "day",
    valid_from: str = "_effective_from",
    valid_to: str = "_effective_to",
) -> DataFrame:
    """Point-in-time key, joined on (key, time slice).

    A plain join on the key compares each fact with every version of its key and
    puts all facts of a key in one place. Here each used (key, slice) gets the one
    version carried into it and the versions opened in it, so facts of a heavy key
    spread over its slices and meet only the versions of their own slice. The only
    per-key window runs over slices, never over facts. Facts keep their row count:
    versions of a key must not overlap.
    """
    version = F.struct(
        F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), F.col(sk).alias("_sk")
    )
    versions = dim.where(F.col(nk).isNotNull()).select(
        F.col(nk).alias("_k"), F.date_trunc(slice_unit, F.col(valid_from)).alias("_slice"), version.alias("_v")
    )
    slots = (
        fact.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .select(F.col(key).alias("_k"), F.date_trunc(slice_unit, F.col(ts)).alias("_slice"))
        .distinct()
    )
    # Last version opened per slice (partial aggregation first), then carried forward.
    last_opened = versions.groupBy("_k", "_slice").agg(F.max("_v").alias("_v"))
    timeline = slots.withColumn("_used", F.lit(True)).unionByName(last_opened, allowMissingColumns=True)
    carried = (
        timeline.withColumn("_order", F.unix_micros("_slice"))
        .withColumn(
            "_v",
            F.last("_v", ignorenulls=True).over(
                Window.partitionBy("_k").orderBy("_order").rangeBetween(Window.unboundedPreceding, -1)
            ),
        )
        .where(F.col("_used") & (F.col("_v._to") > F.col("_slice")))
        .select("_k", "_slice", "_v")
    )
    candidates = carried.unionByName(versions)
    hit = (
        (F.col(key) == F.col("_k"))
        & (F.date_trunc(slice_unit, F.col(ts)) == F.col("_slice"))
        & (F.col("_v._from") <= F.col(ts))
        & (F.col(ts) < F.col("_v._to"))
    )
    joined = fact.where(F.col(key).isNotNull()).join(candidates, hit, "left")
    found = joined.withColumn(sk, known_or_unknown("_v._sk")).drop("_k", "_slice", "_v")
    return found.unionByName(_without_key(fact, key, sk))
