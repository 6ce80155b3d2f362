"""Streams over the landed events file; each runs to the end of its input."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.session import shared_folder
from tidemark.sinks.delta_log import DeltaLog
from tidemark.sources import lake
from tidemark.streaming import streams
from workload.frames import Frames
from workload.registry import query


def _events(f: Frames):
    return streams.file_stream(f.spark, f.folder, f.events.schema, glob="events.parquet")


def _finish(running) -> None:
    running.awaitTermination()


@query(
    "day:d event_type n:i total:n",
    """SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n, SUM(CAST(value AS DECIMAL(14,2))) AS total FROM {events}
        WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM {events})
        GROUP BY 1, 2""",
)
def stream_daily(f: Frames):
    """Tumbling days; days the watermark has not passed stay open and are not emitted."""
    out, state = shared_folder(f.spark, "daily"), shared_folder(f.spark, "state")
    amount = F.sum(F.col("value").cast("decimal(14,2)")).alias("total")
    counts = streams.windowed_counts(
        _events(f), "ts", "10 minutes", "1 day", ["event_type"], [F.count(F.lit(1)).alias("n"), amount]
    )
    flat = counts.select(F.to_date("window.start").alias("day"), "event_type", "n", "total")
    _finish(streams.append_stream(flat, out, state))
    return lake.read_table(f.spark, out)


@query("event_id:i ts:t user_id:i value:n", "SELECT * FROM {events}")
def stream_dedupe(f: Frames):
    """Every event arrives twice and is kept once."""
    out, state = shared_folder(f.spark, "events"), shared_folder(f.spark, "state")
    twice = _events(f).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    _finish(streams.append_stream(streams.dedupe_stream(twice, ["event_id"], "ts", "1 hour"), out, state))
    return lake.read_table(f.spark, out)


@query(
    "user_id:i event_id:i ts:t event_type value:n",
    "SELECT * FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def stream_upsert(f: Frames):
    out, state = shared_folder(f.spark, "users"), shared_folder(f.spark, "state")
    newest = [F.desc("ts"), F.desc("event_id")]
    _finish(streams.upsert_stream(_events(f), out, state, ["user_id"], newest))
    return lake.read_table(f.spark, out)


@query(
    "user_id:i event_id:i ts:t event_type value:n",
    "SELECT * FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def stream_merge_on_read(f: Frames):
    """Events land in eight files in no order of time and come in batches of one; the log is folded after three."""
    spark, landed = f.spark, shared_folder(f.spark, "landing")
    f.events.repartition(8, "event_id").write.parquet(landed)
    users = DeltaLog(spark, shared_folder(spark, "users"), f.events.schema, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    stream = streams.file_stream(spark, landed, f.events.schema, files_per_batch=1)
    _finish(streams.log_stream(stream, users, shared_folder(spark, "state"), most_batches=3, most_share=10))
    last = users.read().where(F.col("user_id") % 2 == 0)
    users.write(last, max([*users.batches(), *users.bases()]) + 1)
    return users.read()


@query("event_type total_rows:i", "SELECT event_type, COUNT(*) AS total_rows FROM {events} GROUP BY 1")
def stream_land(f: Frames):
    out, state = shared_folder(f.spark, "landed"), shared_folder(f.spark, "state")
    _finish(streams.land_stream(_events(f), out, state, ["event_type"]))
    return lake.read_table(f.spark, out).groupBy("event_type").agg(F.count(F.lit(1)).alias("total_rows"))
