"""Jobs end to end: rows landed in bronze, cleaned, and summed up, through the table contracts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.operators import history
from tidemark.operators.keyed import latest_per_key
from tidemark.session import shared_folder
from tidemark.sinks import layout
from tidemark.specs import spec
from workload.frames import RUN_TS, Frames
from workload.queries.payments import FEES, PAYMENTS, REFUNDS
from workload.queries.tables import LOG, _many_files, commits_of, log_of
from workload.registry import query

DAYS = (dt.date(2024, 1, 10), dt.date(2024, 1, 11))


def _run(f: Frames, root: str, day: dt.date) -> jobs.Run:
    return jobs.Run(f.spark, root, day, RUN_TS, f"run-{day}")


def _land(run: jobs.Run, domain: str, table: str, rows) -> int:
    return jobs.land_rows(run, table, domain, rows.select(*spec(domain, "bronze", table).source_columns))


@query(
    """session_id user_id created_at:t auth_method logical_date:d ingest_ts:t source _source_system _ingest_run_id landed:i""",
    """SELECT session_id, user_id, created_at, auth_method, DATE '2024-01-10' AS logical_date, TIMESTAMP '2024-02-01' AS ingest_ts,
        'postgres.auth' AS source, 'postgres.auth' AS _source_system, 'run-2024-01-10' AS _ingest_run_id,
        (SELECT COUNT(*) FROM {auth_sessions}) AS landed FROM {auth_sessions}""",
)
def land_sessions(f: Frames):
    """Source rows with their housekeeping columns, aligned to the contract and counted."""
    run = _run(f, shared_folder(f.spark, "lake"), DAYS[0])
    landed = _land(run, "auth", "sessions_raw", f.auth_sessions)
    return run.read("auth", "bronze", "sessions_raw").withColumn("landed", F.lit(landed))


#: The view that stands for the source of each contract.
SOURCES = {
    "payments": {"merchants": "pay_merchants", "customers": "pay_customers", "methods": "pay_methods", "payments": "pay_payments",
                 "refunds": "pay_refunds", "fees": "pay_fees", "settlements": "pay_settlements"},
    "rideon": {"cities": "ride_cities", "vehicle_categories": "ride_categories", "riders": "ride_riders", "drivers": "ride_drivers",
               "vehicles": "ride_vehicles", "rides": "ride_rides", "fares": "ride_fares", "ride_payments": "ride_payments",
               "ratings": "ride_ratings", "driver_payouts": "ride_payouts"},
    "auth": {"users": "auth_users", "credentials": "auth_credentials", "user_profiles": "auth_profiles", "roles": "auth_roles",
             "permissions": "auth_permissions", "role_permissions": "auth_role_permissions", "user_roles": "auth_user_roles",
             "sessions": "auth_sessions", "login_attempts": "auth_attempts", "oauth_accounts": "auth_oauth", "mfa_devices": "auth_devices",
             "password_reset_tokens": "auth_tokens", "audit_log": "auth_audit"},
}
LANDED = "table_name rows:i keys:i key_chars:i day:d source payloads:i"


def _bronze_name(domain: str, table: str) -> str:
    return f"{table}_raw" if domain == "auth" else f"{domain}_{table}_raw"


def _landed_sql(domain: str) -> str:
    def one(table: str, view: str) -> str:
        contract = spec(domain, "bronze", _bronze_name(domain, table))
        key = " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in contract.keys)
        return (f"SELECT '{contract.name}' AS table_name, COUNT(*) AS rows, COUNT(DISTINCT {key}) AS keys, SUM(LENGTH({key})) AS key_chars, "
                f"DATE '{DAYS[0]}' AS day, '{contract.source_name}' AS source, COUNT(*) AS payloads FROM {{{view}}}")

    return " UNION ALL ".join(one(*x) for x in SOURCES[domain].items())


def _land_all(f: Frames, domain: str):
    """Every contract of a domain lands twice under one run id, and is there once."""
    run, found = _run(f, shared_folder(f.spark, "lake"), DAYS[0]), []
    for table, view in SOURCES[domain].items():
        contract = spec(domain, "bronze", _bronze_name(domain, table))
        for _ in range(2):
            _land(run, domain, contract.name, getattr(f, view))
        key = F.concat_ws("/", *contract.keys)
        there = run.read(domain, "bronze", contract.name)
        # A text's maximum beside the others would have every row sorted; distinct ones are few.
        source = there.select("source").distinct().agg(F.max("source"))
        found.append(there.agg(
            F.lit(contract.name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"),
            F.sum(F.length(key)).alias("key_chars"), F.max("logical_date").alias("day"),
            F.count("raw_payload").alias("payloads")).withColumn("source", source.scalar()))
    return reduce(DataFrame.unionByName, found)


@query(LANDED, _landed_sql("payments"))
def land_payments(f: Frames):
    return _land_all(f, "payments")


@query(LANDED, _landed_sql("rideon"))
def land_rides(f: Frames):
    return _land_all(f, "rideon")


@query(LANDED, _landed_sql("auth"))
def land_identity(f: Frames):
    return _land_all(f, "auth")


@query(
    "session_id user_id auth_method day:d user_sk",
    """SELECT session_id, user_id, upper(trim(auth_method)) AS auth_method, CASE WHEN CAST(right(session_id, 1) AS INT) % 2 = 0
        THEN DATE '2024-01-11' ELSE DATE '2024-01-10' END AS day, '-1' AS user_sk FROM {auth_sessions}""",
)
def sessions_of_two_days(f: Frames):
    """All sessions land on one day, half of them again on the next; facts come before the user dimension."""
    root = shared_folder(f.spark, "lake")
    even = f.auth_sessions.where(F.substring("session_id", -1, 1).cast("int") % 2 == 0)
    for day, rows in zip(DAYS, (f.auth_sessions, even)):
        run = _run(f, root, day)
        _land(run, "auth", "sessions_raw", rows)
        jobs.run_job(run, "auth", "silver", "sessions")
        jobs.run_job(run, "auth", "gold", "fact_sessions")
    silver = run.read("auth", "silver", "sessions").withColumnRenamed("_source_logical_date", "day")
    facts = run.read("auth", "gold", "fact_sessions").select("session_id", "user_sk")
    return silver.join(facts, "session_id")


def _side_by_side(spark: SparkSession, jobs_: list[Callable[[], None]]) -> None:
    """Runs jobs that do not need each other at once: cores that one leaves idle, as in a stage's last
    tasks or while files are made, serve the others. The first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(jobs_)) as pool:
        # Each is wrapped by itself: threads may not share local properties, which hold Spark's execution ids.
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs_]:
            done.result()


@query(
    "day:d total_payments:i total_volume:n refund_volume:n fee_volume:n",
    f"""WITH d AS (SELECT MAX(CAST(created_at AS DATE)) AS day FROM {{pay_payments}})
        SELECT d.day, COUNT(*) AS total_payments, SUM(p.amount) AS total_volume,
            (SELECT COALESCE(SUM(amount), 0) FROM {REFUNDS} r, d WHERE CAST(r.created_at AS DATE) = d.day) AS refund_volume,
            (SELECT COALESCE(SUM(amount), 0) FROM {FEES} r, d WHERE CAST(r.created_at AS DATE) = d.day) AS fee_volume
        FROM {PAYMENTS} p, d WHERE CAST(p.created_at AS DATE) = d.day GROUP BY 1""",
)
def payments_bronze_to_gold(f: Frames):
    """Landing, silver and the mart of the last day."""
    root, landed = shared_folder(f.spark, "lake"), DAYS[0]
    run = _run(f, root, landed)

    def to_silver(table: str) -> Callable[[], None]:
        # As the source delivers it: the newest state of a row in one extract.
        newest = [F.desc("ingest_ts"), *([F.desc("reason")] if table == "refunds" else [])]
        rows = latest_per_key(getattr(f, f"pay_{table}"), spec("payments", "bronze", f"payments_{table}_raw").keys, newest)

        def job() -> None:
            _land(run, "payments", f"payments_{table}_raw", rows)
            jobs.run_job(run, "payments", "silver", f"fact_{table}")

        return job

    _side_by_side(f.spark, [to_silver(t) for t in ("payments", "refunds", "fees")])
    last = run.read("payments", "silver", "fact_payments").agg(F.max("payment_date")).first()[0]
    mart = _run(f, root, last)
    jobs.run_job(mart, "payments", "gold", "daily_payment_summary")
    return mart.read("payments", "gold", "daily_payment_summary")


@query(
    "files:i rows:i partitions:i",
    """SELECT 12 * COUNT(DISTINCT l_returnflag) AS files, COUNT(*) AS rows, COUNT(DISTINCT l_returnflag) AS partitions
        FROM {lineitem}""",
)
def table_footprint(f: Frames):
    path = _many_files(f, "lineitem")
    parts = history.partition_metrics(layout.list_files(f.spark, path))
    counted = parts.agg(F.count(F.lit(1)).alias("partitions"))
    return layout.footprint(layout.file_summary(f.spark, path)).withColumn("partitions", counted.scalar())


@query(
    "version:i committed_at:t parent:n upserted:i deleted:i",
    f"""SELECT version, MAX(o_orderdate) AS committed_at, CASE WHEN version > MIN(version) OVER () THEN version - 1 END AS parent,
        (SELECT COUNT(*) FROM {LOG} l WHERE l.version = c.version AND op = 'U') AS upserted,
        (SELECT COUNT(*) FROM {LOG} l WHERE l.version = c.version AND op = 'D') AS deleted
        FROM (SELECT year(o_orderdate) - 1994 AS version, o_orderdate FROM {{orders}}) c GROUP BY version""",
)
def snapshots(f: Frames):
    return history.snapshots(log_of(f), commits_of(f))
