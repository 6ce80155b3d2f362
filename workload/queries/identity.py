"""Identity: silver cleaners, dimensions, SCD2 and point-in-time facts over events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import scd
from tidemark.operators.keyed import latest_per_key
from tidemark.plans import identity as plan
from tidemark.session import shared_folder, written_once
from tidemark.sinks.tables import scd2_table
from tidemark.sources.lake import read_table
from workload.frames import RUN_TS, Frames
from workload.registry import latest, query

LAST_DAY = "2024-01-30"

USERS = latest("auth_users", "user_id", "ingest_ts DESC, event_id DESC")
DAILY_USERS = latest("auth_users", "user_id, logical_date", "ingest_ts DESC, event_id DESC")
ATTEMPTS = latest("auth_attempts", "attempt_id", "ingest_ts DESC")
SESSIONS = latest("auth_sessions", "session_id", "ingest_ts DESC")


def sha(*columns: str) -> str:
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"sha256(concat_ws('||', {parts}))"


CLEAN = """user_id, lower(trim(username)) AS username, lower(trim(email)) AS email, email_verified,
    lower(trim(status)) AS status, display_name, upper(country) AS country, created_at, updated_at, last_login_at,
    lower(trim(status)) = 'locked' AS is_locked"""
CLEAN_ATTEMPTS = f"""(SELECT attempt_id, user_id, username_tried, attempted_at, success,
    lower(trim(failure_reason)) AS failure_reason, mfa_challenged, upper(trim(auth_method)) AS auth_method, ip_address,
    CASE WHEN success THEN 'success' WHEN failure_reason IS NULL THEN 'unknown' ELSE lower(trim(failure_reason)) END
    AS attempt_outcome, logical_date FROM {ATTEMPTS})"""
CLEAN_SESSIONS = f"""(SELECT session_id, user_id, created_at, expires_at, revoked_at,
    upper(trim(auth_method)) AS auth_method, ip_address, user_agent, revoked_at IS NULL AS is_active,
    revoked_at IS NOT NULL AS was_revoked, greatest(date_diff('second', date_trunc('second', created_at),
    date_trunc('second', COALESCE(revoked_at, expires_at))), 0) AS session_duration_seconds, logical_date
    FROM {SESSIONS})"""

# Daily user states, their versions, and the dimension as the tracked attributes give it.
TRACKED = ("username", "email", "status", "country", "display_name", "is_mfa_enabled", "primary_role")
STATES = f"""(SELECT logical_date AS day, {CLEAN.replace('user_id,', 'user_id AS user_nk,', 1)} FROM {DAILY_USERS})"""
VERSIONS = f"""(SELECT md5(concat_ws('|', user_nk, strftime(day, '%Y-%m-%d %H:%M:%S'))) AS user_sk, user_nk, username,
    status, CAST(day AS TIMESTAMP) AS effective_from, h, COALESCE(LEAD(CAST(day AS TIMESTAMP)) OVER k,
    TIMESTAMP '9999-12-31') AS effective_to, LEAD(day) OVER k IS NULL AS is_current
    FROM (SELECT *, LAG(h) OVER (PARTITION BY user_nk ORDER BY day) AS ph
        FROM (SELECT *, {sha('username', 'email', 'status', 'country', 'display_name')} AS h FROM {STATES}))
    WHERE ph IS NULL OR ph <> h WINDOW k AS (PARTITION BY user_nk ORDER BY day))"""
HISTORY_TRACKED = ("username", "email", "status", "country", "display_name")


def silver_of(f: Frames, view: str, table: str, tie=()):
    return plan.silver(getattr(f, view), table, LAST_DAY, RUN_TS, tie)


def daily_states(f: Frames):
    """One cleaned state per user and day."""
    newest = [F.desc("ingest_ts"), F.desc("event_id")]
    daily = latest_per_key(f.auth_users, ["user_id", "logical_date"], newest)
    cleaned = plan.clean(daily.withColumn("last_login_at", F.col("logical_date").cast("timestamp")), "users")
    return cleaned.select(
        F.to_date("last_login_at").alias("day"), F.col("user_id").alias("user_nk"), *HISTORY_TRACKED
    )


def versions(f: Frames):
    return scd.scd2_rebuild(daily_states(f), "user_nk", HISTORY_TRACKED, "day", "user_sk")


@query(
    """user_id username email email_verified:b status display_name country created_at:t updated_at:t last_login_at:t
    is_locked:b _record_hash _loaded_at:t _source_logical_date:d""",
    f"""SELECT *, {sha('username', 'email', 'status', 'country', 'display_name', 'email_verified')} AS _record_hash,
        TIMESTAMP '2024-02-01' AS _loaded_at, DATE '2024-01-30' AS _source_logical_date
        FROM (SELECT {CLEAN} FROM {USERS})""",
)
def clean_users(f: Frames):
    return silver_of(f, "auth_users", "users", ["event_id"])


@query(
    "role_id name description _record_hash",
    f"""SELECT *, {sha('name', 'description')} AS _record_hash
        FROM (SELECT role_id, lower(trim(name)) AS name, description FROM {{auth_roles}})""",
)
def clean_roles(f: Frames):
    return silver_of(f, "auth_roles", "roles")


@query(
    "permission_id code description _record_hash",
    f"""SELECT *, {sha('code', 'description')} AS _record_hash
        FROM (SELECT permission_id, lower(trim(code)) AS code, description FROM {{auth_permissions}})""",
)
def clean_permissions(f: Frames):
    return silver_of(f, "auth_permissions", "permissions")


@query(
    """session_id user_id created_at:t expires_at:t revoked_at:t auth_method ip_address user_agent is_active:b
    was_revoked:b session_duration_seconds:i _record_hash""",
    f"SELECT *, {sha('user_id', 'auth_method', 'is_active', 'was_revoked')} AS _record_hash FROM {CLEAN_SESSIONS}",
)
def clean_sessions(f: Frames):
    return silver_of(f, "auth_sessions", "sessions")


@query(
    """attempt_id:i user_id username_tried attempted_at:t success:b failure_reason mfa_challenged:b auth_method
    ip_address attempt_outcome _record_hash""",
    f"""SELECT *, {sha('user_id', 'success', 'failure_reason', 'auth_method', 'mfa_challenged')} AS _record_hash
        FROM {CLEAN_ATTEMPTS}""",
)
def login_outcome(f: Frames):
    return silver_of(f, "auth_attempts", "login_attempts")


@query(
    "oauth_account_id user_id provider provider_user_id linked_at:t _record_hash",
    f"""SELECT *, {sha('user_id', 'provider')} AS _record_hash FROM (SELECT oauth_account_id, user_id,
        lower(trim(provider)) AS provider, provider_user_id, linked_at FROM {{auth_oauth}})""",
)
def clean_oauth_accounts(f: Frames):
    return silver_of(f, "auth_oauth", "oauth_accounts")


@query(
    "mfa_device_id user_id device_type label confirmed:b created_at:t _record_hash",
    f"""SELECT *, {sha('user_id', 'device_type', 'confirmed')} AS _record_hash FROM (SELECT mfa_device_id, user_id,
        lower(trim(device_type)) AS device_type, label, confirmed, created_at FROM {{auth_devices}})""",
)
def clean_mfa_devices(f: Frames):
    return silver_of(f, "auth_devices", "mfa_devices")


@query(
    "role_id role_name description permission_count:i _record_hash",
    f"""SELECT *, {sha('role_name', 'description', 'permission_count')} AS _record_hash FROM (
        SELECT r.role_id, lower(trim(name)) AS role_name, description, COALESCE(n, 0) AS permission_count
        FROM {{auth_roles}} r LEFT JOIN (SELECT role_id, COUNT(DISTINCT permission_id) AS n
        FROM {{auth_role_permissions}} GROUP BY 1) p ON r.role_id = p.role_id)""",
)
def dim_role(f: Frames):
    return plan.dim_role(silver_of(f, "auth_roles", "roles"), f.auth_role_permissions, RUN_TS)


@query(
    "auth_method_sk method_code method_family",
    f"""SELECT md5(m) AS auth_method_sk, m AS method_code, CASE WHEN m = 'PASSWORD' THEN 'password'
        WHEN m IN ('OAUTH_GOOGLE', 'OAUTH_GITHUB', 'OAUTH_MICROSOFT') THEN 'oauth'
        WHEN m IN ('MFA_TOTP', 'MFA_SMS') THEN 'mfa' WHEN m = 'MAGIC_LINK' THEN 'passwordless' ELSE 'other' END
        AS method_family
        FROM (SELECT auth_method AS m FROM {CLEAN_SESSIONS} UNION SELECT auth_method FROM {CLEAN_ATTEMPTS})
        WHERE m IS NOT NULL""",
)
def dim_auth_method(f: Frames):
    sessions = silver_of(f, "auth_sessions", "sessions")
    return plan.dim_auth_method(sessions, silver_of(f, "auth_attempts", "login_attempts"), RUN_TS)


@query(
    """date_key:i full_date:d year:i quarter:i month:i day_of_month:i day_of_week:i week_of_year:i day_name month_name
    is_weekend:b""",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter,
        month(d) AS month, day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week, week(d) AS week_of_year,
        dayname(d) AS day_name, monthname(d) AS month_name, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', hi, INTERVAL 1 DAY)) AS DATE) AS d
            FROM (SELECT CAST(MAX(ts) AS DATE) AS hi FROM {events}))""",
)
def auth_dim_date(f: Frames):
    until = f.events.agg(F.max("ts").cast("date").alias("d")).first()["d"]
    return plan.dim_date(f.spark, until, RUN_TS)


@query(
    "user_nk username email status country display_name is_mfa_enabled:b primary_role _record_hash user_sk",
    f"""SELECT *, {sha(*TRACKED)} AS _record_hash, md5(user_nk || '|2024-01-30 00:00:00') AS user_sk FROM (
        SELECT u.user_id AS user_nk, lower(trim(username)) AS username, lower(trim(email)) AS email,
            lower(trim(status)) AS status, upper(country) AS country, display_name,
            m.user_id IS NOT NULL AS is_mfa_enabled, COALESCE(lower(trim(r.name)), 'user') AS primary_role
        FROM {USERS} u LEFT JOIN (SELECT DISTINCT user_id FROM {{auth_devices}} WHERE confirmed) m
            ON u.user_id = m.user_id
        LEFT JOIN (SELECT user_id, role_id FROM {{auth_user_roles}} QUALIFY row_number() OVER
            (PARTITION BY user_id ORDER BY granted_at, role_id) = 1) g ON u.user_id = g.user_id
        LEFT JOIN {{auth_roles}} r ON g.role_id = r.role_id)""",
)
def dim_user_initial(f: Frames):
    state = plan.user_state(
        silver_of(f, "auth_users", "users", ["event_id"]), silver_of(f, "auth_devices", "mfa_devices"),
        f.auth_user_roles, silver_of(f, "auth_roles", "roles"),
    )
    return scd.open_versions(state, "user_nk", plan.TRACKED_USER_ATTRIBUTES, LAST_DAY, "user_sk")


VERSION_COLUMNS = "user_sk user_nk username status effective_from:t effective_to:t is_current:b"


def _plain_versions(df):
    renamed = {"_effective_from": "effective_from", "_effective_to": "effective_to", "_is_current": "is_current"}
    return df.withColumnsRenamed(renamed)


@query(VERSION_COLUMNS, f"SELECT * FROM {VERSIONS}")
def scd2_rebuild(f: Frames):
    return _plain_versions(versions(f))


RUN_DAYS = [dt.date(2024, 1, 7) + dt.timedelta(days=7 * i) for i in range(3)] + [dt.date(2024, 1, 30)]
RUN_STATES = " UNION ALL ".join(
    f"SELECT DATE '{d}' AS day, * EXCLUDE (day) FROM {STATES} WHERE day <= DATE '{d}' "
    f"QUALIFY row_number() OVER (PARTITION BY user_nk ORDER BY day DESC) = 1"
    for d in RUN_DAYS
)


@query(VERSION_COLUMNS, f"SELECT * FROM {VERSIONS.replace(STATES, f'({RUN_STATES})')}")
def scd2_incremental(f: Frames):
    """Weekly runs into a table; each closes changed users and opens new versions."""
    path = shared_folder(f.spark, "dim_user")
    states = daily_states(f)
    for day in RUN_DAYS:
        known = states.where(F.col("day") <= F.lit(day))
        src = latest_per_key(known, ["user_nk"], [F.desc("day")]).drop("day")
        scd2_table(src, path, "user_nk", HISTORY_TRACKED, str(day), "user_sk")
    return _plain_versions(read_table(f.spark, path))


def _without(user: str) -> str:
    return f"(SELECT * REPLACE (NULLIF(user_nk, '{user}') AS user_nk) FROM ({RUN_STATES}))"


@query(VERSION_COLUMNS.replace("user_sk ", ""), f"SELECT * FROM {VERSIONS.replace(STATES, _without('7'))}")
def scd2_null_key(f: Frames):
    """The same runs where a user has no key: NULL closes and opens versions like any other key."""
    path = shared_folder(f.spark, "dim_user")
    states = daily_states(f)
    for day in RUN_DAYS:
        known = states.where(F.col("day") <= F.lit(day))
        src = latest_per_key(known, ["user_nk"], [F.desc("day")]).drop("day")
        scd2_table(src.withColumn("user_nk", F.nullif("user_nk", F.lit("7"))), path, "user_nk", HISTORY_TRACKED, str(day), "user_sk")
    return _plain_versions(read_table(f.spark, path))


LATE_DAYS = [dt.date(2024, 1, n) for n in (17, 5, 6, 23)]


@query(VERSION_COLUMNS, f"SELECT * FROM {VERSIONS}")
def scd2_late_days(f: Frames):
    """Days that come after all others, in no order, are spliced into the closed history."""
    states = written_once(daily_states(f), "states")
    known = states.where(~F.col("day").isin(LATE_DAYS))
    dim = scd.scd2_rebuild(known, "user_nk", HISTORY_TRACKED, "day", "user_sk")
    for day in LATE_DAYS:
        src = states.where(F.col("day") == F.lit(day))
        dim = written_once(scd.scd2_splice(dim, known, src.drop("day"), "user_nk", HISTORY_TRACKED, "day", day, "user_sk"), "dim_user")
        known = known.unionByName(src)
    return _plain_versions(dim)


@query(
    """attempt_id:i user_sk date_key:i auth_method_sk attempted_at:t is_success:i is_mfa_challenged:i failure_reason
    attempt_date:d""",
    f"""SELECT a.*, COALESCE(v.user_sk, '-1') AS user_sk, CAST(strftime(attempted_at, '%Y%m%d') AS INT) AS date_key,
        md5(auth_method) AS auth_method_sk, success::INT AS is_success, mfa_challenged::INT AS is_mfa_challenged,
        CAST(attempted_at AS DATE) AS attempt_date
        FROM {CLEAN_ATTEMPTS} a LEFT JOIN {VERSIONS} v ON a.user_id = v.user_nk
        AND v.effective_from <= a.attempted_at AND a.attempted_at < v.effective_to""",
)
def pit_login_attempts(f: Frames):
    return plan.fact_login_attempts(silver_of(f, "auth_attempts", "login_attempts"), versions(f), RUN_TS)


@query(
    """session_id user_sk date_key:i auth_method_sk created_at:t session_duration_seconds:i is_active:i was_revoked:i
    session_date:d""",
    f"""SELECT s.*, COALESCE(v.user_sk, '-1') AS user_sk, CAST(strftime(created_at, '%Y%m%d') AS INT) AS date_key,
        md5(auth_method) AS auth_method_sk, CAST(created_at AS DATE) AS session_date
        FROM (SELECT * REPLACE (is_active::INT AS is_active, was_revoked::INT AS was_revoked) FROM {CLEAN_SESSIONS}) s
        LEFT JOIN {VERSIONS} v ON s.user_id = v.user_nk AND v.effective_from <= s.created_at
        AND s.created_at < v.effective_to""",
)
def pit_sessions(f: Frames):
    return plan.fact_sessions(silver_of(f, "auth_sessions", "sessions"), versions(f), RUN_TS)


# Versions that open and close within a day: the first signup event of each user and hour opens one.
SIGNUPS = """(SELECT CAST(user_id AS VARCHAR) AS nk, ts AS f, COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts),
    TIMESTAMP '9999-12-31') AS u, CAST(event_id AS VARCHAR) AS sk FROM (SELECT * FROM {events}
    WHERE event_type = 'signup' QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts)
    ORDER BY ts, event_id) = 1))"""


def _signup_versions(f: Frames):
    """At most one version per user and hour, so the window over a user stays small."""
    signups = f.events.where(F.col("event_type") == "signup").withColumn("hour", F.date_trunc("hour", "ts"))
    first = latest_per_key(signups, ["user_id", "hour"], [F.asc("ts"), F.asc("event_id")])
    until = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts"))
    return first.select(
        F.col("user_id").cast("string").alias("nk"), F.col("ts").alias("_effective_from"),
        F.coalesce(until, F.lit(scd.OPEN_END).cast("timestamp")).alias("_effective_to"),
        F.col("event_id").cast("string").alias("sk"),
    )


PIT_ORACLE = f"""SELECT event_id, COALESCE(sk, '-1') AS sk FROM {{events}} e LEFT JOIN {SIGNUPS} p
    ON CAST(e.user_id AS VARCHAR) = p.nk AND p.f <= e.ts AND e.ts < p.u"""


@query("event_id:i sk", PIT_ORACLE)
def pit_join(f: Frames):
    facts = f.events.select("event_id", F.col("user_id").cast("string").alias("user_id"), "ts")
    return scd.pit_join(facts, _signup_versions(f), "user_id", "ts", "nk")


@query("event_id:i sk", PIT_ORACLE)
def pit_join_direct(f: Frames):
    facts = f.events.select("event_id", F.col("user_id").cast("string").alias("user_id"), "ts")
    return scd.pit_join_direct(facts, _signup_versions(f), "user_id", "ts", "nk")
