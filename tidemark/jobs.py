"""Named jobs on a lake folder.

    python -m tidemark.jobs --root LAKE --domain payments --layer silver --table fact_payments --date 2024-01-15

A job reads its inputs from <root>/<domain>_<layer>/<table>, builds its plan and writes
with the mode of its table contract. Running a silver or gold job again for the same day
leaves the tables as they are; so does landing a snapshot, and landing anything again under the
same run id, which also finishes a run that died. Another run id, or none, appends again:
silver keeps the latest row per key.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import as_date, as_timestamp
from tidemark.plans import identity, payments, rides, sensors
from tidemark.session import build_session
from tidemark.sinks import tables
from tidemark.sinks.journal import load_run
from tidemark.sources import lake, payloads
from tidemark.sources.bronze import align, to_bronze
from tidemark.sources.jdbc import jdbc_read
from tidemark.specs import TableSpec, spec


#: Runs without an id of their own cannot be told from their repetitions.
NO_RUN_ID = "manual"


@dataclass(frozen=True)
class Run:
    """One job run: where, which day, and the run's own time stamp and id."""

    spark: SparkSession
    root: str
    day: dt.date
    run_ts: dt.datetime
    run_id: str = NO_RUN_ID

    def path(self, domain: str, layer: str, table: str) -> str:
        return lake.table_path(self.root, domain, layer, table)

    def read(self, domain: str, layer: str, table: str) -> DataFrame:
        path = self.path(domain, layer, table)
        tables.recover(self.spark, path)
        return lake.read_table(self.spark, path, schema=spec(domain, layer, table).schema)

    def exists(self, domain: str, layer: str, table: str) -> bool:
        return tables.exists(self.spark, self.path(domain, layer, table))

    def day_of(self, domain: str, layer: str, table: str, column: str = "logical_date") -> DataFrame:
        return lake.day_slice(self.read(domain, layer, table), column, self.day)


Build = Callable[[Run], DataFrame]


def _pay(run: Run, table: str) -> DataFrame:
    return run.day_of("payments", "bronze", f"payments_{table}_raw")


def _paid(run: Run, table: str, column: str | None = None) -> DataFrame:
    if column:
        return run.day_of("payments", "silver", table, column)
    return run.read("payments", "silver", table)


PAYMENTS: dict[tuple[str, str], Build] = {
    ("silver", "dim_customer"): lambda r: payments.dim_customer(_pay(r, "customers"), r.day, r.run_ts),
    ("silver", "dim_merchant"): lambda r: payments.dim_merchant(_pay(r, "merchants"), r.run_ts),
    ("silver", "dim_payment_method"): lambda r: payments.dim_payment_method(_pay(r, "methods"), r.day, r.run_ts),
    ("silver", "dim_date"): lambda r: payments.dim_date(r.spark.range(1).select(as_date(r.day).alias("date_day"))),
    ("silver", "fact_payments"): lambda r: payments.fact_payments(_pay(r, "payments")),
    ("silver", "fact_refunds"): lambda r: payments.fact_refunds(_pay(r, "refunds")),
    ("silver", "fact_fees"): lambda r: payments.fact_fees(_pay(r, "fees")),
    ("silver", "fact_settlements"): lambda r: payments.fact_settlements(_pay(r, "settlements")),
    ("gold", "daily_payment_summary"): lambda r: payments.daily_payment_summary(
        _paid(r, "fact_payments", "payment_date"), _paid(r, "fact_refunds", "refund_date"),
        _paid(r, "fact_fees", "fee_date"), r.run_ts,
    ),
    ("gold", "daily_revenue_by_merchant"): lambda r: payments.daily_revenue_by_merchant(
        _paid(r, "fact_payments", "payment_date"), _paid(r, "fact_refunds", "refund_date"),
        _paid(r, "fact_fees", "fee_date"), _paid(r, "dim_merchant"), r.run_ts,
    ),
    ("gold", "customer_lifetime_value"): lambda r: payments.customer_lifetime_value(
        _paid(r, "fact_payments"), _paid(r, "fact_refunds"), _paid(r, "dim_customer"), r.run_ts
    ),
    ("gold", "merchant_settlement_daily"): lambda r: payments.merchant_settlement_daily(
        _paid(r, "fact_settlements", "settlement_date"), _paid(r, "fact_payments", "payment_date"),
        _paid(r, "dim_merchant"), r.run_ts,
    ),
}


def _staged(run: Run, table: str) -> DataFrame:
    return rides.staging(run.read("rideon", "bronze", f"rideon_{table}_raw"), table)


def _model(run: Run, table: str) -> DataFrame:
    return run.read("rideon", "silver", table)


RIDES: dict[tuple[str, str], Build] = {
    ("silver", "dim_city"): lambda r: rides.dim_city(_staged(r, "cities")),
    ("silver", "dim_vehicle_category"): lambda r: rides.dim_vehicle_category(_staged(r, "vehicle_categories")),
    ("silver", "dim_rider"): lambda r: rides.dim_rider(_staged(r, "riders"), _staged(r, "cities")),
    ("silver", "dim_driver"): lambda r: rides.dim_driver(_staged(r, "drivers"), _staged(r, "cities")),
    ("silver", "dim_vehicle"): lambda r: rides.dim_vehicle(_staged(r, "vehicles"), _staged(r, "vehicle_categories")),
    ("silver", "dim_date"): lambda r: rides.dim_date(_staged(r, "rides")),
    ("silver", "fact_rides"): lambda r: rides.fact_rides(_staged(r, "rides"), _staged(r, "fares")),
    ("silver", "fact_ride_payments"): lambda r: rides.fact_ride_payments(
        _staged(r, "ride_payments"), _staged(r, "rides")
    ),
    ("silver", "fact_ratings"): lambda r: rides.fact_ratings(_staged(r, "ratings"), _staged(r, "rides")),
    ("silver", "fact_driver_payouts"): lambda r: rides.fact_driver_payouts(
        _staged(r, "driver_payouts"), _staged(r, "drivers")
    ),
    ("gold", "daily_city_performance"): lambda r: rides.daily_city_performance(
        _model(r, "fact_rides"), _model(r, "dim_city")
    ),
    ("gold", "driver_earnings_daily"): lambda r: rides.driver_earnings_daily(
        _model(r, "fact_driver_payouts"), _model(r, "dim_driver"), _model(r, "fact_ratings")
    ),
    ("gold", "rider_lifetime_value"): lambda r: rides.rider_lifetime_value(
        _model(r, "fact_rides"), _model(r, "fact_ride_payments"), _model(r, "dim_rider")
    ),
    ("gold", "surge_pricing_analysis"): lambda r: rides.surge_pricing_analysis(
        _model(r, "fact_rides"), _model(r, "dim_city"), _model(r, "dim_vehicle_category")
    ),
}


def _clean(run: Run, table: str) -> DataFrame:
    bronze = run.day_of("auth", "bronze", f"{table}_raw")
    return identity.silver(bronze, table, run.day, run.run_ts)


def _auth(run: Run, table: str, dated: bool = False) -> DataFrame:
    if dated:
        return run.day_of("auth", "silver", table, "_source_logical_date")
    return run.read("auth", "silver", table)


def _users_today(run: Run) -> DataFrame:
    state = identity.user_state(
        _auth(run, "users"), _auth(run, "mfa_devices"), run.day_of("auth", "bronze", "user_roles_raw"),
        _auth(run, "roles"),
    )
    return state.withColumn("_loaded_at", as_timestamp(run.run_ts))


def _dim_user(run: Run) -> DataFrame | None:
    """None before the first run of dim_user: facts then have the unknown member."""
    return run.read("auth", "gold", "dim_user") if run.exists("auth", "gold", "dim_user") else None


AUTH: dict[tuple[str, str], Build] = {
    **{("silver", t): (lambda r, t=t: _clean(r, t)) for t in identity.CLEANINGS},
    ("gold", "dim_date"): lambda r: identity.dim_date(r.spark, r.day, r.run_ts),
    ("gold", "dim_role"): lambda r: identity.dim_role(
        _auth(r, "roles"), r.day_of("auth", "bronze", "role_permissions_raw"), r.run_ts
    ),
    ("gold", "dim_auth_method"): lambda r: identity.dim_auth_method(
        _auth(r, "sessions"), _auth(r, "login_attempts"), r.run_ts
    ),
    ("gold", "dim_user"): _users_today,
    ("gold", "fact_login_attempts"): lambda r: identity.fact_login_attempts(
        _auth(r, "login_attempts", dated=True), _dim_user(r), r.run_ts
    ),
    ("gold", "fact_sessions"): lambda r: identity.fact_sessions(
        _auth(r, "sessions", dated=True), _dim_user(r), r.run_ts
    ),
}

SENSORS: dict[tuple[str, str, str], Build] = {
    ("weather", "silver", "weather_hourly"): lambda r: sensors.weather_hourly(
        lake.time_slice(r.day_of("weather", "bronze", "weather_raw", "observation_date"), "observation_ts", r.day)
    ),
    ("weather", "gold", "weather_daily"): lambda r: sensors.weather_daily(
        r.day_of("weather", "silver", "weather_hourly", "observation_date"), r.run_ts
    ),
    ("crypto", "silver", "crypto_prices_daily"): lambda r: sensors.crypto_prices_daily(
        r.day_of("crypto", "bronze", "crypto_prices_raw")
    ),
    ("crypto", "gold", "crypto_market_daily"): lambda r: sensors.crypto_market_daily(
        r.day_of("crypto", "silver", "crypto_prices_daily", "day"), r.run_ts
    ),
    ("earthquake", "silver", "earthquake_events"): lambda r: sensors.earthquake_events(
        r.day_of("earthquake", "bronze", "earthquake_raw")
    ),
    ("earthquake", "gold", "earthquake_daily"): lambda r: sensors.earthquake_daily(
        r.day_of("earthquake", "silver", "earthquake_events", "event_date")
    ),
    ("airquality", "silver", "airquality_hourly"): lambda r: sensors.airquality_hourly(
        r.day_of("airquality", "bronze", "airquality_hourly_raw")
    ),
    ("airquality", "gold", "airquality_daily"): lambda r: sensors.airquality_daily(
        r.day_of("airquality", "silver", "airquality_hourly", "measurement_date")
    ),
}

JOBS: dict[tuple[str, str, str], Build] = {
    **{("payments", *k): v for k, v in PAYMENTS.items()},
    **{("rideon", *k): v for k, v in RIDES.items()},
    **{("auth", *k): v for k, v in AUTH.items()},
    **SENSORS,
}

def store(df: DataFrame, path: str, contract: TableSpec, run: Run) -> None:
    """Write with the mode of the contract."""
    partition = list(contract.partition)
    match contract.mode:
        case "upsert":
            # A key is unique in the table, not only in its partition.
            tables.upsert_table(df, path, contract.keys, partition, moves=not set(partition) <= set(contract.keys))
        case "slice":
            tables.overwrite_slice(df, path, partition)
        case "full":
            tables.swap_full(df, path)
        case "scd2":
            tracked = identity.TRACKED_USER_ATTRIBUTES
            tables.scd2_table(df, path, contract.keys[0], tracked, str(run.day), "user_sk")
        case mode:
            raise ValueError(f"{contract.name}: no job writes mode {mode}")


def run_job(run: Run, domain: str, layer: str, table: str) -> None:
    """Run one silver or gold job, its result aligned to the contract.

    A day without source rows changes nothing; a table that is replaced whole refuses an
    empty result with EmptySourceError. SCD2 tables get their version columns when stored.
    """
    contract = spec(domain, layer, table)
    result = JOBS[(domain, layer, table)](run)
    if contract.mode != "scd2":
        result = align(result, contract.schema)
    store(result, run.path(domain, layer, table), contract, run)


def land_rows(run: Run, table: str, domain: str, rows: DataFrame) -> int:
    """Source rows into a bronze table: replace the day of a snapshot table, else append.

    All of them are of the run's day, which is the one partition they go to: no shuffle is needed."""
    contract = spec(domain, "bronze", table)
    bronze = to_bronze(rows, contract, run.day, run.run_ts, run.run_id)
    path, partition = run.path(domain, "bronze", table), list(contract.partition)
    if contract.mode == "snapshot":
        return tables.overwrite_slice_checked(bronze, path, partition, landed=partition == ["logical_date"])
    return _append(run, domain, table, bronze, partition, landed=partition == ["logical_date"])


def _append(run: Run, domain: str, table: str, rows: DataFrame, partition: list[str], landed: bool = False) -> int:
    """Appends a run's rows, once for each run id."""
    path = run.path(domain, "bronze", table)
    if run.run_id == NO_RUN_ID:
        return tables.counted(rows, lambda df: tables.append(df, path, partition, landed))
    return load_run(rows, path, partition, f"{run.root.rstrip('/')}/_loads", f"{domain}.{table}", str(run.day), run.run_id, landed)


def land_table(
    run: Run, table: str, domain: str, url: str, properties: dict[str, str], partitions: int = 1
) -> int:
    """Read a source table of the run's day over JDBC and land it."""
    contract = spec(domain, "bronze", table)
    return land_rows(run, table, domain, jdbc_read(run.spark, contract, run.day, url, properties, partitions))


def land_payloads(run: Run, domain: str, documents: DataFrame) -> int:
    """API payloads (column payload) flattened and appended to their bronze table."""
    match domain:
        case "weather":
            table, rows = "weather_raw", payloads.flatten_weather(documents, run.run_ts)
            rows = rows.withColumn("observation_date", F.to_date("observation_ts"))
        case "earthquake":
            table, rows = "earthquake_raw", payloads.flatten_earthquake(documents, run.day, run.run_ts)
        case "crypto":
            table, rows = "crypto_prices_raw", payloads.flatten_crypto(documents, run.day, run.run_ts)
        case "airquality":
            table, rows = "airquality_hourly_raw", payloads.flatten_airquality(documents, run.day, run.run_ts)
        case _:
            raise ValueError(f"{domain} has no payload source")
    contract = spec(domain, "bronze", table)
    return _append(run, domain, table, align(rows, contract.schema), list(contract.partition))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark.jobs")
    parser.add_argument("--root", required=True, help="lake folder")
    parser.add_argument("--domain", required=True)
    parser.add_argument("--layer", required=True, choices=["bronze", "silver", "gold"])
    parser.add_argument("--table", required=True)
    parser.add_argument("--date", required=True, type=dt.date.fromisoformat, help="logical day")
    parser.add_argument("--run-id", default=NO_RUN_ID)
    parser.add_argument("--payloads", help="folder of landed JSON documents, one per file")
    parser.add_argument("--url", help="JDBC URL of the source database")
    parser.add_argument("--property", action="append", default=[], help="JDBC property key=value")
    parser.add_argument("--connections", type=int, default=1, help="parallel JDBC connections")
    args = parser.parse_args(argv)
    spark = build_session(f"{args.domain}-{args.layer}-{args.table}")
    run = Run(spark, args.root, args.date, dt.datetime.now(dt.UTC).replace(tzinfo=None), args.run_id)
    if args.layer != "bronze":
        run_job(run, args.domain, args.layer, args.table)
        print(f"{args.table} {args.date}: done")
    elif args.payloads:
        documents = spark.read.text(args.payloads, wholetext=True).withColumnRenamed("value", "payload")
        print(f"{args.table} {args.date}: {land_payloads(run, args.domain, documents)} rows")
    else:
        properties = dict(p.split("=", 1) for p in args.property)
        rows = land_table(run, args.table, args.domain, args.url, properties, args.connections)
        print(f"{args.table} {args.date}: {rows} rows")


if __name__ == "__main__":
    main()
