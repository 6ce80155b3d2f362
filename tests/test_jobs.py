"""A lake built day by day from database rows and payloads, then built again."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.operators.quality import fingerprint
from tidemark.sources import jdbc, lake, payloads
from tidemark.sources.bronze import align, to_bronze
from tidemark.specs import BRONZE, SPECS, spec
from workload.frames import Frames

from given import SF

DAY = dt.date(2001, 7, 31)
TS = dt.datetime(2024, 2, 1)


def land(run, frames, domain, view, table, where="true"):
    contract = spec(domain, "bronze", table)
    rows = getattr(frames, view).where(where)
    return jobs.land_rows(run, table, domain, rows.select(*contract.source_columns))


def content(run, *key):
    df = lake.read_table(run.spark, run.path(*key))
    return fingerprint(df).first()


def test_payments_twice(spark, tmp_path):
    f, run = Frames(spark, SF), jobs.Run(spark, str(tmp_path), DAY, TS)
    recent = "created_at >= '2001-07-01'"
    for view in ("merchants", "customers", "methods"):
        assert land(run, f, "payments", f"pay_{view}", f"payments_{view}_raw") > 0
    for view in ("payments", "refunds", "fees", "settlements"):
        assert land(run, f, "payments", f"pay_{view}", f"payments_{view}_raw", recent) > 0
    # The bronze rows carry one logical day; facts keep their own dates.
    names = [k for k in jobs.JOBS if k[0] == "payments"]
    silver = [k for k in names if k[1] == "silver"]
    for key in silver:
        jobs.run_job(run, *key)
    day = lake.read_table(spark, run.path("payments", "silver", "fact_payments")).agg(F.max("payment_date")).first()[0]
    gold = [k for k in names if k[1] == "gold"]
    later = jobs.Run(spark, str(tmp_path), day, TS)
    for key in gold:
        jobs.run_job(later, *key)
    first = {k: content(run, *k) for k in names}
    for key in silver:
        jobs.run_job(run, *key)
    for key in gold:
        jobs.run_job(later, *key)
    assert {k: content(run, *k) for k in names} == first
    assert first[("payments", "gold", "daily_payment_summary")].n_rows == 1


def test_rides_and_snapshot_reload(spark, tmp_path):
    f, run = Frames(spark, SF), jobs.Run(spark, str(tmp_path), DAY, TS)
    pairs = {
        "cities": "ride_cities", "vehicle_categories": "ride_categories", "riders": "ride_riders",
        "drivers": "ride_drivers", "vehicles": "ride_vehicles", "rides": "ride_rides", "fares": "ride_fares",
        "ride_payments": "ride_payments", "ratings": "ride_ratings", "driver_payouts": "ride_payouts",
    }
    for table, view in pairs.items():
        land(run, f, "rideon", view, f"rideon_{table}_raw")
    before = content(run, "rideon", "bronze", "rideon_riders_raw")
    land(run, f, "rideon", "ride_riders", "rideon_riders_raw")
    assert content(run, "rideon", "bronze", "rideon_riders_raw") == before
    for key in jobs.JOBS:
        if key[0] == "rideon":
            jobs.run_job(run, *key)
            assert content(run, *key).n_rows > 0


def test_identity_over_two_days(spark, tmp_path):
    f = Frames(spark, SF)
    first, second = (jobs.Run(spark, str(tmp_path), dt.date(2024, 1, d), TS) for d in (10, 11))
    for run in (first, second):
        day = F.to_date("ingest_ts") == F.lit(run.day)
        for view, table in (
            ("auth_users", "users"), ("auth_sessions", "sessions"), ("auth_attempts", "login_attempts"),
            ("auth_devices", "mfa_devices"),
        ):
            contract = spec("auth", "bronze", f"{table}_raw")
            jobs.land_rows(run, f"{table}_raw", "auth", getattr(f, view).where(day).select(*contract.source_columns))
        for view in ("roles", "permissions", "role_permissions", "user_roles"):
            land(run, f, "auth", f"auth_{view}", f"{view}_raw")
        land(run, f, "auth", "auth_oauth", "oauth_accounts_raw")
        for key in jobs.JOBS:
            if key[0] == "auth":
                jobs.run_job(run, *key)
    users = lake.read_table(spark, second.path("auth", "gold", "dim_user"))
    assert users.where("_is_current").count() == users.select("user_nk").distinct().count()
    assert users.where("NOT _is_current AND _effective_to = timestamp '2024-01-11'").count() > 0
    attempts = lake.read_table(spark, second.path("auth", "gold", "fact_login_attempts"))
    known = attempts.join(users, "user_sk", "left_anti").where("user_sk <> '-1'")
    assert attempts.count() > 0 and known.isEmpty()
    before = users.count()
    jobs.run_job(second, "auth", "gold", "dim_user")
    assert lake.read_table(spark, second.path("auth", "gold", "dim_user")).count() == before


def documents(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")


def test_payload_domains(spark, tmp_path):
    run = jobs.Run(spark, str(tmp_path), dt.date(2024, 1, 10), TS)
    weather = {
        "city": "Baku", "latitude": 40.4, "longitude": 49.9,
        "hourly": {
            "time": ["2024-01-10T00:00", "2024-01-10T01:00"], "temperature_2m": [1.5, None],
            "relative_humidity_2m": [80, 81], "wind_speed_10m": [3.0, 4.0], "precipitation": [None, 0.5],
            "pressure_msl": [1000.0, 1001.0], "cloud_cover": [10, None],
        },
    }
    quake = [{
        "id": "q1", "properties": {"mag": 6.0, "place": "x", "time": 1704870000123, "updated": None, "sig": 650},
        "geometry": {"coordinates": [1.0, 2.0, 3.0]},
    }, {"id": "q2", "properties": {"mag": None, "time": 1704870001000}, "geometry": None}]
    coin = [{"id": "btc", "current_price": 1, "market_cap": 5, "last_updated": "2024-01-10T10:00:00.000Z"}]
    air = {
        "location_id": 1, "location_name": "L", "country_code": "AZ", "latitude": 1.0, "longitude": 2.0,
        "sensors": [{"id": 7, "parameter_name": "pm25", "parameter_units": "u", "parameter_id": 2, "hours": [
            {"value": 12.0, "period": {"datetimeFrom": {"utc": "2024-01-10T03:00:00Z"}}, "summary": {"min": 1.0},
             "coverage": {"percentComplete": 50.0, "observedCount": 1.0}},
            {"value": 13.0, "period": {}, "coverage": {"percentComplete": 50.0}}]}],
    }
    landed = {
        "weather": jobs.land_payloads(run, "weather", documents(spark, weather)),
        "earthquake": jobs.land_payloads(run, "earthquake", documents(spark, quake)),
        "crypto": jobs.land_payloads(run, "crypto", documents(spark, coin)),
        "airquality": jobs.land_payloads(run, "airquality", documents(spark, air)),
    }
    assert landed == {"weather": 2, "earthquake": 2, "crypto": 1, "airquality": 1}
    for key in jobs.SENSORS:
        jobs.run_job(run, *key)
    def one(*key):
        return lake.read_table(spark, run.path(*key)).first()

    day = one("weather", "gold", "weather_daily")
    assert (day.city, day.temp_max, day.precipitation_total, day.hours_observed) == ("Baku", 1.5, 0.5, 2)
    shaken = one("earthquake", "gold", "earthquake_daily")
    assert (shaken.total_count, shaken.strong_count, shaken.significant_count) == (2, 1, 1)
    events = lake.read_table(spark, run.path("earthquake", "silver", "earthquake_events")).orderBy("event_id").collect()
    assert (events[0].latitude, events[0].longitude, events[0].depth_km, events[1].latitude) == (2.0, 1.0, 3.0, None)
    assert events[0].event_time == dt.datetime(2024, 1, 10, 7, 0, 0, 123000)
    assert one("crypto", "silver", "crypto_prices_daily").last_updated == dt.datetime(2024, 1, 10, 10)
    clean = one("airquality", "gold", "airquality_daily")
    assert (clean.avg_value, clean.aqi_category, clean.hourly_reading_count) == (12.0, "moderate", 1)


def test_top_markets(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None), ("d", 3.0)], "coin_id string, market_cap_usd double")
    assert [r.coin_id for r in payloads.top_markets(df, 3).collect()] == ["b", "d", "a"]


def test_required_column_fails_the_write(spark):
    contract = spec("payments", "bronze", "payments_fees_raw")
    rows = spark.createDataFrame([], contract.schema).select(*contract.source_columns)
    bad = rows.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS fee_id"), allowMissingColumns=True)
    landed = to_bronze(bad, contract, DAY, TS)
    with pytest.raises(PySparkException, match="fee_id is NULL"):
        landed.collect()
    assert align(rows, contract.schema.__class__(contract.schema.fields[:2])).columns == ["fee_id", "payment_id"]


def test_raw_payload_of_a_database_row(spark):
    contract = spec("payments", "bronze", "payments_fees_raw")
    rows = spark.sql("""SELECT 'f1' AS fee_id, CAST(NULL AS STRING) AS payment_id, 'x' AS fee_type,
        CAST(2.5 AS DECIMAL(14,2)) AS amount, 'EUR' AS currency, TIMESTAMP '2024-01-01 10:00:00' AS created_at""")
    row = to_bronze(rows, contract, DAY, TS).first()
    assert json.loads(row.raw_payload) == {
        "fee_id": "f1", "payment_id": None, "fee_type": "x", "amount": "2.50", "currency": "EUR",
        "created_at": "2024-01-01T10:00:00+00:00",
    }
    assert (row.source, row.ingest_ts, row.logical_date) == ("postgres-source", TS, DAY)


def test_source_queries(spark):
    fees = spec("payments", "bronze", "payments_fees_raw")
    assert jdbc.source_query(fees, "2024-01-31") == (
        "SELECT CAST(fee_id AS text) AS fee_id, CAST(payment_id AS text) AS payment_id, fee_type, amount, currency, "
        "created_at FROM fees WHERE created_at >= TIMESTAMP '2024-01-31' AND created_at < TIMESTAMP '2024-02-01'"
    )
    assert jdbc.source_query(spec("auth", "bronze", "roles_raw"), DAY) == "SELECT role_id, name, description FROM roles"
    settled = spec("payments", "bronze", "payments_settlements_raw")
    assert jdbc.source_query(settled, "2024-01-31").endswith(
        "settlement_date >= DATE '2024-01-31' AND settlement_date < DATE '2024-02-01'"
    )
    options = jdbc.read_options(fees, "2024-01-31", "jdbc:x", partitions=4)
    assert (options["partitionColumn"], options["numPartitions"]) == ("created_at", "4")
    assert (options["lowerBound"], options["upperBound"]) == ("2024-01-31 00:00:00", "2024-02-01 00:00:00")
    assert len(jdbc.key_predicates(["role_id", "permission_id"], 3)) == 3
    for contract in BRONZE:
        if contract.source_table:
            assert jdbc.source_query(contract, DAY).startswith("SELECT ")


def test_contracts(spark):
    assert (len(BRONZE), len(SPECS)) == (34, 81)
    for contract in BRONZE:
        names = contract.schema.names
        assert set(contract.keys) <= set(names) and set(contract.partition) <= set(names)
    assert {k for k in SPECS if k[1] != "bronze"} == set(jobs.JOBS)


def test_a_session_seen_on_two_days_is_one_row(spark, tmp_path):
    f = Frames(spark, SF)
    contract = spec("auth", "bronze", "sessions_raw")
    rows = f.auth_sessions.where("logical_date = date '2024-01-10'").select(*contract.source_columns)
    for day in (10, 11):
        run = jobs.Run(spark, str(tmp_path), dt.date(2024, 1, day), TS)
        jobs.land_rows(run, "sessions_raw", "auth", rows)
        jobs.run_job(run, "auth", "silver", "sessions")
    silver = run.read("auth", "silver", "sessions")
    assert silver.count() == silver.select("session_id").distinct().count() == rows.count()
    assert {r[0] for r in silver.select("_source_logical_date").distinct().collect()} == {dt.date(2024, 1, 11)}
    # Facts before there is a user dimension have the unknown member.
    jobs.run_job(run, "auth", "gold", "fact_sessions")
    assert {r[0] for r in run.read("auth", "gold", "fact_sessions").select("user_sk").distinct().collect()} == {"-1"}


def test_every_contract_declares_its_columns():
    assert all(s.ddl and set(s.keys) <= set(s.schema.names) and set(s.partition) <= set(s.schema.names) for s in SPECS.values())
