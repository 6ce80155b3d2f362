"""API payloads (nested JSON text) to typed bronze rows.

Input frames hold one JSON document per row in column `payload`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import as_date, as_timestamp
from tidemark.specs import SOURCE_NAMES

# --- fixed values: payload shapes -------------------------------------------
WEATHER = """
    city string, latitude double, longitude double,
    hourly struct<time: array<string>, temperature_2m: array<double>,
        relative_humidity_2m: array<double>, wind_speed_10m: array<double>,
        precipitation: array<double>, pressure_msl: array<double>, cloud_cover: array<double>>
"""
EARTHQUAKE = """
    struct<id: string,
        properties: struct<mag: double, magType: string, place: string, time: bigint,
            updated: bigint, alert: string, tsunami: int, sig: int, net: string, status: string>,
        geometry: struct<coordinates: array<double>>>
"""
CRYPTO = """
    struct<id: string, symbol: string, name: string, current_price: double, market_cap: double,
        market_cap_rank: int, total_volume: double, high_24h: double, low_24h: double,
        price_change_24h: double, price_change_percentage_24h_in_currency: double,
        price_change_percentage_7d_in_currency: double, market_cap_change_24h: double,
        market_cap_change_percentage_24h: double, circulating_supply: double,
        total_supply: double, max_supply: double, ath: double, ath_change_percentage: double,
        last_updated: string>
"""
AIRQUALITY = """
    location_id int, location_name string, country_code string, latitude double, longitude double,
    sensors array<struct<id: int, parameter_name: string, parameter_units: string, parameter_id: int,
        hours: array<struct<value: double, period: struct<datetimeFrom: struct<utc: string>>,
            summary: struct<min: double, max: double, sd: double>,
            coverage: struct<percentComplete: double, observedCount: double>>>>>
"""
# API field -> bronze column, where the names differ.
CRYPTO_NAMES = {
    "id": "coin_id",
    "current_price": "current_price_usd",
    "market_cap": "market_cap_usd",
    "total_volume": "total_volume_usd",
    "high_24h": "high_24h_usd",
    "low_24h": "low_24h_usd",
    "price_change_24h": "price_change_24h_usd",
    "price_change_percentage_24h_in_currency": "price_change_percentage_24h",
    "price_change_percentage_7d_in_currency": "price_change_percentage_7d",
    "ath": "ath_usd",
}
# ----------------------------------------------------------------------------

WEATHER_MEASURES = (
    "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "precipitation", "pressure_msl", "cloud_cover",
)


def _housekeeping(run_ts, domain: str, raw: Column, logical_date=None) -> list[Column]:
    day = [] if logical_date is None else [as_date(logical_date).alias("logical_date")]
    return [
        as_timestamp(run_ts).alias("ingest_ts"), *day,
        F.lit(SOURCE_NAMES[domain]).alias("source"), raw.alias("raw_payload"),
    ]


def flatten_weather(payloads: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Parallel hourly arrays to one row per hour; hours are UTC."""
    doc = F.from_json("payload", WEATHER)
    hours = F.arrays_zip(F.col("d.hourly.time"), *[F.col(f"d.hourly.{m}") for m in WEATHER_MEASURES])
    rows = payloads.select("payload", doc.alias("d")).select("payload", "d", F.explode(hours).alias("h"))
    return rows.select(
        F.col("d.city").alias("city"),
        F.col("d.latitude").alias("lat"),
        F.col("d.longitude").alias("lon"),
        F.to_timestamp("h.time").alias("observation_ts"),
        *[F.col(f"h.{m}").alias(m) for m in WEATHER_MEASURES],
        *_housekeeping(run_ts, "weather", F.col("payload")),
    )


def flatten_earthquake(payloads: DataFrame, logical_date: dt.date | str | Column, run_ts) -> DataFrame:
    """GeoJSON feature lists to one row per event; epoch milliseconds to timestamps."""
    features = F.from_json("payload", f"array<{EARTHQUAKE}>")
    p, xyz = "f.properties", F.col("f.geometry.coordinates")
    rows = payloads.select(*payloads.columns, F.explode(features).alias("f"))
    return rows.select(
        F.col("f.id").alias("event_id"),
        F.col(f"{p}.mag").alias("mag"),
        F.col(f"{p}.magType").alias("mag_type"),
        F.col(f"{p}.place").alias("place"),
        F.timestamp_millis(f"{p}.time").alias("event_time"),
        F.timestamp_millis(f"{p}.updated").alias("updated_time"),
        F.get(xyz, F.lit(1)).alias("latitude"),
        F.get(xyz, F.lit(0)).alias("longitude"),
        F.get(xyz, F.lit(2)).alias("depth_km"),
        *[F.col(f"{p}.{c}").alias(c) for c in ("alert", "tsunami", "sig", "net", "status")],
        *_housekeeping(run_ts, "earthquake", F.to_json("f"), logical_date),
    )


def flatten_crypto(payloads: DataFrame, logical_date: dt.date | str | Column, run_ts) -> DataFrame:
    """Lists of coin objects to one row per coin."""
    coins = F.from_json("payload", f"array<{CRYPTO}>")
    rows = payloads.select(*payloads.columns, F.explode(coins).alias("c"))
    fields = [f.split(":")[0].strip() for f in CRYPTO.strip()[len("struct<"):-1].split(",")]
    values = [F.col(f"c.{f}").alias(CRYPTO_NAMES.get(f, f)) for f in fields if f != "last_updated"]
    return rows.select(
        *values,
        F.to_timestamp("c.last_updated").alias("last_updated"),
        *_housekeeping(run_ts, "crypto", F.to_json("c"), logical_date),
    )


def top_markets(coins: DataFrame, n: int = 20) -> DataFrame:
    """The n coins with the largest market cap, of landed data."""
    return coins.orderBy(F.desc_nulls_last("market_cap_usd"), "coin_id").limit(n)


def flatten_airquality(payloads: DataFrame, logical_date: dt.date | str | Column, run_ts) -> DataFrame:
    """Location x sensor x hour to rows; hours without a start time are dropped."""
    doc = F.from_json("payload", AIRQUALITY)
    sensors = payloads.select(*payloads.columns, doc.alias("d")).select(
        *payloads.columns, "d", F.explode("d.sensors").alias("s")
    )
    hours = sensors.select(*payloads.columns, "d", "s", F.explode("s.hours").alias("h")).where(
        "h.period.datetimeFrom.utc IS NOT NULL"
    )
    return hours.select(
        F.col("s.id").alias("sensor_id"),
        *[F.col(f"d.{c}").alias(c) for c in ("location_id", "location_name", "country_code", "latitude", "longitude")],
        *[F.col(f"s.{c}").alias(c) for c in ("parameter_name", "parameter_units", "parameter_id")],
        F.to_timestamp("h.period.datetimeFrom.utc").alias("hour_utc"),
        F.col("h.value").alias("value"),
        *[F.col(f"h.summary.{c}").alias(f"summary_{c}") for c in ("min", "max", "sd")],
        F.col("h.coverage.percentComplete").alias("percent_coverage"),
        F.col("h.coverage.observedCount").cast("int").alias("observed_count"),
        *_housekeeping(run_ts, "airquality", F.to_json("h"), logical_date),
    )
