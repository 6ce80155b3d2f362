"""Weather, crypto, earthquake and air quality: silver and daily marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    MAGNITUDE_BANDS,
    MAGNITUDE_LAST,
    as_timestamp,
    magnitude_class,
    pm25_category,
    sum_or_zero,
)
from tidemark.operators.keyed import latest_per_key
from tidemark.specs import spec

# --- fixed values -------------------------------------------------------------
SIGNIFICANT_FROM = 600
# ------------------------------------------------------------------------------


def _newest(tie: Sequence[str]) -> list[Column]:
    return [F.desc("ingest_ts"), *[F.desc(c) for c in tie]]


# --- silver -------------------------------------------------------------------


def weather_hourly(bronze: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    latest = latest_per_key(bronze, ["city", "observation_ts"], _newest(tie))
    dated = latest.withColumn("observation_date", F.to_date("observation_ts"))
    return dated.select(*spec("weather", "silver", "weather_hourly").source_columns)


def crypto_prices_daily(bronze: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    latest = latest_per_key(bronze, ["coin_id", "logical_date"], _newest(tie))
    dated = latest.withColumnRenamed("logical_date", "day")
    return dated.select(*spec("crypto", "silver", "crypto_prices_daily").source_columns)


def earthquake_events(bronze: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Events are revised after first publication; the last ingest wins."""
    latest = latest_per_key(bronze, ["event_id"], _newest(tie))
    derived = latest.withColumns(
        {"event_date": F.to_date("event_time"), "magnitude_class": magnitude_class("mag")}
    )
    return derived.select(*spec("earthquake", "silver", "earthquake_events").source_columns)


def airquality_hourly(bronze: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Zero-coverage hours are dropped after the latest row is known, so a zero-coverage
    correction also removes the good row before it from this slice."""
    latest = latest_per_key(bronze, ["sensor_id", "hour_utc"], _newest(tie))
    covered = latest.where(F.col("percent_coverage") > 0)
    derived = covered.withColumns(
        {"measurement_date": F.to_date("hour_utc"), "hour_of_day": F.hour("hour_utc")}
    )
    return derived.select(*spec("airquality", "silver", "airquality_hourly").source_columns)


# --- gold ---------------------------------------------------------------------


def weather_daily(hourly: DataFrame, run_ts) -> DataFrame:
    return hourly.groupBy("city", F.to_date("observation_ts").alias("day")).agg(
        F.min("temperature_2m").alias("temp_min"),
        F.max("temperature_2m").alias("temp_max"),
        F.avg("temperature_2m").alias("temp_avg"),
        F.avg("relative_humidity_2m").alias("humidity_avg"),
        F.max("wind_speed_10m").alias("wind_max"),
        sum_or_zero("precipitation").alias("precipitation_total"),
        F.count("observation_ts").alias("hours_observed"),
        F.first(as_timestamp(run_ts)).alias("computed_at"),
    )


def crypto_market_daily(prices: DataFrame, run_ts) -> DataFrame:
    """Day: totals and the top movers. Ties go to the smaller coin id."""
    change, volume = F.col("price_change_percentage_24h"), F.col("total_volume_usd")

    def best(metric: Column, sign: int) -> Column:
        # min over (sign x metric, coin): the extreme metric first, then the smaller id.
        entry = F.struct((metric * sign).alias("rank"), F.col("coin_id").alias("coin"), metric.alias("value"))
        return F.min(F.when(metric.isNotNull(), entry))

    by_day = prices.groupBy("day").agg(
        F.count(F.lit(1)).alias("coin_count"),
        sum_or_zero("market_cap_usd").alias("total_market_cap_usd"),
        sum_or_zero("total_volume_usd").alias("total_volume_usd"),
        best(change, -1).alias("gainer"),
        best(change, 1).alias("loser"),
        best(volume, -1).alias("busiest"),
    )
    return by_day.select(
        "day", "coin_count", "total_market_cap_usd", "total_volume_usd",
        F.col("gainer.coin").alias("top_gainer_coin_id"), F.col("gainer.value").alias("top_gainer_pct_24h"),
        F.col("loser.coin").alias("top_loser_coin_id"), F.col("loser.value").alias("top_loser_pct_24h"),
        F.col("busiest.coin").alias("highest_volume_coin_id"),
        F.col("busiest.value").alias("highest_volume_usd"),
        as_timestamp(run_ts).alias("computed_at"),
    )


def earthquake_daily(events: DataFrame) -> DataFrame:
    """Day: counts per magnitude class in one pass and the most significant event."""
    bands = [name for _, name in MAGNITUDE_BANDS] + [MAGNITUDE_LAST]
    in_band = [F.count_if(F.col("magnitude_class") == b).alias(f"{b}_count") for b in bands]
    # Largest sig first, NULL sig last, then the larger event id.
    top = F.max(F.struct(F.coalesce("sig", F.lit(-1)).alias("s"), "event_id", "place", "mag"))
    by_day = events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.max("mag").alias("max_magnitude"),
        F.avg("mag").alias("avg_magnitude"),
        F.avg("depth_km").alias("avg_depth_km"),
        F.sum(F.coalesce("tsunami", F.lit(0))).alias("tsunami_count"),
        F.count_if(F.col("sig") >= SIGNIFICANT_FROM).alias("significant_count"),
        *in_band,
        top.alias("top"),
    )
    return by_day.select(
        *[c for c in by_day.columns if c != "top"],
        F.col("top.place").alias("most_significant_place"),
        F.col("top.mag").alias("most_significant_magnitude"),
    )


def airquality_daily(hourly: DataFrame) -> DataFrame:
    keys = ["location_id", "location_name", "country_code", "parameter_name", "measurement_date"]
    by_day = hourly.groupBy(*keys).agg(
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count("value").alias("hourly_reading_count"),
    )
    return by_day.withColumn("aqi_category", pm25_category("avg_value", "parameter_name"))
