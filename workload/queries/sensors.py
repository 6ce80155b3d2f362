"""Weather, crypto, earthquake and air quality over events; JSON payloads built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.keyed import latest_per_key
from tidemark.plans import sensors as plan
from tidemark.sources import payloads
from workload.frames import RUN_TS, Frames
from workload.registry import latest, query

WEATHER = latest("weather_bronze", "city, observation_ts", "ingest_ts DESC")
CRYPTO = latest("crypto_bronze", "coin_id, logical_date", "ingest_ts DESC")
QUAKES = latest("quake_bronze", "event_id", "ingest_ts DESC")
AIR = latest("air_bronze", "sensor_id, hour_utc", "ingest_ts DESC, event_id DESC")

CLASS = """CASE WHEN mag IS NULL THEN NULL WHEN mag >= 8 THEN 'great' WHEN mag >= 7 THEN 'major' WHEN mag >= 6 THEN 'strong'
    WHEN mag >= 5 THEN 'moderate' WHEN mag >= 4 THEN 'light' WHEN mag >= 2 THEN 'minor' ELSE 'micro' END"""


@query(
    """city lat:n lon:n observation_ts:t temperature_2m:n relative_humidity_2m:n wind_speed_10m:n precipitation:n
    pressure_msl:n cloud_cover:n source observation_date:d""",
    f"SELECT * FROM {WEATHER}",
)
def weather_hourly(f: Frames):
    return plan.weather_hourly(f.weather_bronze)


@query(
    """city day:d temp_min:n temp_max:n temp_avg:n humidity_avg:n wind_max:n precipitation_total:n hours_observed:i
    computed_at:t""",
    f"""SELECT city, CAST(observation_ts AS DATE) AS day, MIN(temperature_2m) AS temp_min,
        MAX(temperature_2m) AS temp_max, AVG(temperature_2m) AS temp_avg, AVG(relative_humidity_2m) AS humidity_avg,
        MAX(wind_speed_10m) AS wind_max, COALESCE(SUM(precipitation), 0) AS precipitation_total,
        COUNT(*) AS hours_observed, TIMESTAMP '2024-02-01' AS computed_at FROM {WEATHER} GROUP BY 1, 2""",
)
def weather_daily(f: Frames):
    return plan.weather_daily(plan.weather_hourly(f.weather_bronze), RUN_TS)


@query(
    """coin_id symbol name day:d current_price_usd:n market_cap_usd:n market_cap_rank:i total_volume_usd:n
    price_change_percentage_24h:n last_updated:t source""",
    f"SELECT *, logical_date AS day FROM {CRYPTO}",
)
def crypto_prices_daily(f: Frames):
    return plan.crypto_prices_daily(f.crypto_bronze)


@query(
    """day:d coin_count:i total_market_cap_usd:n total_volume_usd:n top_gainer_coin_id top_gainer_pct_24h:n
    top_loser_coin_id top_loser_pct_24h:n highest_volume_coin_id highest_volume_usd:n""",
    f"""WITH c AS (SELECT *, logical_date AS day FROM {CRYPTO}),
        g AS (SELECT day, coin_id, price_change_percentage_24h AS v FROM c WHERE v IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY day ORDER BY v DESC, coin_id) = 1),
        l AS (SELECT day, coin_id, price_change_percentage_24h AS v FROM c WHERE v IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY day ORDER BY v, coin_id) = 1),
        h AS (SELECT day, coin_id, total_volume_usd AS v FROM c WHERE v IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY day ORDER BY v DESC, coin_id) = 1),
        t AS (SELECT day, COUNT(*) AS coin_count, SUM(market_cap_usd) AS total_market_cap_usd,
            COALESCE(SUM(total_volume_usd), 0) AS total_volume_usd FROM c GROUP BY 1)
        SELECT t.*, g.coin_id AS top_gainer_coin_id, g.v AS top_gainer_pct_24h, l.coin_id AS top_loser_coin_id,
            l.v AS top_loser_pct_24h, h.coin_id AS highest_volume_coin_id, h.v AS highest_volume_usd
        FROM t LEFT JOIN g ON t.day = g.day LEFT JOIN l ON t.day = l.day LEFT JOIN h ON t.day = h.day""",
)
def crypto_movers(f: Frames):
    return plan.crypto_market_daily(plan.crypto_prices_daily(f.crypto_bronze), RUN_TS)


@query(
    "coin_id logical_date:d market_cap_usd:n",
    "SELECT * FROM {crypto_bronze} ORDER BY market_cap_usd DESC NULLS LAST, coin_id, logical_date LIMIT 20",
)
def top_markets(f: Frames):
    return payloads.top_markets(f.crypto_bronze)


@query(
    """event_id mag:n mag_type place event_time:t updated_time:t latitude:n longitude:n depth_km:n alert tsunami:n
    sig:n net status event_date:d magnitude_class""",
    f"SELECT *, CAST(event_time AS DATE) AS event_date, {CLASS} AS magnitude_class FROM {QUAKES}",
)
def earthquake_events(f: Frames):
    return plan.earthquake_events(f.quake_bronze)


@query(
    """event_date:d total_count:i max_magnitude:n avg_magnitude:n avg_depth_km:n tsunami_count:i significant_count:i
    micro_count:i minor_count:i light_count:i moderate_count:i strong_count:i major_count:i great_count:i
    most_significant_place most_significant_magnitude:n""",
    f"""WITH q AS (SELECT *, CAST(event_time AS DATE) AS event_date FROM {QUAKES}),
        top AS (SELECT event_date, place, mag FROM q QUALIFY row_number() OVER
            (PARTITION BY event_date ORDER BY sig DESC NULLS LAST, event_id DESC) = 1)
        SELECT a.*, top.place AS most_significant_place, top.mag AS most_significant_magnitude FROM (
            SELECT event_date, COUNT(*) AS total_count, MAX(mag) AS max_magnitude, AVG(mag) AS avg_magnitude,
            AVG(depth_km) AS avg_depth_km, SUM(COALESCE(tsunami, 0)) AS tsunami_count,
            COUNT(*) FILTER (sig >= 600) AS significant_count, COUNT(*) FILTER (mag < 2) AS micro_count,
            COUNT(*) FILTER (mag >= 2 AND mag < 4) AS minor_count, COUNT(*) FILTER (mag >= 4 AND mag < 5) AS light_count,
            COUNT(*) FILTER (mag >= 5 AND mag < 6) AS moderate_count,
            COUNT(*) FILTER (mag >= 6 AND mag < 7) AS strong_count,
            COUNT(*) FILTER (mag >= 7 AND mag < 8) AS major_count, COUNT(*) FILTER (mag >= 8) AS great_count
            FROM q GROUP BY 1) a JOIN top ON a.event_date = top.event_date""",
)
def earthquake_daily(f: Frames):
    return plan.earthquake_daily(plan.earthquake_events(f.quake_bronze))


@query(
    """sensor_id:i location_id:i location_name country_code latitude:n longitude:n parameter_name parameter_units
    hour_utc:t measurement_date:d hour_of_day:i value:n summary_min:n summary_max:n percent_coverage:n logical_date:d""",
    f"""SELECT *, CAST(hour_utc AS DATE) AS measurement_date, hour(hour_utc) AS hour_of_day FROM {AIR} a
        WHERE percent_coverage > 0""",
)
def airquality_hourly(f: Frames):
    return plan.airquality_hourly(f.air_bronze, ["event_id"])


@query(
    """location_id:i location_name country_code parameter_name measurement_date:d avg_value:n min_value:n max_value:n
    hourly_reading_count:i aqi_category""",
    f"""SELECT *, CASE WHEN parameter_name <> 'pm25' OR avg_value IS NULL THEN NULL WHEN avg_value > 45 THEN 'hazardous'
        WHEN avg_value > 35 THEN 'very_unhealthy' WHEN avg_value > 25 THEN 'unhealthy'
        WHEN avg_value > 15 THEN 'unhealthy_sensitive' WHEN avg_value > 5 THEN 'moderate' ELSE 'good' END AS aqi_category
        FROM (SELECT location_id, location_name, country_code, parameter_name, CAST(hour_utc AS DATE) AS measurement_date,
            AVG(value) AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value,
            COUNT(value) AS hourly_reading_count FROM {AIR} a WHERE percent_coverage > 0 GROUP BY 1, 2, 3, 4, 5)""",
)
def airquality_daily(f: Frames):
    return plan.airquality_daily(plan.airquality_hourly(f.air_bronze, ["event_id"]))


# --- JSON payloads ------------------------------------------------------------


@query(
    """city lat:n lon:n observation_ts:t temperature_2m:n relative_humidity_2m:n wind_speed_10m:n precipitation:n
    pressure_msl:n cloud_cover:n source""",
    "SELECT * FROM {weather_bronze}",
)
def flatten_weather(f: Frames):
    """Hours of a city, day and revision packed into parallel arrays (at most 24), then unpacked."""
    revision = (F.col("ingest_ts") - F.col("observation_ts")).alias("revision")
    time = F.date_format("observation_ts", "yyyy-MM-dd'T'HH:mm").alias("time")
    day = f.weather_bronze.groupBy("city", "lat", "lon", "observation_date", revision).agg(
        F.sort_array(F.collect_list(F.struct(time, *payloads.WEATHER_MEASURES))).alias("h")
    )
    arrays = [F.col(f"h.{c}").alias(c) for c in ("time", *payloads.WEATHER_MEASURES)]
    document = F.struct("city", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
                        F.struct(*arrays).alias("hourly"))
    return payloads.flatten_weather(day.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("payload")), RUN_TS)


@query(
    """event_id mag:n mag_type place event_time:t updated_time:t latitude:n longitude:n depth_km:n alert tsunami:n
    sig:n net status logical_date:d source""",
    "SELECT * FROM {quake_bronze}",
)
def flatten_earthquake(f: Frames):
    millis = F.unix_millis
    properties = F.struct(
        "mag", F.col("mag_type").alias("magType"), "place", millis("event_time").alias("time"),
        millis("updated_time").alias("updated"), "alert", "tsunami", "sig", "net", "status",
    )
    feature = F.struct(
        F.col("event_id").alias("id"), properties.alias("properties"),
        F.struct(F.array("longitude", "latitude", "depth_km").alias("coordinates")).alias("geometry"),
    )
    docs = f.quake_bronze.select("logical_date", F.to_json(F.array(feature)).alias("payload"))
    return payloads.flatten_earthquake(docs, F.col("logical_date"), RUN_TS)


@query(
    """coin_id symbol name current_price_usd:n market_cap_usd:n market_cap_rank:i total_volume_usd:n high_24h_usd:n
    low_24h_usd:n price_change_24h_usd:n price_change_percentage_24h:n price_change_percentage_7d:n
    circulating_supply:n max_supply:n ath_usd:n last_updated:t logical_date:d source""",
    "SELECT * FROM {crypto_bronze}",
)
def flatten_crypto(f: Frames):
    api = {column: field for field, column in payloads.CRYPTO_NAMES.items()}
    fields = [c for c in f.crypto_bronze.columns if c not in ("ingest_ts", "logical_date", "source", "last_updated")]
    coin = F.struct(
        *[F.col(c).alias(api.get(c, c)) for c in fields],
        F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("last_updated"),
    )
    docs = f.crypto_bronze.select("logical_date", F.to_json(F.array(coin)).alias("payload"))
    return payloads.flatten_crypto(docs, F.col("logical_date"), RUN_TS)


@query(
    """sensor_id:i location_id:i location_name country_code latitude:n longitude:n parameter_name parameter_units
    parameter_id:i hour_utc:t value:n summary_min:n summary_max:n percent_coverage:n observed_count:i
    logical_date:d source""",
    f"SELECT * FROM {AIR} a WHERE hour(hour_utc) <> 13",
)
def flatten_airquality(f: Frames):
    """One document per sensor and day with its hours (at most 24); hour 13 lacks a start time."""
    hours = latest_per_key(f.air_bronze, ["sensor_id", "hour_utc"], [F.desc("ingest_ts"), F.desc("event_id")])
    start = F.when(F.hour("hour_utc") != 13, F.date_format("hour_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    hour = F.struct(
        "value",
        F.struct(F.struct(start.alias("utc")).alias("datetimeFrom")).alias("period"),
        F.struct(F.col("summary_min").alias("min"), F.col("summary_max").alias("max")).alias("summary"),
        F.struct(F.col("percent_coverage").alias("percentComplete"),
                 F.col("observed_count").cast("double").alias("observedCount")).alias("coverage"),
    )
    place = ["location_id", "location_name", "country_code", "latitude", "longitude"]
    sensor = ["sensor_id", "parameter_name", "parameter_units", "parameter_id"]
    daily = hours.groupBy(*place, *sensor, "logical_date").agg(F.collect_list(hour).alias("hours"))
    one = F.struct(F.col("sensor_id").alias("id"), *sensor[1:], "hours")
    document = F.to_json(F.struct(*place, F.array(one).alias("sensors")))
    docs = daily.select("logical_date", document.alias("payload"))
    return payloads.flatten_airquality(docs, F.col("logical_date"), RUN_TS)
