"""Ride-hailing: staging, silver star schema, gold marts and roll-ups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import dim_date_observed
from tidemark.functions.columns import as_date, exact_mean, percent, safe_ratio, seconds_between, sum_or_zero
from tidemark.operators.keyed import latest_per_key
from tidemark.specs import spec

# --- fixed values -------------------------------------------------------------
COMMISSION_RATE = "0.20"
RIDE_STATUSES = ("requested", "accepted", "completed", "cancelled")
RATER_ROLES = ("rider", "driver")
# ------------------------------------------------------------------------------


def staging(bronze: DataFrame, table: str, tie: Sequence[str] = ()) -> DataFrame:
    """Latest row per key over all bronze history, source columns only.

    The city name becomes city_name, so joined models need no alias.
    """
    contract = spec("rideon", "bronze", f"rideon_{table}_raw")
    order = [F.desc("ingest_ts"), *[F.desc(c) for c in tie]]
    latest = latest_per_key(bronze, contract.keys, order).select(*contract.source_columns)
    return latest.withColumnRenamed("name", "city_name") if table == "cities" else latest


# --- silver: dimensions -------------------------------------------------------


def dim_city(cities: DataFrame) -> DataFrame:
    return cities.withColumn("launched_date", F.to_date("launched_at"))


def dim_vehicle_category(categories: DataFrame) -> DataFrame:
    return categories.select(
        "category_id", "code", "display_name", "base_fare", "per_km_rate", "per_min_rate", "min_fare"
    )


def _full_name():
    return F.concat("first_name", F.lit(" "), "last_name").alias("full_name")


def dim_rider(riders: DataFrame, cities: DataFrame) -> DataFrame:
    joined = riders.join(cities.select("city_id", "city_name", "country"), "city_id", "left")
    return joined.select(
        "rider_id", "first_name", "last_name", _full_name(), "email", "phone", "city_id", "city_name",
        "country", "rating", "created_at", F.to_date("created_at").alias("signup_date"),
    )


def dim_driver(drivers: DataFrame, cities: DataFrame) -> DataFrame:
    joined = drivers.join(cities.select("city_id", "city_name", "country"), "city_id", "left")
    return joined.select(
        "driver_id", "first_name", "last_name", _full_name(), "email", "phone", "city_id", "city_name",
        "country", "license_number", "status", "rating", "onboarded_at",
        F.to_date("onboarded_at").alias("onboarded_date"),
    )


def dim_vehicle(vehicles: DataFrame, categories: DataFrame) -> DataFrame:
    labels = categories.select(
        "category_id", F.col("code").alias("category_code"), F.col("display_name").alias("category_name")
    )
    return vehicles.join(labels, "category_id", "left").select(
        "vehicle_id", "driver_id", "category_id", "category_code", "category_name", "make", "model",
        F.concat("make", F.lit(" "), "model").alias("make_model"), "year", "plate_number", "color",
        "registered_at",
    )


def dim_date(rides: DataFrame) -> DataFrame:
    return dim_date_observed(rides, "requested_at").select(
        "date_day", "year", "quarter", "month", "day", "day_of_week", "day_name", "iso_week", "is_weekend"
    )


# --- silver: facts ------------------------------------------------------------


def ride_states(rides: DataFrame) -> DataFrame:
    """Rides with what follows from the ride alone: its day, the wait and the flags."""
    wait = seconds_between("requested_at", "accepted_at").cast("decimal(18,0)") / F.lit(60).cast("decimal(2,0)")
    return rides.select(
        "*", F.to_date("requested_at").alias("ride_date"), F.round(wait, 2).alias("wait_min"),
        (F.col("status") == "completed").alias("is_completed"),
        (F.col("status") == "cancelled").alias("is_cancelled"),
        (F.col("surge_multiplier") > 1).alias("is_surge"),
    )


def fact_rides(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """Grain ride: foreign keys, measures, fare roll-up, flags; the columns of the contract."""
    fare = fares.select("ride_id", "total_fare", "surge_amount", "discount", "currency")
    return ride_states(rides).join(fare, "ride_id", "left").select(*spec("rideon", "silver", "fact_rides").schema.names)


def fact_ride_payments(payments: DataFrame, rides: DataFrame) -> DataFrame:
    ride = rides.select("ride_id", "driver_id", "city_id", "category_id")
    return payments.join(ride, "ride_id", "left").select(
        "payment_id", F.to_date("created_at").alias("payment_date"), "ride_id", "rider_id", "driver_id",
        "city_id", "category_id", "method", "amount", "currency", "status",
        (F.col("status") == "captured").alias("is_captured"),
        (F.col("status") == "refunded").alias("is_refunded"), "created_at", "updated_at",
    )


def fact_ratings(ratings: DataFrame, rides: DataFrame) -> DataFrame:
    ride = rides.select("ride_id", "rider_id", "driver_id", "city_id", "category_id")
    return ratings.join(ride, "ride_id", "left").select(
        "rating_id", F.to_date("created_at").alias("rating_date"), "ride_id", "rider_id", "driver_id",
        "city_id", "category_id", "rater_role", "score", "comment", "created_at",
    )


def fact_driver_payouts(payouts: DataFrame, drivers: DataFrame) -> DataFrame:
    return payouts.join(drivers.select("driver_id", "city_id"), "driver_id", "left").select(
        "payout_id", "payout_date", "driver_id", "city_id", "gross_amount", "commission", "net_amount",
        "currency", "rides_count", "status",
        F.round(safe_ratio("gross_amount", "rides_count"), 2).alias("avg_fare_per_ride"),
    )


# --- gold ---------------------------------------------------------------------


def daily_city_performance(rides: DataFrame, cities: DataFrame) -> DataFrame:
    """City and day. City labels are joined after the aggregation, on far fewer rows."""
    done = F.col("is_completed")
    by_city = rides.groupBy(F.col("ride_date").alias("day"), "city_id").agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.count_if(done).alias("completed_rides"),
        F.count_if("is_cancelled").alias("cancelled_rides"),
        sum_or_zero("total_fare").alias("gross_fare"),
        exact_mean("surge_multiplier", 3).alias("avg_surge"),
        exact_mean(F.when(done, F.col("distance_km")), 2).alias("avg_distance_km"),
        exact_mean(F.when(done, F.col("duration_min")), 2).alias("avg_duration_min"),
        F.count_distinct("rider_id").alias("unique_riders"),
        F.count_distinct("driver_id").alias("unique_drivers"),
    )
    labels = cities.select("city_id", "city_name", "country")
    return by_city.join(labels, "city_id", "left").select(
        "day", "city_id", "city_name", "country", "total_rides", "completed_rides", "cancelled_rides",
        percent("cancelled_rides", "total_rides").alias("cancellation_rate_pct"), "gross_fare",
        "avg_surge", "avg_distance_km", "avg_duration_min", "unique_riders", "unique_drivers",
    )


def driver_earnings_daily(payouts: DataFrame, drivers: DataFrame, ratings: DataFrame) -> DataFrame:
    """Driver and day: payouts with the ratings received from riders that day."""
    received = (
        ratings.where(F.col("rater_role") == "rider")
        .groupBy("driver_id", F.col("rating_date").alias("payout_date"))
        .agg(F.avg("score").alias("avg_rating_received"), F.count(F.lit(1)).alias("ratings_received"))
    )
    names = drivers.select("driver_id", F.col("full_name").alias("driver_name"), "city_name")
    return (
        payouts.join(received, ["driver_id", "payout_date"], "left")
        .join(names, "driver_id", "left")
        .select(
            F.col("payout_date").alias("day"), "driver_id", "driver_name", "city_id", "city_name",
            "rides_count", "gross_amount", "commission", "net_amount", "avg_fare_per_ride", "currency",
            "avg_rating_received", "ratings_received",
        )
    )


def rider_lifetime_value(rides: DataFrame, payments: DataFrame, riders: DataFrame) -> DataFrame:
    rode = rides.groupBy("rider_id").agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.count_if("is_completed").alias("completed_rides"),
        F.count_if("is_cancelled").alias("cancelled_rides"),
        F.min("ride_date").alias("first_ride_date"),
        F.max("ride_date").alias("last_ride_date"),
        exact_mean(F.when(F.col("is_completed"), F.col("distance_km")), 2).alias("avg_distance_km"),
    )
    captured = F.when(F.col("status") == "captured", F.col("amount"))
    paid = payments.groupBy("rider_id").agg(
        sum_or_zero(captured).alias("total_spend"), exact_mean(captured, 2).alias("avg_fare")
    )
    return rider_value(rode, paid, riders)


def rider_value(rode: DataFrame, paid: DataFrame, riders: DataFrame) -> DataFrame:
    """The mart from the riders' totals, however they were had."""
    names = riders.select("rider_id", F.col("full_name").alias("rider_name"), "city_name", "country")
    return rode.join(paid, "rider_id", "left").join(names, "rider_id", "left").select(
        "rider_id", "rider_name", "city_name", "country", "total_rides", "completed_rides",
        "cancelled_rides", percent("cancelled_rides", "total_rides").alias("cancellation_rate_pct"),
        "total_spend", "avg_fare", "avg_distance_km", "first_ride_date", "last_ride_date",
    )


def surge_pricing_analysis(rides: DataFrame, cities: DataFrame, categories: DataFrame) -> DataFrame:
    by_tier = rides.groupBy(F.col("ride_date").alias("day"), "city_id", "category_id").agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.count_if("is_surge").alias("surge_rides"),
        exact_mean("surge_multiplier", 3).alias("avg_surge_multiplier"),
        F.max("surge_multiplier").alias("max_surge_multiplier"),
        sum_or_zero("surge_amount").alias("surge_revenue"),
        sum_or_zero("total_fare").alias("gross_fare"),
    )
    tiers = categories.select("category_id", F.col("code").alias("category_code"))
    return (
        by_tier.join(cities.select("city_id", "city_name"), "city_id", "left")
        .join(tiers, "category_id", "left")
        .select(
            "day", "city_id", "city_name", "category_id", "category_code", "total_rides", "surge_rides",
            percent("surge_rides", "total_rides").alias("surge_ride_pct"), "avg_surge_multiplier",
            "max_surge_multiplier", "surge_revenue", "gross_fare",
        )
    )


# --- source-side roll-ups -----------------------------------------------------


def rate_fares(rides: DataFrame, categories: DataFrame) -> DataFrame:
    """Completed rides with their fare: metered subtotal x surge, at least the minimum."""
    rates = categories.select("category_id", "base_fare", "per_km_rate", "per_min_rate", "min_fare")
    priced = rides.where(F.col("status") == "completed").join(rates, "category_id")
    by_km = F.col("per_km_rate") * F.col("distance_km")
    by_min = F.col("per_min_rate") * F.col("duration_min")
    fare = F.greatest((F.col("base_fare") + by_km + by_min) * F.col("surge_multiplier"), F.col("min_fare"))
    metered = F.col("base_fare") + F.col("distance_fare") + F.col("time_fare")
    return (
        priced.withColumn("distance_fare", F.round(by_km, 2))
        .withColumn("time_fare", F.round(by_min, 2))
        .withColumn("total_fare", F.round(fare, 2))
        .withColumn("surge_amount", F.round(metered * (F.col("surge_multiplier") - 1), 2))
        .select(
            "ride_id", "driver_id", "rider_id", "city_id", "category_id", "base_fare", "distance_fare",
            "time_fare", "surge_amount", "total_fare", "completed_at",
        )
    )


def driver_payouts(fares: DataFrame, driver: str, day: str, amount: str) -> DataFrame:
    """Gross, commission and net per driver and day of completed rides."""
    gross = F.round(F.sum(amount), 2)
    rate = F.lit(COMMISSION_RATE).cast("decimal(3,2)")
    return (
        fares.groupBy(F.col(driver).alias("driver_id"), F.col(day).alias("payout_date"))
        .agg(gross.alias("gross_amount"), F.count(F.lit(1)).alias("rides_count"))
        .withColumn("commission", F.round(F.col("gross_amount") * rate, 2))
        .withColumn("net_amount", F.col("gross_amount") - F.col("commission"))
        .select("driver_id", "payout_date", "gross_amount", "commission", "net_amount", "rides_count")
    )


def active_cities(riders: DataFrame, drivers: DataFrame, vehicles: DataFrame, day: dt.date | str) -> DataFrame:
    """Cities that on a day have riders and drivers with a vehicle, with both counts."""
    on = as_date(day)
    riding = riders.where(F.to_date("created_at") <= on).groupBy("city_id").agg(
        F.count(F.lit(1)).alias("eligible_riders")
    )
    equipped = vehicles.where(F.to_date("registered_at") <= on).select("driver_id")
    driving = (
        drivers.where(F.to_date("onboarded_at") <= on)
        .join(equipped, "driver_id", "left_semi")
        .groupBy("city_id")
        .agg(F.count(F.lit(1)).alias("eligible_drivers"))
    )
    return riding.join(driving, "city_id")
