import datetime as dt
from decimal import Decimal as M

from tidemark.plans import identity, payments, rides, sensors

TS = dt.datetime(2024, 2, 1)
D = dt.date(2024, 1, 10)
FACT = "payment_id string, payment_date date, customer_id string, merchant_id string, amount decimal(14,2), status string"
REFUND = "refund_id string, refund_date date, payment_id string, amount decimal(14,2)"
FEE = "fee_id string, fee_date date, payment_id string, amount decimal(14,2)"
MERCHANT = "merchant_id string, name string, category_code string"


def day_facts(spark):
    facts = [
        ("p1", D, "c1", "m1", M("10.00"), "completed"), ("p2", D, "c1", "m1", M("0.01"), "failed"),
        ("p3", D, "c2", "m2", M("5.00"), "pending"), ("p4", D, None, "m2", M("0.01"), "completed"),
    ]
    return spark.createDataFrame(facts, FACT)


def test_daily_payment_summary_without_refunds(spark):
    none = spark.createDataFrame([], REFUND)
    row = payments.daily_payment_summary(day_facts(spark), none, spark.createDataFrame([], FEE), TS).first()
    assert (row.total_payments, row.total_volume, row.successful_count, row.failed_count) == (4, M("15.02"), 2, 1)
    assert (row.success_rate_pct, row.refund_volume, row.fee_volume, row.net_revenue) == (50.0, 0, 0, M("15.02"))
    assert row.unique_customers == 2  # NULL is not a customer
    assert row.avg_amount == M("3.76")  # 3.755 to the even cent


def test_average_half_cent_goes_to_even(spark):
    facts = spark.createDataFrame(
        [("a", D, "c", "m", M("0.01"), "x"), ("b", D, "c", "m", M("0.04"), "x")], FACT
    )
    row = payments.daily_payment_summary(
        facts, spark.createDataFrame([], REFUND), spark.createDataFrame([], FEE), TS
    ).first()
    assert row.avg_amount == M("0.02")  # 0.025


def test_merchant_revenue_subtracts_own_day_only(spark):
    refunds = spark.createDataFrame(
        [("r1", D, "p1", M("2.00")), ("r2", D, "p1", M("1.00")), ("r3", D, "old", M("9.00")),
         ("r4", D + dt.timedelta(days=1), "p3", M("4.00"))], REFUND
    )
    fees = spark.createDataFrame([("f1", D, "p1", M("0.30"))], FEE)
    merchants = spark.createDataFrame([("m1", "One", "fuel")], MERCHANT)
    got = payments.daily_revenue_by_merchant(day_facts(spark), refunds, fees, merchants, TS).orderBy("merchant_id").collect()
    assert [(r.merchant_id, r.merchant_name, r.net_revenue, r.txn_count) for r in got] == [
        ("m1", "One", M("6.71"), 2), ("m2", None, M("5.01"), 2),
    ]


def test_lifetime_value_of_zero_spend(spark):
    facts = spark.createDataFrame([("p", D, "c1", "m", M("0.00"), "failed")], FACT)
    refunds = spark.createDataFrame([("r", D, "p", M("1.00"))], REFUND)
    people = spark.createDataFrame(
        [("c1", "Ada", None, "EE", "<25")],
        "customer_id string, first_name string, last_name string, country string, age_band string",
    )
    row = payments.customer_lifetime_value(facts, refunds, people, TS).first()
    assert (row.refund_rate_pct, row.total_refunds, row.full_name, row.active_days) == (0.0, M("1.00"), None, 1)


def test_fee_rates(spark):
    df = spark.createDataFrame(
        [("processing", M("10.00")), ("interchange", M("10.00")), ("scheme", M("0.05")), ("other", M("1.00"))],
        "fee_type string, amount decimal(14,2)",
    )
    assert [r.fee_amount for r in payments.rate_fees(df).coalesce(1).collect()] == [
        M("0.2900"), M("0.1800"), M("0.0002"), None,
    ]


def test_payout_without_rides(spark):
    payouts = spark.createDataFrame(
        [("a", "d1", D, M("10.00"), M("2.00"), M("8.00"), "EUR", 3, "x"),
         ("b", "d2", D, M("0.00"), M("0.00"), M("0.00"), "EUR", 0, "x")],
        """payout_id string, driver_id string, payout_date date, gross_amount decimal(12,2), commission decimal(12,2),
        net_amount decimal(12,2), currency string, rides_count int, status string""",
    )
    drivers = spark.createDataFrame([("d1", "city")], "driver_id string, city_id string")
    got = rides.fact_driver_payouts(payouts, drivers).orderBy("payout_id").collect()
    assert [(r.avg_fare_per_ride, r.city_id) for r in got] == [(M("3.33"), "city"), (M("0.00"), None)]


def test_city_performance_of_cancelled_rides(spark):
    facts = spark.createDataFrame(
        [(D, "c", True, False, None, M("1.20"), M("2.00"), M("5.00"), "r1", "d1"),
         (D, "c", False, True, None, M("1.00"), None, None, "r1", "d2"),
         (D, "c", False, False, None, M("1.00"), None, None, "r2", "d2")],
        """ride_date date, city_id string, is_completed boolean, is_cancelled boolean, total_fare decimal(10,2),
        surge_multiplier decimal(4,2), distance_km decimal(8,2), duration_min decimal(8,2), rider_id string,
        driver_id string""",
    )
    cities = spark.createDataFrame([("c", "Riga", "LV")], "city_id string, city_name string, country string")
    row = rides.daily_city_performance(facts, cities).first()
    assert (row.total_rides, row.completed_rides, row.cancelled_rides) == (3, 1, 1)
    assert (row.cancellation_rate_pct, row.gross_fare, row.avg_surge) == (M("33.33"), 0, M("1.067"))
    assert (row.avg_distance_km, row.unique_riders, row.unique_drivers) == (M("2.00"), 2, 2)


def test_minimum_fare(spark):
    trips = spark.createDataFrame(
        [("a", "d", "r", "c", "k", "completed", M("1.00"), M("2.00"), M("1.00")),
         ("b", "d", "r", "c", "k", "completed", M("10.00"), M("20.00"), M("1.50")),
         ("x", "d", "r", "c", "k", "cancelled", None, None, M("1.00"))],
        """ride_id string, driver_id string, rider_id string, city_id string, category_id string, status string,
        distance_km decimal(8,2), duration_min decimal(8,2), surge_multiplier decimal(4,2)""",
    ).selectExpr("*", "timestamp '2024-01-10' AS completed_at")
    rates = spark.createDataFrame(
        [("k", M("1.00"), M("0.50"), M("0.10"), M("4.00"))],
        """category_id string, base_fare decimal(8,2), per_km_rate decimal(8,2), per_min_rate decimal(8,2),
        min_fare decimal(8,2)""",
    )
    got = rides.rate_fares(trips, rates).orderBy("ride_id").collect()
    assert [(r.ride_id, r.total_fare, r.surge_amount) for r in got] == [
        ("a", M("4.00"), M("0.00")), ("b", M("12.00"), M("4.00")),
    ]


def coins(spark, data):
    return spark.createDataFrame(
        data,
        """day date, coin_id string, market_cap_usd double, total_volume_usd double,
        price_change_percentage_24h double""",
    )


def test_movers_ties_and_nothing_known(spark):
    tied = coins(spark, [(D, "b", 1.0, 5.0, 3.0), (D, "a", 2.0, 5.0, 3.0), (D, "c", None, None, -1.0)])
    row = sensors.crypto_market_daily(tied, TS).first()
    assert (row.coin_count, row.total_market_cap_usd, row.total_volume_usd) == (3, 3.0, 10.0)
    assert (row.top_gainer_coin_id, row.top_loser_coin_id, row.highest_volume_coin_id) == ("a", "c", "a")
    empty = sensors.crypto_market_daily(coins(spark, [(D, "a", None, None, None)]), TS).first()
    assert (empty.total_market_cap_usd, empty.top_gainer_coin_id, empty.highest_volume_usd) == (0.0, None, None)


def test_earthquake_day_with_unknown_significance(spark):
    events = spark.createDataFrame(
        [("e1", D, 1.0, 5.0, None, 700, "x", "micro"), ("e2", D, 8.1, 5.0, 1, 700, "y", "great"),
         ("e3", D, None, None, 1, None, "z", None)],
        """event_id string, event_date date, mag double, depth_km double, tsunami int, sig int, place string,
        magnitude_class string""",
    )
    row = sensors.earthquake_daily(events).first()
    assert (row.total_count, row.tsunami_count, row.significant_count) == (3, 2, 2)
    assert (row.micro_count, row.great_count, row.minor_count) == (1, 1, 0)
    assert (row.most_significant_place, row.most_significant_magnitude) == ("y", 8.1)


def test_zero_coverage_correction_removes_the_hour(spark):
    hour = dt.datetime(2024, 1, 10, 5)
    base = (1, 2, "L", "AZ", 1.0, 1.0, "pm25", "u", hour)
    data = [
        (*base, 4.0, 1.0, 2.0, 90.0, TS, D), (*base, 4.0, 1.0, 2.0, 0.0, TS + dt.timedelta(hours=1), D),
        (9, *base[1:], 4.0, 1.0, 2.0, None, TS, D), (7, *base[1:], 4.0, 1.0, 2.0, 50.0, TS, D),
    ]
    bronze = spark.createDataFrame(
        data,
        """sensor_id int, location_id int, location_name string, country_code string, latitude double, longitude double,
        parameter_name string, parameter_units string, hour_utc timestamp, value double, summary_min double,
        summary_max double, percent_coverage double, ingest_ts timestamp, logical_date date""",
    )
    got = sensors.airquality_hourly(bronze).collect()
    assert [(r.sensor_id, r.hour_of_day, r.measurement_date) for r in got] == [(7, 5, D)]


def test_session_lengths(spark):
    at = dt.datetime(2024, 1, 10, 12)
    h = dt.timedelta(hours=1)
    df = spark.createDataFrame(
        [("s1", "u", at, at + h, None, " password ", None, None), ("s2", "u", at, at + h, at - h, "mfa_sms", None, None)],
        """session_id string, user_id string, created_at timestamp, expires_at timestamp, revoked_at timestamp,
        auth_method string, ip_address string, user_agent string""",
    )
    got = identity.clean(df, "sessions").orderBy("session_id").collect()
    assert [(r.auth_method, r.is_active, r.was_revoked, r.session_duration_seconds) for r in got] == [
        ("PASSWORD", True, False, 3600), ("MFA_SMS", False, True, 0),
    ]
