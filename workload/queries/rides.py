"""Ride-hailing: staging, silver, gold and roll-ups over lineitem, customer, supplier, part, nation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.keyed import latest_per_key
from tidemark.plans import rides as plan
from workload.frames import Frames
from workload.registry import latest, mean, pct, query

TIE = ["vehicle_id", "driver_id"]
NEWEST = "ingest_ts DESC, vehicle_id DESC, driver_id DESC"

CITIES = latest("ride_cities", "city_id", "ingest_ts DESC")
CATEGORIES = latest("ride_categories", "category_id", "ingest_ts DESC")
RIDERS = latest("ride_riders", "rider_id", "ingest_ts DESC")
DRIVERS = latest("ride_drivers", "driver_id", "ingest_ts DESC")
VEHICLES = latest("ride_vehicles", "vehicle_id", "ingest_ts DESC")
RIDES = latest("ride_rides", "ride_id", NEWEST)
FARES = latest("ride_fares", "fare_id", NEWEST)
PAYMENTS = latest("ride_payments", "payment_id", "ingest_ts DESC, rider_id DESC, driver_id DESC")
RATINGS = latest("ride_ratings", "rating_id", NEWEST)
PAYOUTS = latest("ride_payouts", "payout_id", "ingest_ts DESC")

FACT_RIDES = f"""(SELECT r.*, CAST(requested_at AS DATE) AS ride_date, total_fare, surge_amount, discount, currency,
    status = 'completed' AS is_completed, status = 'cancelled' AS is_cancelled, surge_multiplier > 1 AS is_surge,
    ((2 * 100 * date_diff('second', requested_at, accepted_at) + 60) // 120) / 100 AS wait_min
    FROM {RIDES} r LEFT JOIN (SELECT ride_id, total_fare, surge_amount, discount, currency FROM {FARES}) f
    ON r.ride_id = f.ride_id)"""
FACT_PAYMENTS = f"""(SELECT p.payment_id, CAST(p.created_at AS DATE) AS payment_date, p.ride_id, p.rider_id, r.driver_id,
    r.city_id, r.category_id, p.method, p.amount, p.currency, p.status, p.status = 'captured' AS is_captured,
    p.status = 'refunded' AS is_refunded FROM {PAYMENTS} p LEFT JOIN {RIDES} r ON p.ride_id = r.ride_id)"""
FACT_RATINGS = f"""(SELECT t.rating_id, CAST(t.created_at AS DATE) AS rating_date, t.ride_id, r.rider_id, r.driver_id,
    r.city_id, r.category_id, t.rater_role, t.score, t.comment FROM {RATINGS} t LEFT JOIN {RIDES} r
    ON t.ride_id = r.ride_id)"""


def staged(f: Frames, table: str):
    view = {"vehicle_categories": "ride_categories", "driver_payouts": "ride_payouts",
            "ride_payments": "ride_payments"}.get(table, f"ride_{table}")
    tie = {"rides": TIE, "fares": TIE, "ratings": TIE, "ride_payments": ["rider_id", "driver_id"]}.get(table, [])
    return plan.staging(getattr(f, view), table, tie)


def cities(f):
    return plan.dim_city(staged(f, "cities"))


def fact_rides_of(f):
    return plan.fact_rides(staged(f, "rides"), staged(f, "fares"))


def drivers(f):
    return plan.dim_driver(staged(f, "drivers"), cities(f))


def ratings(f):
    return plan.fact_ratings(staged(f, "ratings"), staged(f, "rides"))


def payouts(f):
    return plan.fact_driver_payouts(staged(f, "driver_payouts"), staged(f, "drivers"))


@query("city_id city_name country timezone launched_at:t", f"SELECT *, name AS city_name FROM {CITIES}")
def stg_cities(f: Frames):
    return staged(f, "cities")


@query(
    "category_id code display_name base_fare:n per_km_rate:n per_min_rate:n min_fare:n",
    f"SELECT * FROM {CATEGORIES}",
)
def stg_vehicle_categories(f: Frames):
    return staged(f, "vehicle_categories")


@query("rider_id first_name last_name email phone city_id rating:n created_at:t", f"SELECT * FROM {RIDERS}")
def stg_riders(f: Frames):
    return staged(f, "riders")


@query(
    "driver_id first_name last_name email phone city_id license_number status rating:n onboarded_at:t",
    f"SELECT * FROM {DRIVERS}",
)
def stg_drivers(f: Frames):
    return staged(f, "drivers")


@query(
    "vehicle_id driver_id category_id make model year:i plate_number color registered_at:t",
    f"SELECT * FROM {VEHICLES}",
)
def stg_vehicles(f: Frames):
    return staged(f, "vehicles")


@query(
    """ride_id rider_id driver_id vehicle_id city_id category_id status requested_at:t accepted_at:t started_at:t
    completed_at:t pickup_lat:n pickup_lng:n dropoff_lat:n dropoff_lng:n distance_km:n duration_min:n
    surge_multiplier:n cancelled_by created_at:t updated_at:t""",
    f"SELECT * FROM {RIDES}",
)
def stg_rides(f: Frames):
    return staged(f, "rides")


@query(
    """fare_id ride_id base_fare:n distance_fare:n time_fare:n surge_amount:n discount:n total_fare:n currency
    created_at:t""",
    f"SELECT * FROM {FARES}",
)
def stg_fares(f: Frames):
    return staged(f, "fares")


@query(
    "payment_id ride_id rider_id method amount:n currency status created_at:t updated_at:t",
    f"SELECT * FROM {PAYMENTS}",
)
def stg_ride_payments(f: Frames):
    return staged(f, "ride_payments")


@query("rating_id ride_id rater_role score:i comment created_at:t", f"SELECT * FROM {RATINGS}")
def stg_ratings(f: Frames):
    return staged(f, "ratings")


@query(
    """payout_id driver_id payout_date:d gross_amount:n commission:n net_amount:n currency rides_count:i status
    created_at:t""",
    f"SELECT * FROM {PAYOUTS}",
)
def stg_driver_payouts(f: Frames):
    return staged(f, "driver_payouts")


@query(
    "city_id city_name country timezone launched_at:t launched_date:d",
    f"SELECT *, name AS city_name, CAST(launched_at AS DATE) AS launched_date FROM {CITIES}",
)
def dim_city(f: Frames):
    return cities(f)


@query(
    "category_id code display_name base_fare:n per_km_rate:n per_min_rate:n min_fare:n",
    f"SELECT * FROM {CATEGORIES}",
)
def dim_vehicle_category(f: Frames):
    return plan.dim_vehicle_category(staged(f, "vehicle_categories"))


@query(
    "rider_id full_name email phone city_id city_name country rating:n created_at:t signup_date:d",
    f"""SELECT r.rider_id, r.first_name || ' ' || r.last_name AS full_name, r.email, r.phone, r.city_id,
        c.name AS city_name, c.country, r.rating, r.created_at, CAST(r.created_at AS DATE) AS signup_date
        FROM {RIDERS} r LEFT JOIN {CITIES} c ON r.city_id = c.city_id""",
)
def dim_rider(f: Frames):
    return plan.dim_rider(staged(f, "riders"), cities(f))


@query(
    "driver_id full_name email city_id city_name country license_number status rating:n onboarded_date:d",
    f"""SELECT d.driver_id, d.first_name || ' ' || d.last_name AS full_name, d.email, d.city_id, c.name AS city_name,
        c.country, d.license_number, d.status, d.rating, CAST(d.onboarded_at AS DATE) AS onboarded_date
        FROM {DRIVERS} d LEFT JOIN {CITIES} c ON d.city_id = c.city_id""",
)
def dim_driver(f: Frames):
    return drivers(f)


@query(
    """vehicle_id driver_id category_id category_code category_name make model make_model year:i plate_number color
    registered_at:t""",
    f"""SELECT v.*, v.make || ' ' || v.model AS make_model, k.code AS category_code,
        k.display_name AS category_name FROM {VEHICLES} v LEFT JOIN
        (SELECT category_id AS id, code, display_name FROM {CATEGORIES}) k ON v.category_id = k.id""",
)
def dim_vehicle(f: Frames):
    return plan.dim_vehicle(staged(f, "vehicles"), staged(f, "vehicle_categories"))


@query(
    "date_day:d year:i quarter:i month:i day:i day_of_week:i day_name iso_week:i is_weekend:b",
    f"""SELECT date_day, year(date_day) AS year, quarter(date_day) AS quarter, month(date_day) AS month,
        day(date_day) AS day, isodow(date_day) AS day_of_week, dayname(date_day) AS day_name,
        week(date_day) AS iso_week, isodow(date_day) IN (6, 7) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
            FROM (SELECT CAST(MIN(requested_at) AS DATE) AS lo, CAST(MAX(requested_at) AS DATE) AS hi FROM {RIDES}))""",
)
def dim_date_observed(f: Frames):
    return plan.dim_date(staged(f, "rides"))


@query(
    """ride_id ride_date:d rider_id driver_id vehicle_id city_id category_id status cancelled_by requested_at:t
    accepted_at:t started_at:t completed_at:t distance_km:n duration_min:n surge_multiplier:n total_fare:n
    surge_amount:n discount:n currency wait_min:n is_completed:b is_cancelled:b is_surge:b""",
    f"SELECT * FROM {FACT_RIDES}",
)
def fact_rides(f: Frames):
    return fact_rides_of(f)


@query(
    """payment_id payment_date:d ride_id rider_id driver_id city_id category_id method amount:n currency status
    is_captured:b is_refunded:b""",
    f"SELECT * FROM {FACT_PAYMENTS}",
)
def fact_ride_payments(f: Frames):
    return plan.fact_ride_payments(staged(f, "ride_payments"), staged(f, "rides"))


@query(
    "rating_id rating_date:d ride_id rider_id driver_id city_id category_id rater_role score:i comment",
    f"SELECT * FROM {FACT_RATINGS}",
)
def fact_ratings(f: Frames):
    return ratings(f)


@query(
    """payout_id payout_date:d driver_id city_id gross_amount:n commission:n net_amount:n currency rides_count:i
    status avg_fare_per_ride:n""",
    f"""SELECT p.*, d.city_id, CASE WHEN rides_count > 0 THEN
        ((200 * CAST(gross_amount * 100 AS BIGINT) + 100 * rides_count) // (200 * rides_count)) / 100
        ELSE 0 END AS avg_fare_per_ride
        FROM {PAYOUTS} p LEFT JOIN (SELECT driver_id AS id, city_id FROM {DRIVERS}) d ON p.driver_id = d.id""",
)
def fact_driver_payouts(f: Frames):
    return payouts(f)


@query(
    """day:d city_id city_name country total_rides:i completed_rides:i cancelled_rides:i cancellation_rate_pct:n
    gross_fare:n avg_surge:n avg_distance_km:n avg_duration_min:n unique_riders:i unique_drivers:i""",
    f"""SELECT ride_date AS day, r.city_id, c.name AS city_name, c.country, COUNT(*) AS total_rides,
        SUM(is_completed::INT) AS completed_rides, SUM(is_cancelled::INT) AS cancelled_rides,
        {pct('SUM(is_cancelled::INT)', 'COUNT(*)')} AS cancellation_rate_pct,
        COALESCE(SUM(total_fare), 0) AS gross_fare, {mean('surge_multiplier', 2, 3)} AS avg_surge,
        {mean('CASE WHEN is_completed THEN distance_km END', 2, 2)} AS avg_distance_km,
        {mean('CASE WHEN is_completed THEN duration_min END', 2, 2)} AS avg_duration_min,
        COUNT(DISTINCT rider_id) AS unique_riders, COUNT(DISTINCT driver_id) AS unique_drivers
        FROM {FACT_RIDES} r LEFT JOIN {CITIES} c ON r.city_id = c.city_id GROUP BY 1, 2, 3, 4""",
)
def city_performance(f: Frames):
    return plan.daily_city_performance(fact_rides_of(f), cities(f))


@query(
    """day:d driver_id driver_name city_id city_name rides_count:i gross_amount:n commission:n net_amount:n
    currency avg_rating_received:n ratings_received:n""",
    f"""WITH t AS (SELECT driver_id, rating_date, SUM(score) / COUNT(*) AS avg_rating_received,
            COUNT(*) AS ratings_received FROM {FACT_RATINGS} WHERE rater_role = 'rider' GROUP BY 1, 2),
        d AS (SELECT driver_id, first_name || ' ' || last_name AS driver_name, d.city_id, c.name AS city_name
            FROM {DRIVERS} d LEFT JOIN {CITIES} c ON d.city_id = c.city_id)
        SELECT payout_date AS day, p.driver_id, driver_name, city_id, city_name, rides_count, gross_amount, commission,
            net_amount, currency, avg_rating_received, ratings_received
        FROM {PAYOUTS} p LEFT JOIN d ON p.driver_id = d.driver_id
        LEFT JOIN t ON p.driver_id = t.driver_id AND p.payout_date = t.rating_date""",
)
def driver_earnings(f: Frames):
    return plan.driver_earnings_daily(payouts(f), drivers(f), ratings(f))


RIDER_VALUE = """rider_id rider_name city_name country total_rides:i completed_rides:i cancelled_rides:i
    cancellation_rate_pct:n total_spend:n avg_fare:n avg_distance_km:n first_ride_date:d last_ride_date:d"""
RIDER_VALUE_SQL = f"""WITH r AS (SELECT rider_id, COUNT(*) AS total_rides, SUM(is_completed::INT) AS completed_rides,
            SUM(is_cancelled::INT) AS cancelled_rides, MIN(ride_date) AS first_ride_date,
            MAX(ride_date) AS last_ride_date,
            {mean('CASE WHEN is_completed THEN distance_km END', 2, 2)} AS avg_distance_km
            FROM {FACT_RIDES} GROUP BY 1),
        p AS (SELECT rider_id, COALESCE(SUM(CASE WHEN is_captured THEN amount END), 0) AS total_spend,
            {mean('CASE WHEN is_captured THEN amount END', 2, 2)} AS avg_fare FROM {FACT_PAYMENTS} GROUP BY 1)
        SELECT r.*, {pct('cancelled_rides', 'total_rides')} AS cancellation_rate_pct, total_spend, avg_fare,
            d.first_name || ' ' || d.last_name AS rider_name, c.name AS city_name, c.country
        FROM r LEFT JOIN p ON r.rider_id = p.rider_id LEFT JOIN {RIDERS} d ON r.rider_id = d.rider_id
        LEFT JOIN {CITIES} c ON d.city_id = c.city_id"""


@query(RIDER_VALUE, RIDER_VALUE_SQL)
def rider_ltv(f: Frames):
    """The mart needs neither fares nor the payments' rides, so it is fed from what it uses."""
    rides, riders = plan.ride_states(staged(f, "rides")), plan.dim_rider(staged(f, "riders"), cities(f))
    return plan.rider_lifetime_value(rides, staged(f, "ride_payments"), riders)


@query(
    """day:d city_id city_name category_id category_code total_rides:i surge_rides:i surge_ride_pct:n
    avg_surge_multiplier:n max_surge_multiplier:n surge_revenue:n gross_fare:n""",
    f"""SELECT ride_date AS day, r.city_id, c.name AS city_name, r.category_id, k.code AS category_code,
        COUNT(*) AS total_rides, SUM(is_surge::INT) AS surge_rides,
        {pct('SUM(is_surge::INT)', 'COUNT(*)')} AS surge_ride_pct,
        {mean('surge_multiplier', 2, 3)} AS avg_surge_multiplier, MAX(surge_multiplier) AS max_surge_multiplier,
        COALESCE(SUM(surge_amount), 0) AS surge_revenue, COALESCE(SUM(total_fare), 0) AS gross_fare
        FROM {FACT_RIDES} r LEFT JOIN {CITIES} c ON r.city_id = c.city_id
        LEFT JOIN {CATEGORIES} k ON r.category_id = k.category_id GROUP BY 1, 2, 3, 4, 5""",
)
def surge_pricing(f: Frames):
    return plan.surge_pricing_analysis(fact_rides_of(f), cities(f), staged(f, "vehicle_categories"))


@query(
    "ride_id driver_id city_id category_id base_fare:n distance_fare:n time_fare:n surge_amount:n total_fare:n",
    f"""WITH p AS (SELECT r.ride_id, r.driver_id, r.city_id, r.category_id,
            CAST(k.base_fare * 100 AS BIGINT) AS b, CAST(k.per_km_rate * 100 * r.distance_km * 100 AS BIGINT) AS km,
            CAST(k.per_min_rate * 100 * r.duration_min * 100 AS BIGINT) AS mi,
            CAST(r.surge_multiplier * 100 AS BIGINT) AS s, CAST(k.min_fare * 100 AS BIGINT) AS least
            FROM {RIDES} r JOIN {CATEGORIES} k ON r.category_id = k.category_id WHERE r.status = 'completed')
        SELECT ride_id, driver_id, city_id, category_id, b / 100 AS base_fare, ((km + 50) // 100) / 100 AS distance_fare,
            ((mi + 50) // 100) / 100 AS time_fare,
            (((b + (km + 50) // 100 + (mi + 50) // 100) * (s - 100) + 50) // 100) / 100 AS surge_amount,
            greatest(((b * 100 + km + mi) * s + 5000) // 10000, least) / 100 AS total_fare FROM p""",
)
def fare_rating(f: Frames):
    return plan.rate_fares(staged(f, "rides"), staged(f, "vehicle_categories"))


@query(
    "driver_id payout_date:d gross_amount:n commission:n net_amount:n rides_count:i",
    f"""SELECT driver_id, payout_date, g / 100 AS gross_amount, ((20 * g + 50) // 100) / 100 AS commission,
        (g - (20 * g + 50) // 100) / 100 AS net_amount, rides_count
        FROM (SELECT driver_id, CAST(ingest_ts AS DATE) AS payout_date, CAST(SUM(total_fare) * 100 AS BIGINT) AS g,
            COUNT(*) AS rides_count FROM {FARES} GROUP BY 1, 2)""",
)
def driver_payouts(f: Frames):
    fresh = latest_per_key(f.ride_fares, ["fare_id"], [F.desc("ingest_ts"), F.desc("vehicle_id"), F.desc("driver_id")])
    return plan.driver_payouts(fresh.withColumn("day", F.to_date("ingest_ts")), "driver_id", "day", "total_fare")


@query(
    "city_id eligible_riders:i eligible_drivers:i",
    f"""WITH r AS (SELECT city_id, COUNT(*) AS eligible_riders FROM {RIDERS}
            WHERE CAST(created_at AS DATE) <= DATE '1995-01-15' GROUP BY 1),
        d AS (SELECT city_id, COUNT(*) AS eligible_drivers FROM {DRIVERS}
            WHERE CAST(onboarded_at AS DATE) <= DATE '1995-01-15' AND driver_id IN
            (SELECT driver_id FROM {VEHICLES} WHERE CAST(registered_at AS DATE) <= DATE '1995-01-15') GROUP BY 1)
        SELECT r.city_id, eligible_riders, eligible_drivers FROM r JOIN d ON r.city_id = d.city_id""",
)
def active_cities(f: Frames):
    return plan.active_cities(staged(f, "riders"), staged(f, "drivers"), staged(f, "vehicles"), "1995-01-15")
