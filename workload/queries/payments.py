"""Payments: silver, gold and roll-ups over orders, lineitem, customer and supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import payments as plan
from workload.frames import RUN_TS, Frames
from workload.registry import latest, mean, query

DAY = "2001-08-01"
NEWEST = "logical_date DESC, ingest_ts DESC"

CUSTOMERS = latest("pay_customers", "customer_id", NEWEST)
MERCHANTS = latest("pay_merchants", "merchant_id", NEWEST)
METHODS = latest("pay_methods", "method_id", NEWEST)
PAYMENTS = latest("pay_payments", "payment_id", NEWEST)
REFUNDS = latest("pay_refunds", "refund_id", f"{NEWEST}, reason DESC")
FEES = latest("pay_fees", "fee_id", NEWEST)
SETTLEMENTS = latest("pay_settlements", "settlement_id", NEWEST)

AGE = f"""(2001 - year(birthdate) - CASE WHEN month(birthdate) > 8 OR (month(birthdate) = 8 AND day(birthdate) > 1)
    THEN 1 ELSE 0 END)"""
BAND = f"""CASE WHEN birthdate IS NULL THEN NULL WHEN {AGE} <= 24 THEN '<25' WHEN {AGE} BETWEEN 25 AND 34 THEN '25-34'
    WHEN {AGE} BETWEEN 35 AND 44 THEN '35-44' WHEN {AGE} BETWEEN 45 AND 54 THEN '45-54' ELSE '55+' END"""


def payments(f: Frames):
    return plan.fact_payments(f.pay_payments)


def refunds(f: Frames):
    return plan.fact_refunds(f.pay_refunds, tie=["reason"])


def fees(f: Frames):
    return plan.fact_fees(f.pay_fees)


def merchants(f: Frames):
    return plan.dim_merchant(f.pay_merchants, RUN_TS)


def customers(f: Frames):
    return plan.dim_customer(f.pay_customers, DAY, RUN_TS)


@query(
    "customer_id first_name last_name email birthdate:d age_band country city phone created_at:t updated_at:t",
    f"SELECT *, {BAND} AS age_band, TIMESTAMP '2024-02-01' AS updated_at FROM {CUSTOMERS}",
)
def pay_dim_customer(f: Frames):
    return customers(f)


@query(
    "merchant_id name category_code mcc_code country city status created_at:t updated_at:t",
    f"SELECT *, TIMESTAMP '2024-02-01' AS updated_at FROM {MERCHANTS}",
)
def pay_dim_merchant(f: Frames):
    return merchants(f)


@query(
    "method_id customer_id type provider card_brand last4 expiry_month:n expiry_year:n is_default:b is_expired:n",
    f"""SELECT *, expiry_year < 2001 OR (expiry_year = 2001 AND expiry_month < 8) AS is_expired
        FROM {METHODS}""",
)
def pay_dim_payment_method(f: Frames):
    return plan.dim_payment_method(f.pay_methods, DAY, RUN_TS)


@query(
    "date:d day:i month:i quarter:i year:i day_of_week:i day_name is_weekend:b iso_week:i",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, day(o_orderdate) AS day, month(o_orderdate) AS month,
        quarter(o_orderdate) AS quarter, year(o_orderdate) AS year, isodow(o_orderdate) AS day_of_week,
        dayname(o_orderdate) AS day_name, isodow(o_orderdate) >= 6 AS is_weekend, week(o_orderdate) AS iso_week
        FROM {orders}""",
)
def pay_dim_date(f: Frames):
    return plan.dim_date(f.orders.select(F.to_date("o_orderdate").alias("date_day")))


@query(
    """payment_id payment_date:d customer_id merchant_id method_id amount:n currency status error_code description
    reference_id created_at:t updated_at:t settled_at:t settled_lag_hours:n""",
    f"""SELECT *, CAST(created_at AS DATE) AS payment_date,
        date_diff('second', created_at, settled_at) / 3600.0 AS settled_lag_hours FROM {PAYMENTS}""",
)
def pay_fact_payments(f: Frames):
    return payments(f)


@query(
    "refund_id refund_date:d payment_id amount:n currency reason status created_at:t updated_at:t",
    f"SELECT *, CAST(created_at AS DATE) AS refund_date FROM {REFUNDS}",
)
def pay_fact_refunds(f: Frames):
    return refunds(f)


@query(
    "fee_id fee_date:d payment_id fee_type amount:n currency created_at:t",
    f"SELECT *, CAST(created_at AS DATE) AS fee_date FROM {FEES}",
)
def pay_fact_fees(f: Frames):
    return fees(f)


@query(
    "settlement_id settlement_date:d merchant_id amount:n currency payments_count:i status created_at:t",
    f"SELECT * FROM {SETTLEMENTS}",
)
def pay_fact_settlements(f: Frames):
    return plan.fact_settlements(f.pay_settlements)


@query(
    """day:d total_payments:i total_volume:n successful_count:i failed_count:i success_rate_pct:n avg_amount:n
    unique_customers:i unique_merchants:i refund_volume:n fee_volume:n net_revenue:n computed_at:t""",
    f"""
    WITH p AS (SELECT CAST(created_at AS DATE) AS day, COUNT(*) AS total_payments, SUM(amount) AS total_volume,
            SUM((status = 'completed')::INT) AS successful_count, SUM((status = 'failed')::INT) AS failed_count,
            COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT merchant_id) AS unique_merchants,
            CAST(SUM(amount) * 100 AS HUGEINT) AS cents
        FROM {PAYMENTS} GROUP BY 1),
    r AS (SELECT CAST(created_at AS DATE) AS day, SUM(amount) AS refund_volume FROM {REFUNDS} GROUP BY 1),
    f AS (SELECT CAST(created_at AS DATE) AS day, SUM(amount) AS fee_volume FROM {FEES} GROUP BY 1)
    SELECT p.day, total_payments, total_volume, successful_count, failed_count,
        100.0 * successful_count / total_payments AS success_rate_pct,
        (cents // total_payments + CASE WHEN 2 * (cents % total_payments) > total_payments
            OR (2 * (cents % total_payments) = total_payments AND (cents // total_payments) % 2 = 1)
            THEN 1 ELSE 0 END) / 100 AS avg_amount,
        unique_customers, unique_merchants, COALESCE(refund_volume, 0) AS refund_volume,
        COALESCE(fee_volume, 0) AS fee_volume,
        total_volume - COALESCE(refund_volume, 0) - COALESCE(fee_volume, 0) AS net_revenue,
        TIMESTAMP '2024-02-01' AS computed_at
    FROM p LEFT JOIN r ON p.day = r.day LEFT JOIN f ON p.day = f.day
    """,
)
def daily_payment_summary(f: Frames):
    return plan.daily_payment_summary(payments(f), refunds(f), fees(f), RUN_TS)


@query(
    """merchant_id merchant_name category_code day:d gross_volume:n txn_count:i success_count:i refund_amount:n
    fee_amount:n net_revenue:n avg_ticket:n""",
    f"""
    WITH r AS (SELECT payment_id, CAST(created_at AS DATE) AS day, SUM(amount) AS amount FROM {REFUNDS} GROUP BY 1, 2),
    f AS (SELECT payment_id, CAST(created_at AS DATE) AS day, SUM(amount) AS amount FROM {FEES} GROUP BY 1, 2),
    m AS (SELECT p.merchant_id, CAST(p.created_at AS DATE) AS day, SUM(p.amount) AS gross_volume,
            COUNT(*) AS txn_count, SUM((p.status = 'completed')::INT) AS success_count,
            COALESCE(SUM(r.amount), 0) AS refund_amount, COALESCE(SUM(f.amount), 0) AS fee_amount,
            {mean('p.amount', 2, 2)} AS avg_ticket
        FROM {PAYMENTS} p
        LEFT JOIN r ON p.payment_id = r.payment_id AND CAST(p.created_at AS DATE) = r.day
        LEFT JOIN f ON p.payment_id = f.payment_id AND CAST(p.created_at AS DATE) = f.day
        GROUP BY 1, 2)
    SELECT m.*, gross_volume - refund_amount - fee_amount AS net_revenue, d.name AS merchant_name, d.category_code
    FROM m LEFT JOIN {MERCHANTS} d ON m.merchant_id = d.merchant_id
    """,
)
def revenue_by_merchant(f: Frames):
    return plan.daily_revenue_by_merchant(payments(f), refunds(f), fees(f), merchants(f), RUN_TS)


CUSTOMER_VALUE = """customer_id full_name country age_band total_spend:n total_payments:i successful_payments:i
    failed_payments:i total_refunds:n refund_rate_pct:n first_payment_date:d last_payment_date:d active_days:i"""
CUSTOMER_VALUE_SQL = f"""
    WITH r AS (SELECT payment_id, SUM(amount) AS amount FROM {REFUNDS} GROUP BY 1),
    c AS (SELECT p.customer_id, SUM(p.amount) AS total_spend, COUNT(*) AS total_payments,
            SUM((p.status = 'completed')::INT) AS successful_payments,
            SUM((p.status = 'failed')::INT) AS failed_payments, COALESCE(SUM(r.amount), 0) AS total_refunds,
            MIN(CAST(p.created_at AS DATE)) AS first_payment_date,
            MAX(CAST(p.created_at AS DATE)) AS last_payment_date,
            COUNT(DISTINCT CAST(p.created_at AS DATE)) AS active_days
        FROM {PAYMENTS} p LEFT JOIN r ON p.payment_id = r.payment_id GROUP BY 1)
    SELECT c.*, first_name || ' ' || last_name AS full_name, country, {BAND} AS age_band,
        CASE WHEN total_spend > 0 THEN 100.0 * CAST(total_refunds AS DOUBLE) / CAST(total_spend AS DOUBLE)
            ELSE 0 END AS refund_rate_pct
    FROM c LEFT JOIN {CUSTOMERS} d ON c.customer_id = d.customer_id
    """


@query(CUSTOMER_VALUE, CUSTOMER_VALUE_SQL)
def customer_lifetime_value(f: Frames):
    return plan.customer_lifetime_value(payments(f), refunds(f), customers(f), RUN_TS)


@query(
    """merchant_id merchant_name settlement_date:d settled_amount:n settled_payments_count:i
    gross_volume_for_date:n settlement_lag_days:i status""",
    f"""
    WITH g AS (SELECT merchant_id, CAST(created_at AS DATE) AS day, SUM(amount) AS gross FROM {PAYMENTS} GROUP BY 1, 2)
    SELECT s.merchant_id, d.name AS merchant_name, s.settlement_date, s.amount AS settled_amount,
        s.payments_count AS settled_payments_count, COALESCE(g.gross, 0) AS gross_volume_for_date,
        date_diff('day', CAST(s.created_at AS DATE), s.settlement_date) AS settlement_lag_days, s.status
    FROM {SETTLEMENTS} s LEFT JOIN g ON s.merchant_id = g.merchant_id AND s.settlement_date = g.day
    LEFT JOIN {MERCHANTS} d ON s.merchant_id = d.merchant_id
    """,
)
def merchant_settlement_daily(f: Frames):
    settlements = plan.fact_settlements(f.pay_settlements)
    return plan.merchant_settlement_daily(settlements, payments(f), merchants(f), RUN_TS)


@query(
    "merchant_id settlement_date:d amount:n payments_count:i",
    f"""SELECT merchant_id, CAST(created_at AS DATE) AS settlement_date, SUM(amount) AS amount,
        COUNT(*) AS payments_count FROM {PAYMENTS} WHERE status = 'completed' GROUP BY 1, 2""",
)
def settlement_rollup(f: Frames):
    return plan.settlement_rollup(payments(f))


@query(
    "fee_id fee_type fee_amount:n",
    """SELECT fee_id, fee_type, (CAST(base_amount * 100 AS BIGINT) * CASE fee_type WHEN 'processing' THEN 29
        WHEN 'interchange' THEN 18 ELSE 3 END + 5) // 10 / 10000 AS fee_amount FROM {pay_fees}""",
)
def fee_rating(f: Frames):
    return plan.rate_fees(f.pay_fees.withColumn("amount", F.col("base_amount")))


@query(
    "merchant_id created_at:t",
    f"SELECT merchant_id, created_at FROM {MERCHANTS} WHERE CAST(created_at AS DATE) <= DATE '1994-06-30'",
)
def eligible_merchants(f: Frames):
    return plan.eligible(merchants(f), "created_at", "1994-06-30")
