"""Payments: silver star schema, gold marts and source-side roll-ups.

Every function takes whatever slice of its inputs the caller filtered (one day, a
range, or all history) and returns a lazy plan; day marts group by their day, so a
backfill of many days is one job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_attributes
from tidemark.functions.columns import (
    age_band,
    as_date,
    as_timestamp,
    card_expired,
    exact_mean,
    safe_ratio,
    sum_or_zero,
)
from tidemark.operators.keyed import latest_per_key

# --- fixed values: fee rate per fee type --------------------------------------
FEE_RATES = {"processing": "0.029", "interchange": "0.018", "scheme": "0.003"}
# ------------------------------------------------------------------------------


def newest(*tie: str) -> list[Column]:
    """Later day wins, then later ingest; callers whose rows can tie add columns."""
    return [F.desc(c) for c in ("logical_date", "ingest_ts", *tie)]


# --- silver -------------------------------------------------------------------


def dim_customer(customers: DataFrame, day: dt.date | str, run_ts, tie: Sequence[str] = ()) -> DataFrame:
    latest = latest_per_key(customers, ["customer_id"], newest(*tie))
    return latest.select(
        "customer_id", "first_name", "last_name", "email", "birthdate",
        age_band("birthdate", day).alias("age_band"),
        "country", "city", "phone", "created_at", as_timestamp(run_ts).alias("updated_at"),
    )


def dim_merchant(merchants: DataFrame, run_ts, tie: Sequence[str] = ()) -> DataFrame:
    latest = latest_per_key(merchants, ["merchant_id"], newest(*tie))
    return latest.select(
        "merchant_id", "name", "category_code", "mcc_code", "country", "city", "status", "created_at",
        as_timestamp(run_ts).alias("updated_at"),
    )


def dim_payment_method(methods: DataFrame, day: dt.date | str, run_ts, tie: Sequence[str] = ()) -> DataFrame:
    latest = latest_per_key(methods, ["method_id"], newest(*tie))
    return latest.select(
        "method_id", "customer_id", "type", "provider", "card_brand", "last4", "expiry_month",
        "expiry_year", "is_default",
        card_expired("expiry_year", "expiry_month", day).alias("is_expired"),
        "created_at", as_timestamp(run_ts).alias("updated_at"),
    )


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar rows for the run days in column date_day."""
    return calendar_attributes(days.distinct()).select(
        F.col("date_day").alias("date"), "day", "month", "quarter", "year", "day_of_week",
        "day_name", "is_weekend", "iso_week",
    )


def fact_payments(payments: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    lag_seconds = F.unix_micros("settled_at") - F.unix_micros("created_at")
    latest = latest_per_key(payments, ["payment_id"], newest(*tie))
    return latest.select(
        "payment_id", F.to_date("created_at").alias("payment_date"), "customer_id", "merchant_id",
        "method_id", "amount", "currency", "status", "error_code", "description", "reference_id",
        "created_at", "updated_at", "settled_at",
        (F.floor(lag_seconds / F.lit(1_000_000)) / F.lit(3600.0)).cast("double").alias("settled_lag_hours"),
    )


def fact_refunds(refunds: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    latest = latest_per_key(refunds, ["refund_id"], newest(*tie))
    return latest.select(
        "refund_id", F.to_date("created_at").alias("refund_date"), "payment_id", "amount", "currency",
        "reason", "status", "created_at", "updated_at",
    )


def fact_fees(fees: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    latest = latest_per_key(fees, ["fee_id"], newest(*tie))
    return latest.select(
        "fee_id", F.to_date("created_at").alias("fee_date"), "payment_id", "fee_type", "amount",
        "currency", "created_at",
    )


def fact_settlements(settlements: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    latest = latest_per_key(settlements, ["settlement_id"], newest(*tie))
    return latest.select(
        "settlement_id", "settlement_date", "merchant_id", "amount", "currency", "payments_count",
        "status", "created_at",
    )


# --- gold ---------------------------------------------------------------------


def daily_payment_summary(payments: DataFrame, refunds: DataFrame, fees: DataFrame, run_ts) -> DataFrame:
    """One row per day with payments; volume counts all statuses."""
    by_day = payments.groupBy(F.col("payment_date").alias("day")).agg(
        F.count(F.lit(1)).alias("total_payments"),
        sum_or_zero("amount").alias("total_volume"),
        F.count_if(F.col("status") == "completed").alias("successful_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
    )
    refunded = refunds.groupBy(F.col("refund_date").alias("day")).agg(F.sum("amount").alias("refund_volume"))
    charged = fees.groupBy(F.col("fee_date").alias("day")).agg(F.sum("amount").alias("fee_volume"))
    joined = by_day.join(refunded, "day", "left").join(charged, "day", "left")
    refund, fee = F.coalesce("refund_volume", F.lit(0)), F.coalesce("fee_volume", F.lit(0))
    return joined.select(
        "day", "total_payments", "total_volume", "successful_count", "failed_count",
        (F.lit(100.0) * F.col("successful_count") / F.col("total_payments")).alias("success_rate_pct"),
        F.bround(F.col("total_volume") / F.col("total_payments"), 2).alias("avg_amount"),
        "unique_customers", "unique_merchants",
        refund.alias("refund_volume"), fee.alias("fee_volume"),
        (F.col("total_volume") - refund - fee).alias("net_revenue"),
        as_timestamp(run_ts).alias("computed_at"),
    )


def daily_revenue_by_merchant(
    payments: DataFrame, refunds: DataFrame, fees: DataFrame, merchants: DataFrame, run_ts
) -> DataFrame:
    """Merchant and day; only refunds and fees of the payment's own day are subtracted."""
    refunded = refunds.groupBy("payment_id", F.col("refund_date").alias("payment_date")).agg(
        F.sum("amount").alias("refund_amount")
    )
    charged = fees.groupBy("payment_id", F.col("fee_date").alias("payment_date")).agg(
        F.sum("amount").alias("fee_amount")
    )
    on = ["payment_id", "payment_date"]
    by_merchant = (
        payments.join(refunded, on, "left")
        .join(charged, on, "left")
        .groupBy("merchant_id", F.col("payment_date").alias("day"))
        .agg(
            sum_or_zero("amount").alias("gross_volume"),
            F.count(F.lit(1)).alias("txn_count"),
            F.count_if(F.col("status") == "completed").alias("success_count"),
            sum_or_zero("refund_amount").alias("refund_amount"),
            sum_or_zero("fee_amount").alias("fee_amount"),
            exact_mean("amount", 2).alias("avg_ticket"),
        )
    )
    labels = merchants.select("merchant_id", F.col("name").alias("merchant_name"), "category_code")
    net = F.col("gross_volume") - F.col("refund_amount") - F.col("fee_amount")
    return by_merchant.join(labels, "merchant_id", "left").select(
        "merchant_id", "merchant_name", "category_code", "day", "gross_volume", "txn_count",
        "success_count", "refund_amount", "fee_amount", net.alias("net_revenue"), "avg_ticket",
        as_timestamp(run_ts).alias("computed_at"),
    )


def customer_lifetime_value(
    payments: DataFrame, refunds: DataFrame, customers: DataFrame, run_ts
) -> DataFrame:
    refunded = refunds.groupBy("payment_id").agg(F.sum("amount").alias("refund_amount"))
    by_customer = (
        payments.join(refunded, "payment_id", "left")
        .groupBy("customer_id")
        .agg(
            sum_or_zero("amount").alias("total_spend"),
            F.count(F.lit(1)).alias("total_payments"),
            F.count_if(F.col("status") == "completed").alias("successful_payments"),
            F.count_if(F.col("status") == "failed").alias("failed_payments"),
            sum_or_zero("refund_amount").alias("total_refunds"),
            F.min("payment_date").alias("first_payment_date"),
            F.max("payment_date").alias("last_payment_date"),
            F.count_distinct("payment_date").alias("active_days"),
        )
    )
    return customer_value(by_customer, customers, run_ts)


def customer_value(by_customer: DataFrame, customers: DataFrame, run_ts) -> DataFrame:
    """The mart from the customers' totals, however they were had."""
    people = customers.select("customer_id", "first_name", "last_name", "country", "age_band")
    refund_share = safe_ratio(
        F.lit(100.0) * F.col("total_refunds").cast("double"), F.col("total_spend").cast("double"), 0.0
    )
    return by_customer.join(people, "customer_id", "left").select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"), "country",
        "age_band", "total_spend", "total_payments", "successful_payments", "failed_payments",
        "total_refunds", refund_share.alias("refund_rate_pct"), "first_payment_date",
        "last_payment_date", "active_days", as_timestamp(run_ts).alias("computed_at"),
    )


def merchant_settlement_daily(
    settlements: DataFrame, payments: DataFrame, merchants: DataFrame, run_ts
) -> DataFrame:
    gross = payments.groupBy("merchant_id", F.col("payment_date").alias("settlement_date")).agg(
        F.sum("amount").alias("gross_volume_for_date")
    )
    labels = merchants.select("merchant_id", F.col("name").alias("merchant_name"))
    joined = settlements.join(gross, ["merchant_id", "settlement_date"], "left").join(
        labels, "merchant_id", "left"
    )
    return joined.select(
        "merchant_id", "merchant_name", "settlement_date",
        F.col("amount").alias("settled_amount"),
        F.col("payments_count").alias("settled_payments_count"),
        F.coalesce("gross_volume_for_date", F.lit(0)).alias("gross_volume_for_date"),
        F.datediff("settlement_date", F.to_date("created_at")).alias("settlement_lag_days"),
        "status", as_timestamp(run_ts).alias("computed_at"),
    )


# --- source-side roll-ups -----------------------------------------------------


def rate_fees(payments: DataFrame, fee_type: str = "fee_type") -> DataFrame:
    """Payments with fee_amount = amount x the rate of their fee type, four decimals."""
    pairs = [F.lit(x) for t, r in FEE_RATES.items() for x in (t, r)]
    rate = F.try_element_at(F.create_map(*pairs), F.col(fee_type)).cast("decimal(5,3)")
    return payments.withColumn("fee_amount", F.round(F.col("amount") * rate, 4))


def settlement_rollup(payments: DataFrame) -> DataFrame:
    """Completed payments per merchant and day."""
    done = payments.where(F.col("status") == "completed")
    return done.groupBy("merchant_id", F.to_date("created_at").alias("settlement_date")).agg(
        F.sum("amount").alias("amount"),
        F.count(F.lit(1)).alias("payments_count"),
        F.max("currency").alias("currency"),
    )


def eligible(entities: DataFrame, created: str, day: dt.date | str) -> DataFrame:
    """Entities that existed on a day."""
    return entities.where(F.to_date(created) <= as_date(day))
