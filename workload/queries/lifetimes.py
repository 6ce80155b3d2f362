"""Lifetime marts and keyed tables kept up by runs; their oracles are the full recomputes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.lifetimes import CustomerLifetimes, RiderLifetimes
from tidemark.plans import rides as ride_plan
from tidemark.session import shared_folder
from workload.frames import RUN_TS, Frames
from workload.queries import payments, rides
from workload.registry import query


def _third(key: str):
    return F.pmod(F.xxhash64(key), F.lit(3)) == 0


def payment_runs(f: Frames):
    """(payments, refunds) of three runs. A third of the payments first arrive with another customer, day and amount,
    and a third of the refunds for another payment; some of that arrives again, late, and is ignored."""
    rows, refunds = f.pay_payments, f.pay_refunds
    early = F.col("created_at") < "1998-01-01"
    first, second = rows.where("updated_at = created_at"), rows.where("updated_at > created_at")
    older = {c: F.col(c) - F.expr("INTERVAL 3 DAYS") for c in ("logical_date", "ingest_ts")}
    wrong = first.where(_third("payment_id")).withColumns(
        {"customer_id": F.concat(F.lit("x"), "customer_id"), "created_at": F.col("created_at") - F.expr("INTERVAL 40 DAYS"),
         "amount": (F.col("amount") * 2).cast("decimal(14,2)"), **older})
    misplaced = refunds.where(_third("refund_id")).withColumns({"payment_id": F.lit("no payment"), **older})
    nothing = refunds.where("false")
    return [
        (wrong.unionByName(first.where(early)), misplaced),
        (first.where(~early).unionByName(second.where(early)), refunds),
        (second.where(~early).unionByName(wrong.where(early)), nothing),
    ]


@query(payments.CUSTOMER_VALUE, payments.CUSTOMER_VALUE_SQL)
def customer_lifetime_by_runs(f: Frames):
    """Three runs, one of them repeated, with a fold between."""
    marts = CustomerLifetimes(f.spark, shared_folder(f.spark, "customer-lifetimes"))
    runs = payment_runs(f)
    for batch, rows in enumerate(runs[:2]):
        marts.run(*rows, batch)
    for log in marts.logs(*runs[0]):
        log.fold()
    marts.run(*runs[1], 1)
    marts.run(*runs[2], 2)
    marts.run(*runs[2], 2)
    return marts.mart(payments.customers(f), RUN_TS)


@query(rides.RIDER_VALUE, rides.RIDER_VALUE_SQL)
def rider_lifetime_by_runs(f: Frames):
    """Two runs; rides that first arrive as another rider's, on another day."""
    marts = RiderLifetimes(f.spark, shared_folder(f.spark, "rider-lifetimes"))
    early = F.col("ingest_ts") < "1998-01-01"
    wrong = f.ride_rides.where(early & _third("ride_id")).withColumns({
        "rider_id": F.lit("x"), "requested_at": F.col("requested_at") - F.expr("INTERVAL 40 DAYS"),
        "ingest_ts": F.col("ingest_ts") - F.expr("INTERVAL 1 DAY")})
    marts.run(wrong, f.ride_payments.where(early), 0)
    marts.run(f.ride_rides, f.ride_payments.where(~early), 1)
    return marts.mart(ride_plan.dim_rider(rides.staged(f, "riders"), rides.cities(f)))
