"""Customer and rider lifetime marts kept up run by run.

Sources, states and days are delta logs under one folder. A run brings the rows that arrived;
rows that replace older ones take back what those had counted, also where the customer, the
day or the amount is another now. A row older than the one known is ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lifetime import Lifetime, advance, current
from tidemark.plans.payments import customer_value
from tidemark.plans.rides import rider_value
from tidemark.session import written_once
from tidemark.sinks.delta_log import DeltaLog

CUSTOMER = Lifetime("customer_id", "string", "payment_date", {
    "total_spend": ("amount", "decimal(30,2)"),
    "successful_payments": ("int(status = 'completed')", "bigint"),
    "failed_payments": ("int(status = 'failed')", "bigint"),
    "total_refunds": ("refund_amount", "decimal(30,2)"),
})
RODE = Lifetime("rider_id", "string", "ride_date", {
    "completed_rides": ("int(status = 'completed')", "bigint"),
    "cancelled_rides": ("int(status = 'cancelled')", "bigint"),
    "distance": ("CASE WHEN status = 'completed' THEN distance_km END", "decimal(30,2)"),
    "distances": ("int(status = 'completed' AND distance_km IS NOT NULL)", "bigint"),
})
PAID = Lifetime("rider_id", "string", None, {
    "total_spend": ("CASE WHEN status = 'captured' THEN amount END", "decimal(30,2)"),
    "fares": ("int(status = 'captured' AND amount IS NOT NULL)", "bigint"),
})

#: The columns of the sources that the marts, and the order of a key's rows, depend on; the logs hold no others.
PAYMENT = ["payment_id", "customer_id", "created_at", "amount", "status", "logical_date", "ingest_ts"]
REFUND = ["refund_id", "payment_id", "amount", "reason", "logical_date", "ingest_ts"]
RIDE = ["ride_id", "rider_id", "requested_at", "status", "distance_km", "ingest_ts", "vehicle_id", "driver_id"]
RIDE_PAYMENT = ["payment_id", "rider_id", "amount", "status", "ingest_ts", "driver_id"]


def _newest(*ties: str):
    return [F.desc_nulls_last(c) for c in ("logical_date", "ingest_ts", *ties)]


def _touched(log: DeltaLog, rows: DataFrame, batch: int, column: str) -> DataFrame:
    """Values of a column in a batch's rows and in the rows that they may replace."""
    known = log._matching(log.read(before=batch), rows, "left_semi")
    return rows.select(column).unionByName(known.select(column)).distinct()


def _only(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    same = F.col(f"_rows.{column}").eqNullSafe(F.col(f"_ids.{column}"))
    return rows.alias("_rows").join(ids.alias("_ids"), same, "left_semi")


@dataclass(frozen=True)
class CustomerLifetimes:
    """Payments, refunds (bronze rows of any age) and the states made of them, under a folder."""

    spark: SparkSession
    root: str

    def run(self, payments: DataFrame, refunds: DataFrame, batch: int) -> None:
        """States are written last: a run that has written them is done, one that died is repeated."""
        if self.states().has(batch):
            return
        payments, refunds = (written_once(df.select(names), "lifetime-batch") for df, names in ((payments, PAYMENT), (refunds, REFUND)))
        paid = DeltaLog(self.spark, f"{self.root}/payments", payments.schema, ["payment_id"], _newest())
        back = DeltaLog(self.spark, f"{self.root}/refunds", refunds.schema, ["refund_id"], _newest("reason"))
        ids = payments.select("payment_id").union(_touched(back, refunds, batch, "payment_id")).distinct()
        ids = written_once(ids, "lifetime-ids")
        # All rows that the batch can replace: older payments of refunds that it moves are among the ids.
        known, returned = (written_once(_only(log.read(before=batch), ids, "payment_id"), "lifetime-known") for log in (paid, back))
        paid.write(payments, batch)
        back.write(refunds, batch)
        after = self.units(paid.after(known, batch), back.after(returned, batch))
        advance(CUSTOMER, self.units(known, returned), after, self.states(), CUSTOMER.days_log(self.spark, f"{self.root}/days"), batch)

    def states(self) -> DeltaLog:
        return CUSTOMER.states_log(self.spark, f"{self.root}/states")

    def logs(self, payments: DataFrame, refunds: DataFrame) -> list[DeltaLog]:
        """All of them, to be folded."""
        payments, refunds = payments.select(PAYMENT), refunds.select(REFUND)
        return [DeltaLog(self.spark, f"{self.root}/payments", payments.schema, ["payment_id"], _newest()),
                DeltaLog(self.spark, f"{self.root}/refunds", refunds.schema, ["refund_id"], _newest("reason")),
                self.states(), CUSTOMER.days_log(self.spark, f"{self.root}/days")]

    @staticmethod
    def units(payments: DataFrame, refunds: DataFrame) -> DataFrame:
        """Payments with the sum of their refunds."""
        refunded = refunds.where("payment_id IS NOT NULL").groupBy("payment_id").agg(F.sum("amount").alias("refund_amount"))
        return payments.select("payment_id", "customer_id", F.to_date("created_at").alias("payment_date"), "amount", "status").join(
            refunded, "payment_id", "left")

    def mart(self, customers: DataFrame, run_ts) -> DataFrame:
        """customer_lifetime_value of all payments known."""
        totals = current(self.states(), CUSTOMER).withColumnsRenamed(
            {"n": "total_payments", "first_day": "first_payment_date", "last_day": "last_payment_date"})
        return customer_value(totals, customers, run_ts)


@dataclass(frozen=True)
class RiderLifetimes:
    """Rides, ride payments (bronze rows of any age) and the states made of them, under a folder."""

    spark: SparkSession
    root: str

    def run(self, rides: DataFrame, payments: DataFrame, batch: int) -> None:
        self._run(rides, RIDE, "rides", "ride_id", ("vehicle_id", "driver_id"), RODE, batch)
        self._run(payments, RIDE_PAYMENT, "payments", "payment_id", ("rider_id", "driver_id"), PAID, batch)

    def _run(self, rows: DataFrame, names: list[str], name: str, key: str, ties: tuple[str, ...], spec: Lifetime, batch: int) -> None:
        states = spec.states_log(self.spark, f"{self.root}/{name}_states")
        if states.has(batch):
            return
        rows = written_once(rows.select([c for c in names if c in rows.columns]), "lifetime-batch")
        order = [F.desc_nulls_last(c) for c in ("ingest_ts", *ties) if c in rows.columns]
        log = DeltaLog(self.spark, f"{self.root}/{name}", rows.schema, [key], order)
        ids = written_once(rows.select(key).distinct(), "lifetime-ids")
        known = written_once(_only(log.read(before=batch), ids, key), "lifetime-known")
        log.write(rows, batch)
        days = spec.days_log(self.spark, f"{self.root}/{name}_days") if spec.day else None
        advance(spec, self.units(known), self.units(log.after(known, batch)), states, days, batch)

    @staticmethod
    def units(rows: DataFrame) -> DataFrame:
        return rows.withColumn("ride_date", F.to_date("requested_at")) if "requested_at" in rows.columns else rows

    def mart(self, riders: DataFrame) -> DataFrame:
        """rider_lifetime_value of all rides and payments known."""
        rode, paid = (current(s.states_log(self.spark, f"{self.root}/{name}_states"), s) for s, name in ((RODE, "rides"), (PAID, "payments")))
        mean = lambda total, count: F.round(F.col(total) / F.nullif(F.col(count), F.lit(0)), 2)
        rode = rode.withColumnsRenamed({"n": "total_rides", "first_day": "first_ride_date", "last_day": "last_ride_date"})
        return rider_value(rode.withColumn("avg_distance_km", mean("distance", "distances")),
                           paid.select("rider_id", "total_spend", mean("total_spend", "fares").alias("avg_fare")), riders)
