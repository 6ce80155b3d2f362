"""Merge on read, and lifetime states kept up by runs."""

import glob
import os
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import payments as plan
from tidemark.plans.lifetimes import CustomerLifetimes
from tidemark.sinks.delta_log import DeltaLog
from workload.frames import RUN_TS, Frames, present
from workload.queries import lifetimes
from workload.queries import payments as pay

from given import SF

SCHEMA = "k long, v string, at long"


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema

    def build(order=(), partition=()):
        return DeltaLog(spark, str(tmp_path / "table"), schema, ["k"], order, partition)

    return build


@pytest.fixture
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def files(log):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{log.path}/**/*.parquet", recursive=True)}


def test_reads_base_and_log(table, frame, rows):
    log = table()
    assert rows(log.read()) == [] and not log.fold()
    log.write(frame((1, "a", 1), (2, "b", 1), (None, "n", 1)), 0)
    log.write(frame((2, "c", 1), (3, "d", 1)), 1)
    expect = [(1, "a", 1), (2, "c", 1), (3, "d", 1), (None, "n", 1)]
    assert rows(log.read()) == expect and rows(log.read(before=1)) == [(1, "a", 1), (2, "b", 1), (None, "n", 1)]
    assert log.fold() and log.batches() == [] and rows(log.read()) == expect
    log.write(frame((None, "m", 1), (1, "z", 1)), 2)
    assert rows(log.read()) == [(1, "z", 1), (2, "c", 1), (3, "d", 1), (None, "m", 1)]
    assert rows(log.read(where=F.col("k") == 1)) == [(1, "z", 1)]


def test_a_batch_writes_only_its_rows(table, frame):
    log = table()
    log.write(frame(*[(k, "a", 1) for k in range(1000)]), 0)
    log.fold()
    before = files(log)
    log.write(frame((5, "b", 2), (2000, "c", 2)), 1)
    after = files(log)
    assert all(after[f] == t for f, t in before.items())
    new = set(after) - set(before)
    assert new and all("/log/_batch=1/" in f for f in new)
    assert sum(log.spark.read.parquet(f).count() for f in new) == 2


def test_late_rows_do_not_replace_newer_ones(table, frame, rows):
    log = table([F.desc("at")])
    log.write(frame((1, "new", 5), (2, "old", 1)), 0)
    log.fold()
    log.write(frame((1, "late", 3), (2, "newer", 2), (2, "between", 1)), 1)
    assert rows(log.read()) == [(1, "new", 5), (2, "newer", 2)]
    log.fold()
    log.write(frame((2, "same time", 2)), 2)
    assert rows(log.read()) == [(1, "new", 5), (2, "same time", 2)]


def test_repeated_batches(table, frame, rows):
    log = table()
    log.write(frame((1, "a", 1)), 0)
    log.write(frame((1, "b", 1), (2, "b", 1)), 1)
    log.write(frame((1, "c", 1)), 1)
    assert rows(log.read()) == [(1, "c", 1)]
    with pytest.raises(ValueError):
        log.write(frame((1, "d", 1)), 0)
    log.fold()
    assert not log.write(frame((1, "e", 1)), 1) and rows(log.read()) == [(1, "c", 1)]


def test_what_died_does_not_count(table, frame, rows):
    log = table()
    log.write(frame((1, "a", 1)), 0)
    log.write(frame((1, "half", 1)), 1)
    os.remove(f"{log.path}/log/_batch=1/_SUCCESS")
    assert rows(log.read()) == [(1, "a", 1)] and not log.has(1)
    log.write(frame((1, "whole", 1)), 1)
    log.fold()
    os.remove(f"{log.path}/base/_upto=1/_SUCCESS")
    assert rows(log.read()) == [(1, "whole", 1)] and log.fold() and rows(log.read()) == [(1, "whole", 1)]


def test_folds_keep_one_state_back(table, frame, rows):
    log = table(partition=["at"])
    for n in range(6):
        log.write(frame((n, "a", n), (100, "x", n)), n)
        log.fold()
    assert log.bases() == [4, 5] and log._committed("log", "_batch") == [5]
    assert rows(log.read()) == [(0, "a", 0), (1, "a", 1), (100, "x", 5), (2, "a", 2), (3, "a", 3), (4, "a", 4), (5, "a", 5)]
    assert log.fold_if_large() is False
    log.write(frame((7, "b", 1)), 6)
    assert log.fold_if_large(most_batches=2, most_share=100) is False and log.fold_if_large(most_batches=1) is True


def test_only_rows_with_logged_keys_are_ranked(table, frame):
    log = table([F.desc("at")])
    log.write(frame(*[(k, "a", 1) for k in range(1000)]), 0)
    log.fold()
    log.write(frame((5, "b", 2)), 1)
    found = log.read()
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


# lifetimes

def recomputed(f, runs):
    paid, back = (reduce(DataFrame.unionByName, frames) for frames in zip(*runs))
    return plan.customer_lifetime_value(plan.fact_payments(paid), plan.fact_refunds(back, tie=["reason"]), pay.customers(f), RUN_TS)


def test_every_run_equals_the_recompute(spark, tmp_path, rows):
    f = Frames(spark, SF)
    runs, marts = lifetimes.payment_runs(f), CustomerLifetimes(spark, str(tmp_path))
    for batch in range(3):
        marts.run(*runs[batch], batch)
        got, want = marts.mart(pay.customers(f), RUN_TS), recomputed(f, runs[: batch + 1])
        assert rows(present(got.select(*want.columns))) == rows(present(want))


def test_a_run_that_dies_is_repeated(spark, tmp_path, rows, monkeypatch):
    f = Frames(spark, SF)
    runs, marts = lifetimes.payment_runs(f), CustomerLifetimes(spark, str(tmp_path))
    marts.run(*runs[0], 0)
    write = DeltaLog.write

    def dies(self, df, batch):
        if self.path.endswith("states"):
            raise OSError("lost")
        return write(self, df, batch)

    monkeypatch.setattr(DeltaLog, "write", dies)
    with pytest.raises(OSError):
        marts.run(*runs[1], 1)
    monkeypatch.setattr(DeltaLog, "write", write)
    marts.run(*runs[1], 1)
    want = recomputed(f, runs[:2])
    assert rows(present(marts.mart(pay.customers(f), RUN_TS).select(*want.columns))) == rows(present(want))


def test_days_cease_and_customers_vanish(spark, tmp_path):
    schema = "payment_id string, customer_id string, created_at timestamp, amount decimal(14,2), status string, logical_date date, ingest_ts timestamp"
    refunds = spark.createDataFrame([], "refund_id string, payment_id string, amount decimal(14,2), reason string, logical_date date, ingest_ts timestamp")

    def paid(*given):
        day = lambda d: d and f"{d} 10:00:00"
        made = [(i, c, day(d), str(a), "completed", f"2024-01-{at:02}", f"2024-01-{at:02} 00:00:00") for i, c, d, a, at in given]
        text = spark.createDataFrame(made, ", ".join(f"{x.split()[0]} string" for x in schema.split(", ")))
        return text.select(*[F.col(x.split()[0]).cast(x.split()[1]) for x in schema.split(", ")])

    def state(marts):
        customers = spark.createDataFrame([], "customer_id string, first_name string, last_name string, country string, age_band string")
        return {r["customer_id"]: (r["total_payments"], float(r["total_spend"]), str(r["first_payment_date"]), str(r["last_payment_date"]), r["active_days"])
                for r in marts.mart(customers, RUN_TS).collect()}

    marts = CustomerLifetimes(spark, str(tmp_path))
    marts.run(paid(("1", "a", "2024-01-31", 5, 1), ("2", "a", "2024-03-01", 7, 2), ("3", "a", "2024-03-01", 1, 1), ("4", "b", "2024-02-29", 2, 1),
                   ("5", None, None, 3, 1)), refunds, 0)
    assert state(marts) == {"a": (3, 13.0, "2024-01-31", "2024-03-01", 2), "b": (1, 2.0, "2024-02-29", "2024-02-29", 1), None: (1, 3.0, "None", "None", 0)}
    marts.run(paid(("1", "a", "2024-02-02", 6, 2), ("3", "c", "2024-03-01", 1, 2), ("4", "a", "2024-02-29", 2, 2), ("2", "a", "2023-01-01", 9, 1)), refunds, 1)
    assert state(marts) == {"a": (3, 15.0, "2024-02-02", "2024-03-01", 3), "c": (1, 1.0, "2024-03-01", "2024-03-01", 1), None: (1, 3.0, "None", "None", 0)}
    marts.run(paid(("2", "a", "2024-02-02", 7, 3), ("5", "c", "2024-03-01", 3, 3)), refunds, 2)
    assert state(marts) == {"a": (3, 15.0, "2024-02-02", "2024-02-29", 2), "c": (2, 4.0, "2024-03-01", "2024-03-01", 1)}
