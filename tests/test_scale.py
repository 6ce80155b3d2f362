"""Steps whose shuffles, sorts or single tasks grew with the table."""

import datetime as dt
import glob
import threading

import pyarrow.parquet as pq
import pytest
from given import SF
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.sinks import tables
from tidemark.sources.lake import read_table
from workload.frames import Frames
from workload.queries import chains


def cities(spark, n=4):
    return spark.range(40, numPartitions=n).selectExpr(
        "'c' || id AS city_id", "'name' AS name", "'ee' AS country", "'UTC' AS timezone", "TIMESTAMP '2024-01-01' AS launched_at")


def test_landed_rows_are_written_by_the_tasks_that_read_them(spark, tmp_path):
    for run_id in (jobs.NO_RUN_ID, "one"):
        run = jobs.Run(spark, str(tmp_path / run_id), dt.date(2024, 1, 10), dt.datetime(2024, 2, 1), run_id)
        for _ in range(2):
            assert jobs.land_rows(run, "rideon_cities_raw", "rideon", cities(spark)) == 40  # a snapshot, replaced
        fares = cities(spark).selectExpr(
            "city_id AS fare_id", "'r' AS ride_id", *[f"1 AS {c}" for c in ("base_fare", "distance_fare", "time_fare", "surge_amount", "discount", "total_fare")],
            "'EUR' AS currency", "launched_at AS created_at")
        assert jobs.land_rows(run, "rideon_fares_raw", "rideon", fares) == 40
        for table in ("cities", "fares"):
            path = run.path("rideon", "bronze", f"rideon_{table}_raw")
            files = glob.glob(f"{path}/logical_date=2024-01-10/*.parquet")
            assert len(files) == 4 and run.read("rideon", "bronze", f"rideon_{table}_raw").count() == 40
            assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    assert jobs.land_rows(run, "rideon_fares_raw", "rideon", fares) == 40
    assert run.read("rideon", "bronze", "rideon_fares_raw").count() == 40


def test_lifetime_logs_hold_the_columns_that_marts_need(spark, tmp_path):
    from tidemark.plans.lifetimes import CustomerLifetimes

    marts = CustomerLifetimes(spark, str(tmp_path))
    stamp = "TIMESTAMP '2024-01-01' AS created_at, DATE '2024-01-01' AS logical_date, TIMESTAMP '2024-01-01' AS ingest_ts"
    paid = spark.range(9).selectExpr("'p' || id AS payment_id", "'c' AS customer_id", "CAST(id AS DECIMAL(14,2)) AS amount", "'completed' AS status",
                                     "repeat('x', 99) AS description", *stamp.split(", "))
    back = spark.range(3).selectExpr("'r' || id AS refund_id", "'p' || id AS payment_id", "CAST(1 AS DECIMAL(14,2)) AS amount", "'why' AS reason",
                                     "repeat('x', 99) AS currency", *stamp.split(", "))
    for batch in range(2):
        marts.run(paid, back, batch)
    state = marts.states().read().first()
    assert (state["n"], state["total_spend"], state["total_refunds"]) == (9, 36, 3)
    logs = [spark.read.parquet(f"{tmp_path}/{name}/log") for name in ("payments", "refunds")]
    assert not {"description", "currency"} & {c for log in logs for c in log.columns}


def test_the_key_index_keeps_a_few_bytes_for_a_key(spark, tmp_path):
    from tidemark.sinks import key_index

    rows = spark.range(4000).selectExpr("id AS k", "concat('p', id % 3) AS p")
    key_index.upsert_indexed(rows, str(tmp_path / "t"), ["k"], ["p"])
    index = key_index._read(spark, str(tmp_path / "t"), [rows.schema["p"]])
    size, found = index.selectExpr("sum(length(to_json(struct(bits))))", "sum(size(bits))").first()
    assert 3900 < found <= 4000 and size < 40 * 4000


def test_writes_of_few_and_of_many_partitions(spark, tmp_path, rows):
    """No sort for few partitions a task; rows of further ones are sorted and all are there."""
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == 8
    for n in (3, 40):
        df = spark.range(1000).selectExpr("id", f"id % {n} AS p")
        tables.append(df, str(tmp_path / str(n)), ["p"])
        assert rows(read_table(spark, str(tmp_path / str(n)), schema=df.schema)) == rows(df)


def test_listing_many_partitions_takes_few_tasks(spark, tmp_path):
    """F8: each folder of a table of many days was listed by a task of its own."""
    path, group = str(tmp_path / "days"), f"listing-{tmp_path.name}"
    spark.range(120).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day")).write.partitionBy("day").parquet(path)
    spark.sparkContext.setJobGroup(group, "listing")
    try:
        table = spark.read.schema("id long, day date").parquet(path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert stages and sum(tracker.getStageInfo(s).numTasks for s in stages) <= 32
    assert table.count() == 120


def test_bronze_to_gold_loads_its_tables_side_by_side(spark, monkeypatch):
    """F8: the three tables do not need each other; one after the other their last tasks left cores idle."""
    all_there, landed, ran = threading.Barrier(3), [], []

    def run_job(run, domain, layer, table):
        all_there.wait(60)
        ran.append(table)

    monkeypatch.setattr(chains, "_land", lambda run, domain, table, rows: landed.append(table))
    monkeypatch.setattr(chains.jobs, "run_job", run_job)
    with pytest.raises(AnalysisException):  # nothing was written, so the mart's input is not there
        chains.payments_bronze_to_gold(Frames(spark, SF))
    assert sorted(landed) == ["payments_fees_raw", "payments_payments_raw", "payments_refunds_raw"]
    assert sorted(ran) == ["fact_fees", "fact_payments", "fact_refunds"]


def test_side_by_side_raises_a_failure(spark):
    done = []

    def fails():
        raise OSError("no space")

    with pytest.raises(OSError, match="no space"):
        chains._side_by_side(spark, [fails, lambda: done.append(spark.range(5).count())])
    assert done == [5]
