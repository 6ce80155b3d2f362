import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evolve, history, quality
from tidemark.sinks import layout, tables
from tidemark.sources import lake
from tidemark.streaming import streams

DDL = "k int, v string, p string"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def read(spark, path, *cols):
    df = lake.read_table(spark, path)
    return sorted((tuple(r) for r in df.select(*(cols or ("k", "v", "p"))).collect()), key=str)


def test_slice_overwrite_leaves_other_partitions(spark, path):
    tables.append(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], DDL), path, ["p"])
    for _ in range(2):
        tables.overwrite_slice_checked(spark.createDataFrame([(3, "c", "y")], DDL), path, ["p"])
        assert read(spark, path) == [(1, "a", "x"), (3, "c", "y")]
    with pytest.raises(tables.EmptySourceError):
        tables.overwrite_slice_checked(spark.createDataFrame([], DDL), path, ["p"])
    assert len(read(spark, path)) == 2


def test_swap_full_reads_itself_and_refuses_nothing(spark, path):
    tables.swap_full(spark.createDataFrame([(1, "a", "x")], DDL), path)
    again = lake.read_table(spark, path).withColumn("k", F.col("k") + 1)
    tables.swap_full(again, path)
    assert read(spark, path) == [(2, "a", "x")]
    with pytest.raises(tables.EmptySourceError):
        tables.swap_full(spark.createDataFrame([], DDL), path)
    assert read(spark, path) == [(2, "a", "x")]
    tables.recreate(spark.createDataFrame([(9, "z", "q")], DDL), path)
    assert read(spark, path) == [(9, "z", "q")]


def test_upsert_touches_only_its_partitions(spark, path):
    tables.upsert_table(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], DDL), path, ["k"], ["p"])
    before = {r.file_path for r in layout.list_files(spark, path).where("partition = 'p=x'").collect()}
    for _ in range(2):
        tables.upsert_table(spark.createDataFrame([(2, "B", "y"), (3, "c", "z")], DDL), path, ["k"], ["p"])
        assert read(spark, path) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "z")]
    after = {r.file_path for r in layout.list_files(spark, path).where("partition = 'p=x'").collect()}
    assert before == after


def test_upsert_moves_a_key_and_drops_the_empty_partition(spark, path):
    tables.append(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], DDL), path, ["p"])
    tables.upsert_table(spark.createDataFrame([(1, "A", "y")], DDL), path, ["k"], ["p"], moves=True)
    assert read(spark, path) == [(1, "A", "y"), (2, "b", "y")]
    assert layout.file_summary(spark, path).select("partition").collect()[0][0] == "p=y"


ODD = [(1, "a", None), (2, "b", None), (3, "c", "a:b"), (4, "d", "REG AIR"), (5, "e", "01"), (6, "f", "1"), (7, "g", "x+y%20")]


def read_odd(spark, path):
    return sorted(tuple(r) for r in lake.read_table(spark, path, schema=spark.createDataFrame([], DDL).schema).collect())


@pytest.mark.parametrize("moves", [False, True])
def test_upsert_finds_odd_partitions(spark, path, moves):
    tables.append(spark.createDataFrame(ODD, DDL), path, ["p"])
    tables.upsert_table(spark.createDataFrame([(k, v.upper(), p) for k, v, p in ODD if k != 2], DDL), path, ["k"], ["p"], moves=moves)
    assert read_odd(spark, path) == [(k, v.upper() if k != 2 else v, p) for k, v, p in ODD]


def test_upsert_moves_between_odd_partitions(spark, path):
    tables.append(spark.createDataFrame(ODD, DDL), path, ["p"])
    tables.upsert_table(spark.createDataFrame([(k, "z", "") for k in (3, 5, 7)], DDL), path, ["k"], ["p"], moves=True)
    assert read_odd(spark, path) == [(k, "z" if k in (3, 5, 7) else v, None if k in (3, 5, 7) else p) for k, v, p in ODD]


@pytest.mark.parametrize("gone", [{1, 2}, {3}, {4}, {5}, {6}, {7}, {1, 3, 5}, {1, 2, 3, 4, 5, 6, 7}])
def test_delete_from_odd_partitions(spark, path, gone):
    tables.append(spark.createDataFrame(ODD, DDL), path, ["p"])
    tables.delete_from_table(spark, path, F.col("k").isin(*gone), ["p"], spark.createDataFrame([], DDL).schema)
    left = [r for r in ODD if r[0] not in gone]
    assert (read_odd(spark, path) if left else []) == left
    assert layout.orphan_files(layout.list_files(spark, path), layout.row_counts(spark, path)).isEmpty() if left else True


def test_odd_partitions_compact_and_have_no_orphans(spark, path):
    spark.createDataFrame(ODD * 3, DDL).repartition(5).write.partitionBy("p").parquet(path)
    assert layout.orphan_files(layout.list_files(spark, path), layout.row_counts(spark, path)).isEmpty()
    before = read_odd_any(spark, path)
    assert layout.compact(spark, path, ["p"], min_input_files=2) > 0
    assert read_odd_any(spark, path) == before
    names = {r.partition for r in layout.list_files(spark, path).collect()}
    assert names == {"p=__HIVE_DEFAULT_PARTITION__", "p=a%3Ab", "p=REG AIR", "p=01", "p=1", "p=x+y%2520"}


def read_odd_any(spark, path):
    schema = spark.createDataFrame([], DDL).schema
    return sorted((tuple(r) for r in lake.read_table(spark, path, schema=schema).collect()), key=str)


def test_a_swap_that_died_between_its_renames(spark, path):
    tables.swap_full(spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], DDL), path)
    tables._rename(spark, path, f"{path}.old-1")
    tables.upsert_table(spark.createDataFrame([(2, "B", "x"), (3, "c", "x")], DDL), path, ["k"])
    assert read(spark, path) == [(1, "a", "x"), (2, "B", "x"), (3, "c", "x")]


def test_a_failed_count_is_an_error(spark, path):
    bad = spark.createDataFrame([(1, "a", "x")], DDL).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        tables.counted(bad, lambda df: tables.append(df, path))
    assert tables.counted(spark.createDataFrame([], DDL), lambda df: tables.append(df, path)) == 0
    assert tables.counted(spark.range(5).where("1 = 0"), lambda df: tables.append(df, path + "2")) == 0


def test_a_replayed_batch_lands_once(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1, "a", "x"), (2, "b", None)], DDL).write.parquet(src)
    stream = streams.file_stream(spark, src, spark.read.parquet(src).schema)
    streams.land_stream(stream, out, state, ["p"]).awaitTermination()
    streams.land_stream(stream, out, state + "-lost", ["p"]).awaitTermination()  # the same batch again
    assert read(spark, out) == [(1, "a", "x"), (2, "b", None)]


def test_load_once(spark, path):
    df = spark.createDataFrame([(1, "a", "2024-01-01")], DDL)
    assert tables.load_once(df, path, "p", F.lit("2024-01-01").cast("date"), ["p"])
    assert not tables.load_once(df, path, "p", F.lit("2024-01-01").cast("date"), ["p"])


def test_scd2_table_rerun_and_same_day_changes(spark, path):
    def run(data, day):
        tables.scd2_table(spark.createDataFrame(data, "nk string, a string"), path, "nk", ["a"], day, "sk")

    run([("u1", "x"), ("u2", "x"), ("u3", "x")], "2024-01-01")
    run([("u1", "y"), ("u2", "x"), ("u3", "x")], "2024-01-02")
    run([("u1", "y"), ("u2", "z"), ("u3", "x")], "2024-01-02")  # closes another key on the same day
    run([("u1", "y"), ("u2", "z"), ("u3", "x")], "2024-01-02")
    got = read(spark, path, "nk", "a", "_is_current")
    assert got == [("u1", "x", False), ("u1", "y", True), ("u2", "x", False), ("u2", "z", True), ("u3", "x", True)]


def test_scd2_table_refuses_to_close_everything(spark, path):
    ddl = "nk string, a string"
    tables.scd2_table(spark.createDataFrame([("u1", "x")], ddl), path, "nk", ["a"], "2024-01-01", "sk")
    with pytest.raises(tables.EmptySourceError):
        tables.scd2_table(spark.createDataFrame([], ddl), path, "nk", ["a"], "2024-01-02", "sk", close_missing=True)
    assert read(spark, path, "nk", "_is_current") == [("u1", True)]


def test_forty_eight_small_files_become_five(spark, path):
    """48 one-row appends over six hours, one hour deleted, the rest compacted."""
    base = dt.datetime(2024, 3, 15, 9)
    data = [
        (f"txn{i:04d}", 10.0 + i * 2.5, base + dt.timedelta(hours=i // 8, minutes=i % 8 * 7)) for i in range(48)
    ]
    df = spark.createDataFrame(data, "txn_id string, amount double, created_at timestamp").withColumn(
        "hour", F.date_format("created_at", "yyyy-MM-dd-HH")
    )
    df.repartition(48, "txn_id").write.partitionBy("hour").option("maxRecordsPerFile", 1).parquet(path)

    def files():
        summary = layout.file_summary(spark, path).collect()
        return sum(r.file_count for r in summary), sum(r.total_rows for r in summary), len(summary)

    assert files() == (48, 48, 6)
    tables.delete_from_table(spark, path, F.col("amount") < 30.0, ["hour"])
    assert files() == (40, 40, 5)
    rows = spark.createDataFrame(lake.read_table(spark, path).collect(), lake.read_table(spark, path).schema)
    assert layout.compact(spark, path, ["hour"], min_input_files=2, target_bytes=1 << 20) == 5
    assert files() == (5, 40, 5)
    assert quality.reconcile(rows, lake.read_table(spark, path)).first().same_content
    assert layout.compact(spark, path, ["hour"], min_input_files=2, target_bytes=1 << 20) == 0
    total = layout.footprint(layout.file_summary(spark, path)).first()
    assert (total.files, total.rows) == (5, 40)


def test_one_large_partition_is_written_by_many_tasks(spark, path):
    df = spark.range(20000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("hot").alias("p"))
    df.repartition(12).write.partitionBy("p").parquet(path)
    size = layout.file_summary(spark, path).first().total_bytes
    layout.compact(spark, path, ["p"], min_input_files=2, target_bytes=size // 4)
    after = layout.file_summary(spark, path).first()
    assert 2 <= after.file_count <= 5 and after.total_rows == 20000


def test_file_statistics_and_orphans(spark, path):
    tables.append(spark.createDataFrame([(1, "a", "x"), (None, "b", "x")], DDL).coalesce(1), path, ["p"])
    stats = layout.column_stats(spark, path, ["k", "v"]).first()
    assert (stats.k_min, stats.k_nulls, stats.k_values, stats.v_min, stats.v_max) == (1, 1, 1, "a", "b")
    spread = spark.range(1, 13).select(F.col("id").cast("int").alias("k"))
    spread.repartition(4).write.parquet(path + "-n")
    merged = layout.merge_stats(layout.column_stats(spark, path + "-n", ["k"]), ["k"]).first()
    assert (merged.k_min, merged.k_max, merged.k_values) == (1, 12, 12)
    referenced = spark.createDataFrame(layout.row_counts(spark, path).collect())
    tables.append(spark.createDataFrame([(3, "c", "y")], DDL), path, ["p"])
    assert [r.partition for r in layout.orphan_files(layout.list_files(spark, path), referenced).collect()] == ["p=y"]


LOG = "k int, v string, version long, op string"


def change_log(spark):
    return spark.createDataFrame(
        [(1, "a", 1, "U"), (2, "b", 1, "U"), (1, "a2", 2, "U"), (2, None, 2, "D"), (3, "c", 3, "U"), (2, "b3", 3, "U")], LOG
    )


def test_history(spark, rows):
    log = change_log(spark)
    assert rows(history.as_of(log, ["k"], 2).select("k", "v")) == [(1, "a2")]
    undone = log.unionByName(history.rollback(log, ["k"], 1, 4))
    assert rows(history.as_of(undone, ["k"], 4).select("k", "v")) == [(1, "a"), (2, "b")]
    diff = history.diff_versions(history.as_of(log, ["k"], 1), history.as_of(log, ["k"], 3), ["k"], ["v"])
    assert rows(diff) == [(1, "changed"), (2, "changed"), (3, "added")]
    tags = spark.createDataFrame([("v1", 1), ("v2", 2)], "tag string, tagged_version long")
    assert rows(history.read_tag(log, tags, "v1", ["k"]).select("k", "v")) == [(1, "a"), (2, "b")]
    delta = spark.createDataFrame([(1, None, 9, "D"), (7, "n", 9, "U")], LOG)
    assert rows(history.branch_view(history.as_of(log, ["k"], 3), delta, ["k"]).select("k", "v")) == [
        (2, "b3"), (3, "c"), (7, "n"),
    ]
    commits = spark.createDataFrame(
        [(1, "Create t"), (2, "Update t"), (3, "Update t"), (4, "Update other")], "version long, message string"
    ).withColumn("committed_at", F.lit("2024-01-01").cast("timestamp"))
    got = history.version_log(log, commits, ["k"], " t").collect()
    assert [(r.version, r.rows_changed, r.row_count, r.column_count) for r in got] == [(3, 2, 3, 2), (2, 2, 1, 2), (1, 2, 2, 2)]


def test_evolution(spark, rows):
    steps = [
        evolve.AddColumn("c", "string"), evolve.RenameColumn("a", "b"), evolve.WidenColumn("b", "bigint"),
        evolve.DropColumn("d"), evolve.ReorderColumns(("c",)),
    ]
    old = spark.createDataFrame([(1, "x")], "a int, d string")
    new = spark.createDataFrame([("n", 2)], "c string, b long")
    assert evolve.conform(old, steps).columns == ["c", "b"]
    assert rows(evolve.read_generations([(old, 0), (new, 5)], steps)) == [("n", 2), (None, 1)]
    with pytest.raises(ValueError):
        evolve.conform(new, [evolve.WidenColumn("b", "int")])


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (None, "a")], "k int, v string")
    assert rows(quality.check_unique(df, ["k"])) == [(1, 2)]
    assert quality.check_not_null(df, ["k", "v"]).count() == 3
    assert rows(quality.check_accepted(df, "v", ["a"])) == [(1, "b")]
    report = quality.column_report(df, ["k", "v"], {"v": ["a"]})
    assert rows(report) == [("accepted_values", "v", 1), ("not_null", "k", 2), ("not_null", "v", 1)]
    clean = spark.createDataFrame([(5, "a")], "k int, v string")
    assert quality.check_unique(clean, ["k"]).isEmpty() and quality.check_not_null(clean, ["k", "v"]).isEmpty()
    same = quality.reconcile(df, df.repartition(3)).first()
    assert same.same_content and not quality.reconcile(df, df.limit(4)).first().same_content
    parent = spark.createDataFrame([(1, dt.datetime(2024, 1, 2))], "pk int, born timestamp")
    child = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (9, dt.datetime(2024, 1, 1))], "ck int, at timestamp")
    assert rows(quality.check_orphans(child, parent, "ck", "pk").select("ck")) == [(9,)]
    assert rows(quality.check_temporal(child, parent, "ck", "pk", "at", "born").select("ck")) == [(1,)]


def test_catalog(spark, tmp_path):
    root = str(tmp_path)
    tables.append(spark.createDataFrame([(1, "a", "x")], DDL), lake.table_path(root, "shop", "silver", "t"))
    name = lake.register_table(spark, root, "shop", "silver", "t")
    assert lake.register_table(spark, root, "shop", "silver", "t") == name
    assert ("shop_silver", "t") in [tuple(r) for r in lake.list_tables(spark).collect()]
    assert spark.table(name).count() == 1
    spark.sql(f"DROP TABLE {name}")
    assert not lake.table_exists(spark, f"{root}/missing")


def test_streams_restart_and_upsert(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "user int, event int, ts timestamp"

    def land(*data):
        spark.createDataFrame(data, schema).write.mode("append").parquet(src)

    t = dt.datetime(2024, 1, 1)
    land((1, 1, t), (1, 2, t + dt.timedelta(hours=1)), (2, 3, t))
    stream = streams.file_stream(spark, src, spark.read.parquet(src).schema)
    for _ in range(2):  # the second run finds nothing new
        streams.upsert_stream(stream, out, state, ["user"], [F.desc("ts")]).awaitTermination()
        assert read(spark, out, "user", "event") == [(1, 2), (2, 3)]
    land((2, 4, t + dt.timedelta(hours=2)), (3, 5, t), (1, 6, t - dt.timedelta(hours=9)))
    streams.upsert_stream(stream, out, state, ["user"], [F.desc("ts")]).awaitTermination()
    assert read(spark, out, "user", "event") == [(1, 2), (2, 4), (3, 5)]  # event 6 came too late


def test_versions_over_several_stretches(spark, monkeypatch):
    monkeypatch.setattr(history, "STRETCH", 3)
    versions = [1, 2, 4, 8, 9, 15]
    log = spark.createDataFrame([(n, "v", v, "U") for n, v in enumerate(versions)], LOG)
    commits = spark.createDataFrame([(v, f"c{v}") for v in versions], "version long, message string").withColumn(
        "committed_at", F.lit("2024-01-01").cast("timestamp"))
    got = history.version_log(log, commits, ["k"], "c").collect()
    assert [(r.version, r.row_count) for r in got] == [(v, n + 1) for n, v in reversed(list(enumerate(versions)))]
    parents = {r.version: r.parent for r in history.snapshots(log, commits).collect()}
    assert parents == dict(zip(versions, [None, *versions]))
    with pytest.raises(Exception, match="no tag"):
        history.read_tag(log, spark.createDataFrame([("a", 1)], "tag string, tagged_version long"), "b", ["k"]).collect()
