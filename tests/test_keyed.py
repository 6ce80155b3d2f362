import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import keyed

DDL = "k int, v string, n int"
LAX = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))


def test_latest_per_key_with_equal_ingest_time(spark, rows):
    t = dt.datetime(2024, 1, 1)
    data = [(1, t, "a"), (1, t, "b"), (1, t - dt.timedelta(hours=1), "z"), (2, t, "c"), (None, t, "n"), (None, t, "m")]
    df = spark.createDataFrame(data, "k int, ts timestamp, v string")
    latest = keyed.latest_per_key(df, ["k"], [F.desc("ts"), F.desc("v")])
    assert rows(latest.select("k", "v")) == [(1, "b"), (2, "c"), (None, "n")]


def test_upsert_new_changed_unchanged_and_null(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", None), (None, "n", 0)], DDL)
    source = spark.createDataFrame([(2, "b", 2), (3, "c", None), (4, "d", 4)], DDL)
    merged = keyed.upsert(target, source, ["k"])
    assert rows(merged) == [(1, "a", 1), (2, "b", 2), (3, "c", None), (4, "d", 4), (None, "n", 0)]
    assert keyed.upsert_counts(target, source, ["k"]).first().asDict() == {
        "rows_inserted": 1, "rows_updated": 1, "rows_unchanged": 1,
    }


def test_upsert_is_by_name_not_position(spark, rows):
    target = spark.createDataFrame([(1, "a", 1)], DDL)
    source = spark.createDataFrame([(9, 1, "b")], "n int, k int, v string")
    assert rows(keyed.upsert(target, source, ["k"])) == [(1, "b", 9)]


def test_delete_keeps_unknown(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 9)], DDL)
    assert rows(keyed.delete_where(df, F.col("n") > 5).select("k")) == [(1,), (2,)]


def test_insert_if_absent_and_replace_by_key(spark, rows):
    target = spark.createDataFrame([(1, "a", 1)], DDL)
    source = spark.createDataFrame([(1, "x", 9), (2, "p", 1), (2, "q", 2)], DDL)
    assert rows(keyed.insert_if_absent(target, source, ["k"], [F.desc("n")])) == [(1, "a", 1), (2, "q", 2)]
    assert rows(keyed.replace_by_key(target, source, ["k"])) == [(1, "x", 9), (2, "p", 1), (2, "q", 2)]


def test_changed_rows(spark, rows):
    current = keyed.with_record_hash(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], DDL), ["v", "n"])
    source = keyed.with_record_hash(spark.createDataFrame([(1, "a", 1), (2, "B", 2), (3, "c", 3)], DDL), ["v", "n"])
    assert rows(keyed.changed_rows(source, current, ["k"]).select("k")) == [(2,), (3,)]


KEYED = st.dictionaries(st.integers(0, 8), st.tuples(st.text("ab", max_size=2), st.integers(0, 3)), max_size=8)


@LAX
@given(target=KEYED, source=KEYED)
def test_upsert_like_a_dictionary_update(spark, target, source):
    def frame(d):
        return spark.createDataFrame([(k, v, n) for k, (v, n) in d.items()], DDL)

    once = keyed.upsert(frame(target), frame(source), ["k"])
    twice = keyed.upsert(once, frame(source), ["k"])
    want = sorted((k, v, n) for k, (v, n) in {**target, **source}.items())
    assert sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in twice.collect()) == want


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = keyed.latest_per_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
