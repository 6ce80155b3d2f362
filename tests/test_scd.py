import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import scd

LAX = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
SRC = "nk string, a string, note string"
END = dt.datetime(9999, 12, 31)


def day(n):
    return dt.date(2024, 1, n)


def ts(n):
    return dt.datetime(2024, 1, n)


def start(spark, data, on):
    return scd.open_versions(spark.createDataFrame(data, SRC), "nk", ["a"], on, "sk")


def step(spark, dim, data, on, **kw):
    return scd.scd2_apply(dim, spark.createDataFrame(data, SRC), "nk", ["a"], on, "sk", **kw)


def history(dim):
    cols = ["nk", "a", "_effective_from", "_effective_to", "_is_current"]
    return sorted((tuple(r) for r in dim.select(*cols).collect()), key=str)


def test_daily_steps(spark):
    dim = start(spark, [("u1", "x", "n"), ("u2", "x", "n"), ("u3", None, "n")], day(1))
    dim = step(spark, dim, [("u1", "y", "n"), ("u3", "", "n"), ("u4", "z", "n")], day(3))
    assert history(dim) == [
        ("u1", "x", ts(1), ts(3), False), ("u1", "y", ts(3), END, True), ("u2", "x", ts(1), END, True),
        ("u3", None, ts(1), END, True),  # NULL and '' hash alike, so no new version
        ("u4", "z", ts(3), END, True),
    ]


def test_untracked_change_and_rerun_change_nothing(spark):
    dim = start(spark, [("u1", "x", "n")], day(1))
    later = step(spark, dim, [("u1", "x", "other")], day(2))
    assert later.collect() == dim.collect()
    changed = step(spark, dim, [("u1", "y", "n")], day(2))
    assert history(step(spark, changed, [("u1", "y", "n")], day(2))) == history(changed)


def test_second_change_on_one_day_replaces(spark):
    dim = start(spark, [("u1", "x", "n")], day(1))
    dim = step(spark, dim, [("u1", "y", "n")], day(2))
    dim = step(spark, dim, [("u1", "z", "n")], day(2))
    assert history(dim) == [("u1", "x", ts(1), ts(2), False), ("u1", "z", ts(2), END, True)]
    assert dim.select("sk").distinct().count() == 2


def test_out_of_order_day_is_ignored(spark):
    dim = start(spark, [("u1", "x", "n")], day(5))
    assert history(step(spark, dim, [("u1", "y", "n")], day(3))) == [("u1", "x", ts(5), END, True)]


def test_vanished_key_closes_on_request_and_may_return(spark):
    dim = start(spark, [("u1", "x", "n"), ("u2", "x", "n")], day(1))
    dim = step(spark, dim, [("u2", "x", "n")], day(2), close_missing=True)
    dim = step(spark, dim, [("u1", "x", "n"), ("u2", "x", "n")], day(4), close_missing=True)
    assert history(dim) == [
        ("u1", "x", ts(1), ts(2), False), ("u1", "x", ts(4), END, True), ("u2", "x", ts(1), END, True),
    ]


STATES = st.dictionaries(
    st.tuples(st.integers(1, 5), st.sampled_from(["u1", "u2", "u3"])), st.sampled_from(["x", "y"]), min_size=1, max_size=12
)


@LAX
@given(states=STATES)
def test_folding_days_equals_rebuild(spark, states):
    dated = spark.createDataFrame([(day(d), k, a, "n") for (d, k), a in states.items()], "day date, " + SRC)
    rebuilt = scd.scd2_rebuild(dated, "nk", ["a"], "day")
    dim = None
    for d in sorted({d for d, _ in states}):
        data = [(k, a, "n") for (on, k), a in states.items() if on == d]
        folded = start(spark, data, day(d)) if dim is None else step(spark, dim, data, day(d))
        dim = spark.createDataFrame(folded.collect(), folded.schema)
    assert history(dim) == history(rebuilt)
    by_key = {}
    for nk, _, lo, hi, current in history(rebuilt):
        by_key.setdefault(nk, []).append((lo, hi, current))
    for spans in map(sorted, by_key.values()):
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))  # no gap, no overlap
        assert [s[2] for s in spans] == [False] * (len(spans) - 1) + [True]


def _pit_case(spark, seed, hot_share):
    """Facts and versions; one key holds a share of all facts. Versions open within days and may leave gaps."""
    rnd = random.Random(seed)
    versions, facts = [], []
    for k in ["hot", "u1", "u2"]:
        at = sorted(rnd.sample(range(0, 10 * 1440), 14))
        for i, m in enumerate(at):
            end = at[i + 1] if i + 1 < len(at) else None
            if i == 6:
                end = m + 5  # a gap after this version
            versions.append((k, ts(1) + dt.timedelta(minutes=m), END if end is None else ts(1) + dt.timedelta(minutes=end), f"{k}-{i}"))
    edges = [v[1] for v in versions] + [v[2] for v in versions if v[2] != END]
    for i in range(300):
        key = "hot" if rnd.random() < hot_share else rnd.choice(["u1", "u2", "gone", None])
        at = rnd.choice(edges) if i % 3 == 0 else ts(1) + dt.timedelta(minutes=rnd.randrange(-600, 12 * 1440))
        facts.append((i, key, at if i % 50 else None))
    def hit(f):
        if f[1] is None or f[2] is None:
            return "-1"
        return next((v[3] for v in versions if v[0] == f[1] and v[1] <= f[2] < v[2]), "-1")

    dim = spark.createDataFrame(versions, "nk string, _effective_from timestamp, _effective_to timestamp, sk string")
    fact = spark.createDataFrame(facts, "id int, user_id string, at timestamp")
    return fact, dim, sorted((f[0], hit(f)) for f in facts)


def test_pit_join_matches_brute_force(spark):
    for seed, unit in ((1, "day"), (2, "hour"), (3, "month")):
        fact, dim, want = _pit_case(spark, seed, 0.6)
        sliced = scd.pit_join(fact, dim, "user_id", "at", "nk", slice_unit=unit)
        direct = scd.pit_join_direct(fact, dim, "user_id", "at", "nk")
        assert sorted((r.id, r.sk) for r in sliced.collect()) == want
        assert sorted((r.id, r.sk) for r in direct.collect()) == want


def test_pit_join_has_no_window_over_facts(spark):
    fact, dim, _ = _pit_case(spark, 4, 0.6)
    plan = scd.pit_join(fact, dim, "user_id", "at", "nk")._jdf.queryExecution().optimizedPlan().toString()
    # The window input is made of distinct (key, slice) pairs and one version per slice.
    below = plan[plan.index("Window ["):]
    assert below.count("Aggregate [") >= 2
    assert "CartesianProduct" not in plan and "Cross" not in plan


def test_null_key_over_three_runs(spark, rows):
    """NULL opens, keeps and closes versions like any other key."""
    source = lambda *states: spark.createDataFrame(list(states), "id string, v string")
    dim = scd.open_versions(source(("1", "a"), (None, "b")), "id", ["v"], "2024-01-01", "sk")
    for day, states in (("2024-01-02", [("1", "a"), (None, "b")]), ("2024-01-03", [("1", "a"), (None, "c")]), ("2024-01-04", [("2", "d")])):
        dim = scd.scd2_apply(dim, source(*states), "id", ["v"], day, "sk", close_missing=day.endswith("04"))
    got = rows(dim.selectExpr("id", "v", "date(_effective_from) || ''", "date(_effective_to) || ''", "_is_current"))
    assert got == sorted([
        (None, "b", "2024-01-01", "2024-01-03", False), (None, "c", "2024-01-03", "2024-01-04", False),
        ("1", "a", "2024-01-01", "2024-01-04", False), ("2", "d", "2024-01-04", "9999-12-31", True)], key=str)


@LAX
@given(states=STATES, seed=st.integers(0, 99))
def test_days_in_any_order_equal_rebuild(spark, states, seed):
    """NULL stands for one of the keys."""
    schema = "day date, " + SRC
    rows = [(day(d), None if k == "u3" else k, a, f"{d}") for (d, k), a in states.items()]
    rebuilt = scd.scd2_rebuild(spark.createDataFrame(rows, schema), "nk", ["a"], "day")
    days = sorted({r[0] for r in rows})
    random.Random(seed).shuffle(days)
    dim, known = None, []
    for on in days:
        src = [r[1:] for r in rows if r[0] == on]
        before = spark.createDataFrame(known, schema)
        late = start(spark, src, on) if dim is None else scd.scd2_splice(
            dim, before, spark.createDataFrame(src, SRC), "nk", ["a"], "day", on)
        dim = spark.createDataFrame(late.collect(), late.schema)
        known += [r for r in rows if r[0] == on]
    assert sorted(map(str, dim.collect())) == sorted(map(str, rebuilt.select(*dim.columns).collect()))


def test_late_day_repeated_with_other_values(spark):
    schema = "day date, " + SRC
    rows = [(day(1), "u1", "x", "n"), (day(5), "u1", "x", "n"), (day(9), "u1", "z", "n")]
    dim = scd.scd2_rebuild(spark.createDataFrame(rows, schema), "nk", ["a"], "day")
    known = spark.createDataFrame(rows, schema)
    for a in ("y", "w", "x"):
        dim = scd.scd2_splice(dim, known, spark.createDataFrame([("u1", a, "n")], SRC), "nk", ["a"], "day", day(3))
        dim = spark.createDataFrame(dim.collect(), dim.schema)
        known = spark.createDataFrame([*rows, (day(3), "u1", a, "n")], schema)
        middle = [] if a == "x" else [("u1", a, ts(3), ts(5), False), ("u1", "x", ts(5), ts(9), False)]
        first = ("u1", "x", ts(1), ts(9) if a == "x" else ts(3), False)
        assert history(dim) == sorted([first, *middle, ("u1", "z", ts(9), END, True)], key=str)
