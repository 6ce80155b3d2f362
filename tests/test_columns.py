import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar
from tidemark.functions import columns as c

D = dt.date


def values(spark, data, ddl, column):
    return [r[0] for r in spark.createDataFrame(data, ddl).coalesce(1).select(column).collect()]


def test_age_band_edges(spark):
    ref = "2024-06-15"
    born = [
        (D(1999, 6, 15), 25), (D(1999, 6, 16), 24), (D(1999, 6, 14), 25), (D(1989, 6, 15), 35),
        (D(1989, 6, 16), 34), (D(1979, 6, 15), 45), (D(1979, 6, 16), 44), (D(1969, 6, 15), 55),
        (D(1969, 6, 16), 54), (None, None),
    ]
    df = [(b,) for b, _ in born]
    assert values(spark, df, "b date", c.age_on("b", ref)) == [a for _, a in born]
    bands = ["25-34", "<25", "25-34", "35-44", "25-34", "45-54", "35-44", "55+", "45-54", None]
    assert values(spark, df, "b date", c.age_band("b", ref)) == bands


def test_leap_day_birthday_falls_on_first_of_march(spark):
    df = [(D(2000, 2, 29),)]
    assert values(spark, df, "b date", c.age_on("b", "2023-02-28")) == [22]
    assert values(spark, df, "b date", c.age_on("b", "2023-03-01")) == [23]
    assert values(spark, df, "b date", c.age_on("b", "2024-02-29")) == [24]


def test_magnitude_thresholds(spark):
    mags = [None, -0.5, 1.99, 2.0, 3.99, 4.0, 5.0, 6.0, 7.0, 7.99, 8.0]
    want = [None, "micro", "micro", "minor", "minor", "light", "moderate", "strong", "major", "major", "great"]
    assert values(spark, [(m,) for m in mags], "m double", c.magnitude_class("m")) == want


def test_pm25_thresholds_are_inclusive(spark):
    means = [None, 5.0, 5.01, 15.0, 25.0, 35.0, 45.0, 45.01]
    want = [
        None, "good", "moderate", "moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy", "hazardous",
    ]
    assert values(spark, [(m,) for m in means], "m double", c.pm25_category("m")) == want
    other = c.pm25_category(F.col("m"), F.lit("no2"))
    assert values(spark, [(3.0,)], "m double", other) == [None]


def test_card_expiry_keeps_its_month(spark):
    cards = [(2024, 6), (2024, 5), (2023, 12), (2025, 1), (None, None), (2023, None), (2024, None)]
    want = [False, True, True, False, None, True, None]
    assert values(spark, cards, "y int, m int", c.card_expired("y", "m", "2024-06-30")) == want


def test_record_hash_variants(spark):
    data = [(None, "x"), ("", "x"), ("a||b", "c"), ("a", "b||c")]
    plain = values(spark, data, "a string, b string", c.record_hash(["a", "b"]))
    safe = values(spark, data, "a string, b string", c.record_hash(["a", "b"], null_safe=True))
    assert plain[0] == plain[1] and plain[2] == plain[3]
    assert len(set(safe)) == 4


def test_lookup_and_unknown_member(spark):
    methods = [("PASSWORD",), ("MFA_SMS",), ("pigeon",), (None,)]
    assert values(spark, methods, "m string", c.auth_method_family("m")) == ["password", "mfa", "other", "other"]
    assert values(spark, methods, "m string", c.known_or_unknown("m"))[-1] == "-1"


def test_ratio_percent_and_mean(spark):
    assert values(spark, [(10, 0), (10, 4)], "a int, b int", c.safe_ratio("a", "b", 0.0)) == [0.0, 2.5]
    shares = values(spark, [(1, 0), (1, 3), (1, 8), (1, 16)], "a int, b int", c.percent("a", "b").cast("string"))
    assert shares == [None, "33.33", "12.50", "6.25"]
    df = spark.sql("SELECT CAST(x AS DECIMAL(4,2)) AS x FROM VALUES (1.00), (1.01), (NULL) AS t(x)")
    assert str(df.agg(c.exact_mean("x", 2)).first()[0]) == "1.01"
    assert df.where("false").agg(c.exact_mean("x", 2), c.sum_or_zero("x")).first()[0] is None


def test_raw_payload_keeps_or_drops_nulls(spark):
    df = [(1, None)]
    assert values(spark, df, "a int, b string", c.raw_payload(["a", "b"])) == ['{"a":1,"b":null}']
    assert values(spark, df, "a int, b string", c.raw_payload(["a", "b"], keep_nulls=False)) == ['{"a":1}']


@pytest.mark.parametrize(
    "day, want",
    [
        ("2024-12-30", (2024, 4, 12, 30, 1, 2, "Monday", 1, False)),
        ("2024-03-03", (2024, 1, 3, 3, 7, 1, "Sunday", 9, True)),
        ("2024-02-29", (2024, 1, 2, 29, 4, 5, "Thursday", 9, False)),
    ],
)
def test_calendar(spark, day, want):
    row = calendar.dim_date(spark, day, day).first()
    names = ["year", "quarter", "month", "day", "day_of_week", "day_of_week_us", "day_name", "iso_week", "is_weekend"]
    assert tuple(row[n] for n in names) == want


def test_calendar_of_nothing_is_empty(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    assert calendar.dim_date_observed(empty, "ts").count() == 0
    assert calendar.dim_date(spark, "2024-01-01", "2024-12-31").count() == 366
