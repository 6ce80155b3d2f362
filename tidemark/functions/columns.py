"""Derived columns. Every function returns a Column and stays inside codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Upper age bound (exclusive) and label; the last band is open.
AGE_BANDS = [(25, "<25"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
AGE_BAND_LAST = "55+"
# Upper magnitude bound (exclusive) and label; the last class is open.
MAGNITUDE_BANDS = [
    (2.0, "micro"),
    (4.0, "minor"),
    (5.0, "light"),
    (6.0, "moderate"),
    (7.0, "strong"),
    (8.0, "major"),
]
MAGNITUDE_LAST = "great"
# Upper PM2.5 daily mean (inclusive, in micrograms per cubic metre) and label.
PM25_BANDS = [
    (5, "good"),
    (15, "moderate"),
    (25, "unhealthy_sensitive"),
    (35, "unhealthy"),
    (45, "very_unhealthy"),
]
PM25_LAST = "hazardous"
# Login method and the family it belongs to.
AUTH_METHOD_FAMILIES = {
    "PASSWORD": "password",
    "OAUTH_GOOGLE": "oauth",
    "OAUTH_GITHUB": "oauth",
    "OAUTH_MICROSOFT": "oauth",
    "MFA_TOTP": "mfa",
    "MFA_SMS": "mfa",
    "MAGIC_LINK": "passwordless",
}
AUTH_METHOD_DEFAULT = "other"
UNKNOWN_MEMBER = "-1"
# ----------------------------------------------------------------------------

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(day: dt.date | str | Column) -> Column:
    """A date literal from a date or ISO text; columns pass through."""
    return day if isinstance(day, Column) else F.lit(str(day)).cast("date")


def as_timestamp(ts: dt.datetime | dt.date | str | Column) -> Column:
    """A UTC timestamp literal; columns pass through."""
    return ts if isinstance(ts, Column) else F.lit(str(ts)).cast("timestamp")


def _banded(value: Column, bands: Sequence[tuple], last: str, inclusive: bool) -> Column:
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in bands:
        label = label.when(value <= bound if inclusive else value < bound, name)
    return label.otherwise(last)


def age_on(birthdate: ColumnOrName, day: dt.date | str | Column) -> Column:
    """Whole years on a day. A 29 February birthday falls on 1 March in common years."""
    birth, ref = _col(birthdate), as_date(day)

    def month_day(d: Column) -> Column:
        return F.month(d) * 100 + F.dayofmonth(d)

    before_birthday = (month_day(ref) < month_day(birth)).cast("int")
    return F.year(ref) - F.year(birth) - before_birthday


def age_band(birthdate: ColumnOrName, day: dt.date | str | Column) -> Column:
    return _banded(age_on(birthdate, day), AGE_BANDS, AGE_BAND_LAST, inclusive=False)


def magnitude_class(magnitude: ColumnOrName) -> Column:
    return _banded(_col(magnitude), MAGNITUDE_BANDS, MAGNITUDE_LAST, inclusive=False)


def pm25_category(mean: ColumnOrName, parameter: ColumnOrName | None = None) -> Column:
    """Category of a PM2.5 daily mean; NULL for every other parameter when one is given."""
    label = _banded(_col(mean), PM25_BANDS, PM25_LAST, inclusive=True)
    return label if parameter is None else F.when(_col(parameter) == "pm25", label)


def card_expired(year: ColumnOrName, month: ColumnOrName, day: dt.date | str | Column) -> Column:
    """A card is good through its expiry month. Unknown expiry gives NULL."""
    y, m, ref = _col(year), _col(month), as_date(day)
    return (y < F.year(ref)) | ((y == F.year(ref)) & (m < F.month(ref)))


def lookup(value: ColumnOrName, mapping: dict[str, str], default: str) -> Column:
    """Constant map lookup with a default."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(value)), F.lit(default))


def auth_method_family(method: ColumnOrName) -> Column:
    return lookup(method, AUTH_METHOD_FAMILIES, AUTH_METHOD_DEFAULT)


def iso_text(ts: ColumnOrName) -> Column:
    """ISO 8601 with offset; the fraction is written only if there is one."""
    t = _col(ts)
    whole = F.unix_micros(t) % 1_000_000 == 0
    return F.when(whole, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def raw_payload(columns: Sequence[ColumnOrName], keep_nulls: bool = True) -> Column:
    """The source row as JSON text."""
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*columns), options)


def record_hash(columns: Sequence[str], null_safe: bool = False) -> Column:
    """SHA-256 over the text of the columns.

    By default NULL hashes like the empty string. With null_safe every value is
    length-prefixed and NULL has its own mark, so no two rows share an input.
    """
    texts = [_col(c).cast("string") for c in columns]
    if null_safe:
        parts = [
            F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~"))
            for t in texts
        ]
    else:
        parts = [F.coalesce(t, F.lit("")) for t in texts]
    return F.sha2(F.concat_ws("||", *parts), 256)


def surrogate_key(*columns: ColumnOrName) -> Column:
    return F.md5(F.concat_ws("|", *[_col(c).cast("string") for c in columns]))


def known_or_unknown(key: ColumnOrName) -> Column:
    return F.coalesce(_col(key), F.lit(UNKNOWN_MEMBER))


def date_key(ts: ColumnOrName) -> Column:
    return F.date_format(_col(ts), "yyyyMMdd").cast("int")


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName, default=0) -> Column:
    """numerator / denominator where the denominator is positive, else the default."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d > 0, n / d).otherwise(F.lit(default))


def percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """Share in percent, two decimals, rounded half up; NULL when the whole is zero."""
    p, w = _col(part).cast("decimal(20,0)"), _col(whole).cast("decimal(20,0)")
    return F.round(F.lit(100).cast("decimal(3,0)") * p / F.nullif(w, F.lit(0)), 2)


def exact_mean(value: ColumnOrName, digits: int) -> Column:
    """Mean of a decimal, rounded once, half up. The running sum keeps the input's scale,
    so short decimals are added as plain longs."""
    v = _col(value)
    return F.round(F.sum(v) / F.nullif(F.count(v), F.lit(0)), digits)


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def sum_or_zero(value: ColumnOrName) -> Column:
    """Sum that is 0, not NULL, over no values."""
    return F.coalesce(F.sum(_col(value)), F.lit(0))
