"""Registering a query next to its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.frames import Frames, names_in, present
from workload.views import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Output column kinds, written name:kind in an oracle's column list.
KINDS = {
    "s": "{0}",
    "d": "strftime({0}, '%Y-%m-%d')",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
    "n": "round(CAST({0} AS DOUBLE), 6)",
    "i": "CAST({0} AS BIGINT)",
    "b": "CAST(CAST({0} AS INT) AS BIGINT)",
}


def _with_views(body: str) -> str:
    """The body after a WITH list of every view it needs, in order of use."""
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for name in names_in(text):
            if name in VIEWS and name not in needed:
                add(VIEWS[name])
                needed[name] = VIEWS[name].format(**{n: n for n in names_in(VIEWS[name])})

    add(body)
    text = body.format(**{n: n for n in names_in(body)})
    views = ", ".join(f"{name} AS ({sql})" for name, sql in needed.items())
    return f"WITH {views} {text}" if views else text


def query(out: str | None = None, oracle: str | None = None):
    """Register a function Frames -> DataFrame under its own name.

    out lists the result columns with their kinds; oracle is DuckDB SQL that has
    (at least) these columns.
    """
    def register(build: Callable[[Frames], DataFrame]):
        columns = [c.partition(":")[::2] for c in (out or "").split()]
        names = [c for c, _ in columns]
        doubles = frozenset(c for c, kind in columns if kind == "n")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            result = build(Frames(spark, folder))
            return present(result.select(*names) if names else result, doubles)

        QUERIES[build.__name__] = run
        if oracle:
            kinds = ", ".join(f"{KINDS[k or 's'].format(c)} AS {c}" for c, k in columns)
            ORACLES[build.__name__] = _with_views(f"SELECT {kinds} FROM ({oracle}) AS result")
        return build

    return register


def latest(view: str, keys: str, order: str) -> str:
    """Oracle text for the latest row per key."""
    return f"(SELECT * FROM {{{view}}} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1)"


def pct(part: str, whole: str) -> str:
    """Oracle text: percent to two decimals, half up, by integer arithmetic."""
    return f"((20000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole})) / 100"


def mean(value: str, scale: int, digits: int) -> str:
    """Oracle text: mean of a non-negative decimal of the given scale, half up to digits."""
    total = f"(CAST(SUM({value}) * {10 ** scale} AS HUGEINT) * {10 ** digits})"
    count = f"(COUNT({value}) * {10 ** scale})"
    return f"((2 * {total} + {count}) // (2 * {count})) / {10 ** digits}"
