"""Database reads described by a TableSpec."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.specs import TableSpec


def source_query(spec: TableSpec, day: dt.date | str) -> str:
    """SELECT for one run: all rows of a snapshot table, one day of an incremental one.

    A day is a half-open range on the bare column, so a database index on it serves
    the filter.
    """
    columns = ", ".join(
        f"CAST({c} AS text) AS {c}" if c in spec.text_columns else c for c in spec.source_columns
    )
    query = f"SELECT {columns} FROM {spec.source_table}"
    if spec.mode == "snapshot":
        return query
    if not spec.day_column:
        raise ValueError(f"incremental table {spec.name} needs a day column")
    first = dt.date.fromisoformat(str(day))
    until = first + dt.timedelta(days=1)
    kind = "DATE" if spec.schema[spec.day_column].dataType.typeName() == "date" else "TIMESTAMP"
    return (
        f"{query} WHERE {spec.day_column} >= {kind} '{first}' AND {spec.day_column} < {kind} '{until}'"
    )


def read_options(
    spec: TableSpec, day: dt.date | str, url: str, partitions: int = 1, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options of the JDBC read. Incremental tables split the day by their time column."""
    options = {
        "url": url,
        "dbtable": f"({source_query(spec, day)}) AS t",
        "fetchsize": str(fetch_size),
    }
    splits = spec.mode == "incremental" and spec.schema[spec.day_column].dataType.typeName() == "timestamp"
    if partitions > 1 and splits:
        first = dt.date.fromisoformat(str(day))
        options |= {
            "partitionColumn": spec.day_column,
            "lowerBound": f"{first} 00:00:00",
            "upperBound": f"{first + dt.timedelta(days=1)} 00:00:00",
            "numPartitions": str(partitions),
        }
    return options


def key_predicates(keys: Sequence[str], partitions: int) -> list[str]:
    """Predicates that split a snapshot table by a hash of its text keys (Postgres)."""
    text = " || '|' || ".join(f"CAST({k} AS text)" for k in keys)
    return [f"mod(abs(hashtext({text})::bigint), {partitions}) = {i}" for i in range(partitions)]


def jdbc_read(
    spark: SparkSession,
    spec: TableSpec,
    day: dt.date | str,
    url: str,
    properties: dict[str, str],
    partitions: int = 1,
) -> DataFrame:
    """The source rows of one run, read by `partitions` parallel connections."""
    options = read_options(spec, day, url, partitions)
    if partitions > 1 and spec.mode == "snapshot":
        predicates = key_predicates(spec.keys, partitions)
        settings = {**properties, "fetchsize": options["fetchsize"]}
        return spark.read.jdbc(url, options["dbtable"], predicates=predicates, properties=settings)
    return spark.read.format("jdbc").options(**options, **properties).load()
