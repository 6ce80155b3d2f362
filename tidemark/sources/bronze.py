"""From source rows to a bronze table's declared shape."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import as_date, as_timestamp, iso_text, raw_payload
from tidemark.specs import TableSpec


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in declared order and type; a NULL in a required column fails the job.

    The null check is part of the projection, so it costs no second pass.
    """
    def field(f: T.StructField):
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            message = F.lit(f"required column {f.name} is NULL")
            value = F.when(value.isNull(), F.raise_error(message).cast(f.dataType)).otherwise(value)
        return value.alias(f.name)

    return df.select(*[field(f) for f in schema])


def _payload(spec: TableSpec) -> Column:
    def iso(f: T.StructField) -> Column:
        match f.dataType:
            case T.TimestampType():
                return iso_text(f.name).alias(f.name)
            case T.DecimalType():
                return F.col(f.name).cast(f.dataType).cast("string").alias(f.name)
        return F.col(f.name)

    if not spec.payload_iso:
        return raw_payload(spec.source_columns, keep_nulls=False)
    return raw_payload([iso(spec.schema[c]) for c in spec.source_columns])


def to_bronze(
    rows: DataFrame,
    spec: TableSpec,
    logical_date: dt.date | str,
    run_ts: dt.datetime | str,
    run_id: str | None = None,
) -> DataFrame:
    """Source rows plus housekeeping columns, aligned to the table's declared schema."""
    source = list(spec.source_columns)
    landed = rows.select(
        *source,
        as_timestamp(run_ts).alias("ingest_ts"),
        as_date(logical_date).alias("logical_date"),
        F.lit(spec.source_name).alias("source"),
        _payload(spec).alias("raw_payload"),
        F.lit(run_id).cast("string").alias("_ingest_run_id"),
        F.lit(spec.source_name).alias("_source_system"),
    )
    return align(landed, spec.schema)
