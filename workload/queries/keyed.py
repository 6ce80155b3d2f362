"""Keyed operators over lineitem and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import keyed
from workload.frames import Frames
from workload.registry import query

# Target: orders before 1999. Source: orders from 1998 on; those in the target twice a week change price.
TARGET = "(SELECT * FROM {orders} WHERE o_orderdate < DATE '1999-01-01')"
SOURCE = """(SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
    FROM {orders} WHERE o_orderdate >= DATE '1998-01-01')"""
ORDER = "o_orderkey:i o_custkey:i o_orderstatus o_totalprice:n o_orderdate:t o_orderpriority"


def target(f: Frames):
    return f.orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp"))


def source(f: Frames):
    recent = f.orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"))
    price = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return recent.withColumn("o_totalprice", price)


@query(
    "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_quantity:n l_extendedprice:n l_shipdate:t",
    """SELECT * FROM {lineitem} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def dedup_latest(f: Frames):
    order = [F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey")]
    return keyed.latest_per_key(f.lineitem, ["l_orderkey", "l_linenumber"], order)


@query(
    "user_id:i event_id:i ts:t",
    "SELECT * FROM {events} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1",
)
def first_per_key(f: Frames):
    return keyed.latest_per_key(f.events, ["user_id"], [F.asc("ts"), F.asc("event_id")])


@query(
    ORDER,
    f"""SELECT * FROM {SOURCE} UNION ALL SELECT * FROM {TARGET} t
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {SOURCE})""",
)
def upsert_scd1(f: Frames):
    return keyed.upsert(target(f), source(f), ["o_orderkey"])


@query(
    "rows_inserted:i rows_updated:i rows_unchanged:i",
    f"""SELECT COUNT(*) FILTER (t.o_orderkey IS NULL) AS rows_inserted,
        COUNT(*) FILTER (t.o_totalprice <> s.o_totalprice) AS rows_updated,
        COUNT(*) FILTER (t.o_totalprice = s.o_totalprice) AS rows_unchanged
        FROM {SOURCE} s LEFT JOIN {TARGET} t ON s.o_orderkey = t.o_orderkey""",
)
def upsert_counts(f: Frames):
    return keyed.upsert_counts(target(f), source(f), ["o_orderkey"])


@query(ORDER, "SELECT * FROM {orders} WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 250000)")
def delete_where(f: Frames):
    return keyed.delete_where(f.orders, (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 250000))


@query(
    "l_orderkey:i l_linenumber:i l_suppkey:i l_quantity:n",
    """SELECT * FROM {lineitem} WHERE l_orderkey NOT IN (SELECT l_orderkey FROM {lineitem} WHERE l_returnflag = 'R')
        UNION ALL SELECT * REPLACE (0 AS l_quantity) FROM {lineitem} WHERE l_returnflag = 'R'""",
)
def replace_by_key(f: Frames):
    corrected = f.lineitem.where(F.col("l_returnflag") == "R").withColumn("l_quantity", F.lit(0.0))
    return keyed.replace_by_key(f.lineitem, corrected, ["l_orderkey"])


@query(
    ORDER,
    f"""SELECT * FROM {TARGET} UNION ALL SELECT * FROM {SOURCE} s
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {TARGET})""",
)
def insert_if_absent(f: Frames):
    return keyed.insert_if_absent(target(f), source(f), ["o_orderkey"], [F.desc("o_totalprice")])


@query(
    "o_orderkey:i o_totalprice:n",
    f"""SELECT s.* FROM {SOURCE} s LEFT JOIN {TARGET} t ON s.o_orderkey = t.o_orderkey
        WHERE t.o_orderkey IS NULL OR t.o_totalprice <> s.o_totalprice""",
)
def changed_rows(f: Frames):
    columns = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    current = keyed.with_record_hash(target(f), columns)
    return keyed.changed_rows(keyed.with_record_hash(source(f), columns), current, ["o_orderkey"])
