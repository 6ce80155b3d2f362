"""Table mutation on storage, history, schema evolution, layout and quality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import evolve, history, quality
from tidemark.operators.keyed import latest_per_key
from tidemark.sinks import file_stats as skipping
from tidemark.session import shared_folder, written_once
from tidemark.sinks import checksum_tree, key_index, layout, positions, tables
from tidemark.sinks.version_store import VersionStore
from tidemark.sources import lake
from workload.frames import Frames
from workload.queries import keyed as keyed_queries
from workload.registry import query

ORDER = keyed_queries.ORDER
PRIORITY = ["o_orderpriority"]


def _written(f: Frames, df, partition, name="table") -> str:
    path = shared_folder(f.spark, name)
    tables.append(df, path, partition)
    return path


# --- sinks --------------------------------------------------------------------


@query(ORDER, "SELECT * FROM {orders} UNION ALL SELECT * FROM {orders} WHERE o_orderstatus = 'F'")
def sink_append(f: Frames):
    path = _written(f, f.orders, PRIORITY)
    tables.append(f.orders.where(F.col("o_orderstatus") == "F"), path, PRIORITY)
    return lake.read_table(f.spark, path)


@query(
    ORDER,
    """SELECT * FROM {orders} WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') UNION ALL
        SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM {orders}
        WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus = 'F'""",
)
def overwrite_slice(f: Frames):
    """Only the partitions of the new rows are replaced."""
    path = _written(f, f.orders, PRIORITY)
    new = lake.read_table(f.spark, path).where(
        F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & (F.col("o_orderstatus") == "F")
    )
    tables.overwrite_slice_checked(new.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, PRIORITY)
    return lake.read_table(f.spark, path)


@query(
    ORDER,
    """SELECT * FROM {orders} WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') UNION ALL
        SELECT * REPLACE (0 AS o_totalprice) FROM {orders} WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'""",
)
def overwrite_compound_slice(f: Frames):
    """Replace where two columns match, by partitioning on both."""
    path = _written(f, f.orders, [*PRIORITY, "o_orderstatus"])
    low = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    new = lake.read_table(f.spark, path).where(low).withColumn("o_totalprice", F.lit(0.0))
    tables.overwrite_slice(new, path, [*PRIORITY, "o_orderstatus"])
    return lake.read_table(f.spark, path)


@query(ORDER, "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM {orders}")
def swap_full(f: Frames):
    """The whole table replaced by a result that reads it."""
    path = _written(f, f.orders, [])
    tables.swap_full(lake.read_table(f.spark, path).withColumn("o_totalprice", F.col("o_totalprice") + 1), path)
    return lake.read_table(f.spark, path)


UPSERTED = f"""SELECT * FROM {keyed_queries.SOURCE} UNION ALL SELECT * FROM {keyed_queries.TARGET} t
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {keyed_queries.SOURCE})"""


@query(ORDER, UPSERTED)
def upsert_table(f: Frames):
    path = _written(f, keyed_queries.target(f), PRIORITY)
    tables.upsert_table(keyed_queries.source(f), path, ["o_orderkey"], PRIORITY)
    return lake.read_table(f.spark, path)


@query(
    ORDER,
    """SELECT * REPLACE (CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1-URGENT' ELSE o_orderpriority END
        AS o_orderpriority) FROM {orders}""",
)
def upsert_table_moving(f: Frames):
    """Keys that change partition; a partition left without rows disappears."""
    path = _written(f, f.orders, PRIORITY)
    moved = f.orders.where(F.col("o_orderpriority") == "2-HIGH").withColumn("o_orderpriority", F.lit("1-URGENT"))
    tables.upsert_table(moved, path, ["o_orderkey"], PRIORITY, moves=True)
    return lake.read_table(f.spark, path)


@query(
    ORDER,
    "SELECT * FROM {orders} WHERE NOT (o_orderpriority = '5-LOW' OR o_totalprice < 50000)",
)
def delete_from_table(f: Frames):
    path = _written(f, f.orders, PRIORITY)
    gone = (F.col("o_orderpriority") == "5-LOW") | (F.col("o_totalprice") < 50000)
    tables.delete_from_table(f.spark, path, gone, PRIORITY)
    return lake.read_table(f.spark, path)


# Orders whose partition is NULL, needs escaping or looks like a number.
NAMED = """(SELECT * REPLACE (CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'a:b' WHEN '3-MEDIUM' THEN 'REG AIR'
    WHEN '4-NOT SPECIFIED' THEN '01' ELSE '1' END AS o_orderpriority) FROM {orders})"""


def _named(f: Frames):
    p = F.col("o_orderpriority")
    value = F.when(p == "2-HIGH", "a:b").when(p == "3-MEDIUM", "REG AIR").when(p == "4-NOT SPECIFIED", "01").when(p == "5-LOW", "1")
    return f.orders.withColumn("o_orderpriority", value)


@query(
    ORDER,
    f"""SELECT * REPLACE (o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS o_totalprice,
        CASE WHEN o_orderkey % 7 = 0 AND o_orderpriority = 'a:b' THEN NULL ELSE o_orderpriority END AS o_orderpriority)
        FROM {NAMED}""",
)
def upsert_null_partition(f: Frames):
    """Some rows of every partition replaced, those of one moved to the NULL partition."""
    path = _written(f, _named(f), PRIORITY)
    seventh = _named(f).where(F.col("o_orderkey") % 7 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    moved = seventh.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("a:b")))
    tables.upsert_table(moved, path, ["o_orderkey"], PRIORITY, moves=True)
    return lake.read_table(f.spark, path, schema=moved.schema)


@query(
    ORDER,
    f"""SELECT * FROM {NAMED} WHERE o_orderpriority = '1' OR o_orderpriority = 'REG AIR' AND o_totalprice >= 50000""",
)
def delete_escaped_partition(f: Frames):
    """Whole partitions deleted: NULL, escaped and 01, but not 1; and part of one."""
    path, schema = _written(f, _named(f), PRIORITY), f.orders.schema
    p = F.col("o_orderpriority")
    gone = p.isNull() | p.isin("a:b", "01") | ((p == "REG AIR") & (F.col("o_totalprice") < 50000))
    tables.delete_from_table(f.spark, path, gone, PRIORITY, schema)
    return lake.read_table(f.spark, path, schema=schema)


@query(
    "day:d n:i first_load:b second_load:b",
    """SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n, TRUE AS first_load, FALSE AS second_load FROM {events}
        GROUP BY 1""",
)
def load_once(f: Frames):
    """A second load of a day that is already there writes nothing."""
    path = shared_folder(f.spark, "events")
    dated = f.events.withColumn("day", F.to_date("ts"))
    probe = F.to_date(F.lit("2024-01-15"))
    first = tables.load_once(dated, path, "day", probe, ["day"])
    second = tables.load_once(dated, path, "day", probe, ["day"])
    per_day = lake.read_table(f.spark, path).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return per_day.select("*", F.lit(first).alias("first_load"), F.lit(second).alias("second_load"))


# --- scans --------------------------------------------------------------------


@query(
    "event_id:i ts:t user_id:i",
    "SELECT * FROM {events} WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'",
)
def scan_day(f: Frames):
    events = lake.read_table(f.spark, f"{f.folder}/events.parquet", ["event_id", "ts", "user_id"])
    return lake.time_slice(events, "ts", "2024-01-10")


@query(
    "c_custkey:i c_mktsegment",
    "SELECT * FROM {customer} WHERE c_mktsegment = 'BUILDING'",
)
def scan_equal(f: Frames):
    customers = lake.read_table(f.spark, f"{f.folder}/customer.parquet", ["c_custkey", "c_mktsegment"])
    return customers.where(F.col("c_mktsegment") == "BUILDING")


# --- history ------------------------------------------------------------------

# A change log of one row per customer and year: the year's last order, deleted where that order failed cheaply.
LOG = """(SELECT o_custkey, o_orderkey, o_totalprice, year(o_orderdate) - 1994 AS version,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice < 250000 THEN 'D' ELSE 'U' END AS op FROM {orders}
    QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
STATE = "o_custkey:i o_orderkey:i o_totalprice:n version:i"


def _state(version: int) -> str:
    return f"""(SELECT * FROM (SELECT * FROM {LOG} WHERE version <= {version}
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY version DESC) = 1) WHERE op = 'U')"""


def log_of(f: Frames):
    yearly = f.orders.withColumn("version", (F.year("o_orderdate") - 1994).cast("long"))
    last = latest_per_key(yearly, ["o_custkey", "version"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    failed = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 250000)
    op = F.when(failed, "D").otherwise("U")
    return last.select("o_custkey", "o_orderkey", "o_totalprice", "version", op.alias("op"))


def commits_of(f: Frames):
    """One commit per version; messages name the table."""
    days = f.orders.groupBy((F.year("o_orderdate") - 1994).cast("long").alias("version")).agg(
        F.max("o_orderdate").alias("committed_at")
    )
    verb = F.when(F.col("version") == 1, "Create").otherwise("Update")
    return days.withColumn("message", F.concat(verb, F.lit(" table customers")))


@query(STATE, f"SELECT * FROM {_state(4)}")
def as_of(f: Frames):
    return history.as_of(log_of(f), ["o_custkey"], 4)


def _stored(f: Frames, upto: int) -> VersionStore:
    """The log's versions 1 to 7 by commits, with a full state at every third."""
    log = written_once(log_of(f), "log")
    schema = log.drop("version", "op").schema
    store = VersionStore(f.spark, shared_folder(f.spark, "versions"), schema, ["o_custkey"], every=3)
    for version in range(1, upto + 1):
        store.commit(log.where(F.col("version") == version), version)
    return store


@query(STATE, f"SELECT * FROM {_state(4)}")
def as_of_stored(f: Frames):
    """A stored version: its newest full state and the changes after it."""
    return _stored(f, 5).read(4)


@query("o_custkey:i o_orderkey:i o_totalprice:n", f"SELECT * FROM {_state(1)}")
def rollback_stored(f: Frames):
    store = _stored(f, 4)
    store.rollback(1, 5)
    return store.read(5)


@query(
    "o_custkey:i change",
    f"""SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN a.o_custkey IS NULL THEN 'added'
        WHEN b.o_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM {_state(2)} a FULL JOIN {_state(4)} b ON a.o_custkey = b.o_custkey
        WHERE a.o_totalprice IS DISTINCT FROM b.o_totalprice""",
)
def diff_stored(f: Frames):
    """Only keys that the log names between the two versions take part."""
    return _stored(f, 4).diff(2, 4, ["o_totalprice"])


@query(STATE, f"SELECT * FROM {_state(3)}")
def tag_read(f: Frames):
    tags = commits_of(f).select(
        F.concat(F.lit("end-of-"), F.col("version").cast("string")).alias("tag"), F.col("version").alias("tagged_version")
    )
    return history.read_tag(log_of(f), tags, "end-of-3", ["o_custkey"])


@query("o_custkey:i o_orderkey:i o_totalprice:n", f"SELECT * FROM {_state(3)}")
def rollback(f: Frames):
    """The log after rolling back to version 3, read at its newest version."""
    log = log_of(f)
    restored = log.unionByName(history.rollback(log, ["o_custkey"], 3, 8))
    return history.as_of(restored, ["o_custkey"], 8)


@query(
    "change n:i",
    f"""SELECT change, COUNT(*) AS n FROM (SELECT CASE WHEN a.o_custkey IS NULL THEN 'added' WHEN b.o_custkey IS NULL
        THEN 'removed' WHEN a.o_orderkey = b.o_orderkey THEN 'shared' ELSE 'changed' END AS change
        FROM {_state(2)} a FULL JOIN {_state(5)} b ON a.o_custkey = b.o_custkey) GROUP BY 1""",
)
def version_diff(f: Frames):
    log, key = log_of(f), ["o_custkey"]
    diff = history.diff_versions(history.as_of(log, key, 2), history.as_of(log, key, 5), key, ["o_orderkey"])
    return diff.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query(
    "side o_custkey:i",
    f"""SELECT 'added' AS side, o_custkey FROM (SELECT o_custkey FROM {_state(5)} EXCEPT SELECT o_custkey FROM {_state(2)})
        UNION ALL SELECT 'removed', o_custkey FROM (SELECT o_custkey FROM {_state(2)} EXCEPT SELECT o_custkey
        FROM {_state(5)}) UNION ALL SELECT 'shared', o_custkey FROM (SELECT o_custkey FROM {_state(2)} INTERSECT
        SELECT o_custkey FROM {_state(5)})""",
)
def key_sets(f: Frames):
    log, key = log_of(f), ["o_custkey"]
    sets = history.key_sets(history.as_of(log, key, 2), history.as_of(log, key, 5), key)
    labelled = [df.withColumn("side", F.lit(side)) for side, df in sets.items()]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


@query(STATE, f"SELECT * FROM {_state(5)}")
def branch_view(f: Frames):
    """Main pinned at version 4 with the branch's own commit 5 on top."""
    log, key = log_of(f), ["o_custkey"]
    return history.branch_view(history.as_of(log, key, 4), log.where("version = 5"), key)


@query(
    "version:i committed_at:t message rows_changed:i row_count:i column_count:i",
    f"""WITH c AS (SELECT year(o_orderdate) - 1994 AS version, MAX(o_orderdate) AS committed_at FROM {{orders}} GROUP BY 1),
        n AS (SELECT version, COUNT(*) AS rows_changed FROM {LOG} GROUP BY 1)
        SELECT c.version, committed_at, 'Update table customers' AS message, rows_changed, 3 AS column_count,
            (SELECT COUNT(*) FROM (SELECT o_custkey, arg_max(op, l.version) AS last_op FROM {LOG} l
                WHERE l.version <= c.version GROUP BY 1) WHERE last_op = 'U') AS row_count
        FROM c JOIN n ON c.version = n.version WHERE c.version > 1""",
)
def version_log(f: Frames):
    return history.version_log(log_of(f), commits_of(f), ["o_custkey"], "Update table customers")


# --- evolution ----------------------------------------------------------------

STEPS = [
    evolve.AddColumn("channel", "string"),
    evolve.RenameColumn("value", "amount"),
    evolve.WidenColumn("user_id", "bigint"),
    evolve.ReorderColumns(("event_id", "amount", "user_id")),
    evolve.DropColumn("props"),
]


@query(
    "event_id:i amount:n user_id:i ts:t event_type channel",
    """SELECT event_id, value AS amount, user_id, ts, event_type,
        CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 'web' ELSE 'app' END AS channel FROM {events}""",
)
def schema_evolution(f: Frames):
    """Three generations of files written under schema versions 0, 2 and 5, read through the last."""
    part = F.col("event_id") % 3
    gen0 = f.events.where(part == 0).withColumn("user_id", F.col("user_id").cast("int"))
    gen2 = (
        f.events.where(part == 1).withColumn("user_id", F.col("user_id").cast("int"))
        .withColumnRenamed("value", "amount").withColumn("channel", F.lit("web"))
    )
    gen5 = f.events.where(part == 2).withColumnRenamed("value", "amount").withColumn("channel", F.lit("app")).drop("props")
    return evolve.read_generations([(gen0, 0), (gen2, 2), (gen5, 5)], STEPS)


@query("event_id:i ts:t value:n", "SELECT * FROM {events}")
def layout_union(f: Frames):
    """Old files laid out by day, newer ones by hour, read as one table."""
    cut = F.lit("2024-01-16").cast("timestamp")
    day = F.date_format("ts", "yyyy-MM-dd").alias("ts_day")
    hour = F.date_format("ts", "yyyy-MM-dd-HH").alias("ts_hour")
    old = _written(f, f.events.where(F.col("ts") < cut).select("*", day), ["ts_day"], "by-day")
    new = _written(f, f.events.where(F.col("ts") >= cut).select("*", hour), ["ts_hour"], "by-hour")
    parts = [lake.read_table(f.spark, old), lake.read_table(f.spark, new)]
    return evolve.read_layouts(parts, f.events.columns)


# --- layout -------------------------------------------------------------------


def _many_files(f: Frames, name: str, partition: str = "l_returnflag") -> str:
    path = shared_folder(f.spark, name)
    f.lineitem.repartition(12).write.partitionBy(partition).parquet(path)
    return path


@query(
    "partition file_count:i total_rows:i",
    """SELECT 'l_returnflag=' || l_returnflag AS partition, 12 AS file_count, COUNT(*) AS total_rows
        FROM {lineitem} GROUP BY 1""",
)
def file_summary(f: Frames):
    return layout.file_summary(f.spark, _many_files(f, "lineitem"))


@query(
    """n_min:i n_max:i n_nulls:i n_values:i price_min:n price_max:n status_min status_max""",
    """SELECT MIN(l_orderkey) AS n_min, MAX(l_orderkey) AS n_max, 0 AS n_nulls, COUNT(*) AS n_values,
        MIN(l_extendedprice) AS price_min, MAX(l_extendedprice) AS price_max, MIN(l_linestatus) AS status_min,
        MAX(l_linestatus) AS status_max FROM {lineitem}""",
)
def file_stats(f: Frames):
    """Per-file statistics, each of its column's type, merged to the table's."""
    columns = ["l_orderkey", "l_extendedprice", "l_linestatus"]
    merged = layout.merge_stats(layout.column_stats(f.spark, _many_files(f, "lineitem"), columns), columns)
    names = {"l_orderkey": "n", "l_extendedprice": "price", "l_linestatus": "status"}
    return merged.select(*[F.col(f"{c}_{m}").alias(f"{n}_{m}") for c, n in names.items() for m in ("min", "max", "nulls", "values")])


@query(
    "rows_before:i rows_after:i same_content:b small_before:i small_after:i",
    """SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after, TRUE AS same_content,
        12 * COUNT(DISTINCT l_returnflag) AS small_before, COUNT(DISTINCT l_returnflag) AS small_after FROM {lineitem}""",
)
def compact_check(f: Frames):
    """Rewrite many small files of partitions with blanks, colons and NULL in their names; content must stay."""
    named = F.when(F.col("l_returnflag") == "A", "REG AIR").when(F.col("l_returnflag") == "N", "a:b+c")
    path = shared_folder(f.spark, "lineitem")
    before = f.lineitem.withColumn("part", named)
    before.repartition(12).write.partitionBy("part").parquet(path)
    files = [layout.list_files(f.spark, path).count()]
    layout.compact(f.spark, path, ["part"], min_input_files=2)
    files.append(layout.list_files(f.spark, path).count())
    after = lake.read_table(f.spark, path).select(*before.columns)
    counts = [F.lit(n).alias(name) for n, name in zip(files, ("small_before", "small_after"))]
    return quality.reconcile(before, after).select("*", *counts)


@query(
    "partition written:i rewritten:i deleted:i",
    """SELECT 'l_returnflag=' || l_returnflag AS partition, 12 AS written, 1 AS rewritten,
        CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS deleted FROM {lineitem} GROUP BY l_returnflag""",
)
def compare_layouts(f: Frames):
    """File counts after a write, a compaction and a delete of one partition."""
    path = _many_files(f, "lineitem")
    # Each summary is fixed before the next step changes the files.
    def files_now():
        saved = shared_folder(f.spark, "summary")
        layout.file_summary(f.spark, path).write.parquet(saved)
        return f.spark.read.parquet(saved)

    written = files_now()
    layout.compact(f.spark, path, ["l_returnflag"], min_input_files=2)
    rewritten = files_now()
    tables.delete_from_table(f.spark, path, F.col("l_returnflag") == "R", ["l_returnflag"])
    return layout.compare_layouts({"written": written, "rewritten": rewritten, "deleted": files_now()})


@query(
    "partition",
    """SELECT 'l_linestatus=' || l_linestatus AS partition FROM {lineitem} WHERE l_linestatus = 'O' GROUP BY l_linestatus""",
)
def orphan_files(f: Frames):
    """Files that the current content no longer references: none of an untouched table's, then one partition's."""
    named = F.when(F.col("l_returnflag") == "A", "REG AIR").when(F.col("l_returnflag") == "N", "a:b+c")
    untouched = shared_folder(f.spark, "lineitem")
    f.lineitem.withColumn("part", named).write.partitionBy("part").parquet(untouched)
    none = layout.orphan_files(layout.list_files(f.spark, untouched), layout.row_counts(f.spark, untouched))
    path = _many_files(f, "lineitem", "l_linestatus")
    referenced = layout.row_counts(f.spark, path).join(
        layout.list_files(f.spark, path).where(F.col("partition") != "l_linestatus=O"), "file_path"
    )
    some = layout.orphan_files(layout.list_files(f.spark, path), referenced)
    return none.unionByName(some).select("partition").distinct()


# --- quality ------------------------------------------------------------------


@query(
    "l_orderkey:i l_linenumber:i n_rows:i",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM {lineitem} GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def dq_unique(f: Frames):
    return quality.check_unique(f.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "payment_id status",
    "SELECT payment_id, status FROM {pay_payments} WHERE settled_at IS NULL OR merchant_id IS NULL",
)
def dq_not_null(f: Frames):
    return quality.check_not_null(f.pay_payments, ["settled_at", "merchant_id"])


@query("o_orderkey:i o_orderstatus", "SELECT * FROM {orders} WHERE o_orderstatus NOT IN ('F', 'O')")
def dq_accepted(f: Frames):
    return quality.check_accepted(f.orders, "o_orderstatus", ["F", "O"])


@query(
    "ride_id rider_id",
    """SELECT ride_id, rider_id FROM {ride_rides} WHERE rider_id IS NOT NULL
        AND rider_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM {customer})""",
)
def dq_orphans(f: Frames):
    return quality.check_orphans(f.ride_rides, f.ride_riders, "rider_id", "rider_id")


@query(
    "l_orderkey:i l_linenumber:i l_shipdate:t _parent_ts:t",
    """SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate AS _parent_ts FROM {lineitem} JOIN {orders}
        ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""",
)
def dq_temporal(f: Frames):
    return quality.check_temporal(f.lineitem, f.orders, "l_orderkey", "o_orderkey", "l_shipdate", "o_orderdate")


@query(
    "test column_name failures:i",
    """SELECT 'not_null' AS test, 'ride_id' AS column_name, COUNT(*) FILTER (ride_id IS NULL) AS failures FROM {ride_rides}
        UNION ALL SELECT 'not_null', 'accepted_at', COUNT(*) FILTER (accepted_at IS NULL) FROM {ride_rides}
        UNION ALL SELECT 'accepted_values', 'status', COUNT(*) FILTER (status NOT IN ('requested', 'completed'))
        FROM {ride_rides}""",
)
def dq_report(f: Frames):
    return quality.column_report(
        f.ride_rides, ["ride_id", "accepted_at"], {"status": ["requested", "completed"]}
    )


@query(
    "o_orderkey:i change",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 1 THEN 'removed' ELSE 'changed' END AS change FROM {orders}
        WHERE o_orderkey % 1000 IN (1, 2) UNION ALL
        SELECT -o_orderkey, 'added' FROM {orders} WHERE o_orderkey % 1000 = 3""",
)
def changed_keys(f: Frames):
    """Keys that differ between a table and its rewritten copy, by trees of checksums."""
    last = F.col("o_orderkey") % 1000
    price = F.when(last == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    after = f.orders.where(last != 1).withColumn("o_totalprice", price)
    after = after.unionByName(f.orders.where(last == 3).withColumn("o_orderkey", -F.col("o_orderkey")))
    paths = [shared_folder(f.spark, name) for name in ("before", "after")]
    for df, path in zip((f.orders, after), paths):
        checksum_tree.write(df, ["o_orderkey"], path, folder_bits=4)
    return checksum_tree.changed_keys(f.spark, *paths, ["o_orderkey"], folder_bits=4)


# --- key index ------------------------------------------------------------------


@query(
    ORDER,
    """SELECT * REPLACE (CASE WHEN o_orderkey % 50 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority,
        o_totalprice + CASE WHEN o_orderkey % 50 = 0 THEN 2 WHEN o_orderkey % 75 = 0 THEN 1 ELSE 0 END AS o_totalprice) FROM {orders}""",
)
def upsert_indexed(f: Frames):
    """Two upserts by way of a key index; the second moves rows, some of which the first has replaced."""
    path = shared_folder(f.spark, "indexed")
    key_index.upsert_indexed(f.orders, path, ["o_orderkey"], PRIORITY)
    every = lambda n, more: f.orders.where(F.col("o_orderkey") % n == 0).withColumn("o_totalprice", F.col("o_totalprice") + more)
    key_index.upsert_indexed(every(75, 1), path, ["o_orderkey"], PRIORITY)
    key_index.upsert_indexed(every(50, 2).withColumn("o_orderpriority", F.lit("1-URGENT")), path, ["o_orderkey"], PRIORITY)
    return lake.read_table(f.spark, path, schema=f.orders.schema)


# --- positions, file statistics, small files ------------------------------------


@query(
    ORDER,
    "SELECT * FROM {orders} WHERE NOT (o_orderkey % 1000 = 0 OR o_totalprice < 2000 OR o_orderkey % 1000 = 1 AND o_orderpriority = '5-LOW')",
)
def delete_positions(f: Frames):
    """Two deletes by position with a fold between them; only the fold rewrites partitions."""
    path = _written(f, f.orders, PRIORITY)
    positions.delete_by_position(f.spark, path, (F.col("o_orderkey") % 1000 == 0) | (F.col("o_totalprice") < 2000))
    positions.fold_deletes(f.spark, path, PRIORITY, schema=f.orders.schema)
    positions.delete_by_position(f.spark, path, (F.col("o_orderkey") % 1000 == 1) & (F.col("o_orderpriority") == "5-LOW"))
    return positions.read_live(f.spark, path, schema=f.orders.schema)


@query(
    "event_id:i ts:t user_id:i files_left_out:b",
    """SELECT event_id, ts, user_id, TRUE AS files_left_out FROM {events}
        WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'""",
)
def scan_day_by_files(f: Frames):
    """A day of a table without partitions, written in twelve files by time: files without rows of the day are not opened."""
    path = shared_folder(f.spark, "events")
    f.events.repartitionByRange(12, "ts").write.parquet(path)
    skipping.refresh_stats(f.spark, path, ["ts", "user_id"])
    day = {"ts": (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 23, 59, 59, 999999))}
    left_out = layout.list_files(f.spark, path).count() - skipping.files_within(f.spark, path, day).count()
    found = skipping.scan_within(f.spark, path, day)
    return found.select("event_id", "ts", "user_id", F.lit(left_out >= 8).alias("files_left_out"))


@query(
    "partition rows:i files_before:i files_after:i",
    """SELECT 'l_returnflag=' || l_returnflag AS partition, COUNT(*) AS rows, 13 AS files_before, 2 AS files_after
        FROM {lineitem} GROUP BY l_returnflag""",
)
def pack_small_files(f: Frames):
    """A large file and twelve small ones per partition: the small ones become one, the large one stays."""
    path = shared_folder(f.spark, "lineitem")
    tenth = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(10)) == 0
    # A partition's large file is made by one task: of compressed columns, not of shuffled rows, and of no other partition's.
    dealt = shared_folder(f.spark, "dealt")
    f.lineitem.where(~tenth).withColumn("flag", F.col("l_returnflag")).write.option("compression", "zstd").partitionBy("flag").parquet(dealt)
    rest = lake.read_table(f.spark, dealt, schema=f.lineitem.schema.add("flag", "string"))
    for (flag,) in rest.select("flag").distinct().collect():
        large = rest.where(F.col("flag").eqNullSafe(F.lit(flag))).drop("flag").coalesce(1)
        large.write.mode("append").partitionBy("l_returnflag").parquet(path)
    f.lineitem.where(tenth).repartition(12).write.mode("append").partitionBy("l_returnflag").parquet(path)
    before = layout.list_files(f.spark, path).groupBy("partition").agg(
        F.count(F.lit(1)).alias("files_before"), F.max("file_bytes").alias("large"))
    before = f.spark.createDataFrame(before.collect(), before.schema)
    target = 2 * before.agg(F.min("large")).first()[0]
    layout.pack_small_files(f.spark, path, ["l_returnflag"], target)
    after = layout.file_summary(f.spark, path).select("partition", F.col("file_count").alias("files_after"), F.col("total_rows").alias("rows"))
    return after.join(before, "partition").select("partition", "rows", "files_before", "files_after")
