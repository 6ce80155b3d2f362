"""Derived columns, one query per function, and generic aggregate forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as c
from workload.frames import Frames
from workload.registry import query


@query(
    "c_custkey:i age:i band",
    """SELECT c_custkey, age, CASE WHEN age <= 24 THEN '<25' WHEN age <= 34 THEN '25-34' WHEN age <= 44 THEN '35-44'
        WHEN age <= 54 THEN '45-54' ELSE '55+' END AS band
        FROM (SELECT c_custkey, date_diff('year', b, DATE '1999-03-01') - CASE WHEN (month(b), day(b)) > (3, 1) THEN 1
            ELSE 0 END AS age FROM (SELECT c_custkey, DATE '1940-02-20' + CAST(c_custkey * 11 % 18000 AS INT) AS b
            FROM {customer}))""",
)
def age_band(f: Frames):
    born = F.date_add(F.lit("1940-02-20").cast("date"), (F.col("c_custkey") * 11 % 18000).cast("int"))
    born_on = f.customer.select("c_custkey", born.alias("b"))
    return born_on.select(
        "c_custkey", c.age_on("b", "1999-03-01").alias("age"), c.age_band("b", "1999-03-01").alias("band")
    )


@query(
    "p_partkey:i expired:b",
    """SELECT p_partkey, 12 * y + m < 12 * 2001 + 8 AS expired
        FROM (SELECT p_partkey, 1990 + p_size % 20 AS y, 1 + p_partkey % 12 AS m FROM {part})""",
)
def expired_flag(f: Frames):
    year, month = F.lit(1990) + F.col("p_size") % 20, F.lit(1) + F.col("p_partkey") % 12
    return f.part.select("p_partkey", c.card_expired(year, month, "2001-08-15").alias("expired"))


@query(
    "event_id:i class",
    """SELECT event_id, CASE WHEN v >= 8 THEN 'great' WHEN v >= 7 THEN 'major' WHEN v >= 6 THEN 'strong'
        WHEN v >= 5 THEN 'moderate' WHEN v >= 4 THEN 'light' WHEN v >= 2 THEN 'minor' WHEN v < 2 THEN 'micro' END AS class
        FROM (SELECT event_id, CASE WHEN event_id % 40 <> 0 THEN floor(value / 10) / 5 END AS v FROM {events})""",
)
def magnitude_class(f: Frames):
    magnitude = F.when(F.col("event_id") % 40 != 0, F.floor(F.col("value") / 10) / 5)
    return f.events.select("event_id", c.magnitude_class(magnitude).alias("class"))


@query(
    "event_id:i category",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL WHEN v > 45 THEN 'hazardous' WHEN v > 35 THEN 'very_unhealthy'
        WHEN v > 25 THEN 'unhealthy' WHEN v > 15 THEN 'unhealthy_sensitive' WHEN v > 5 THEN 'moderate' ELSE 'good' END
        AS category FROM (SELECT event_id, event_type, floor(value / 5) AS v FROM {events})""",
)
def pm25_category(f: Frames):
    parameter = F.when(F.col("event_type") == "view", "no2").otherwise("pm25")
    return f.events.select("event_id", c.pm25_category(F.floor(F.col("value") / 5), parameter).alias("category"))


@query(
    "o_orderkey:i payload",
    """SELECT o_orderkey, '{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' ||
        o_orderstatus || '","note":' || CASE WHEN o_orderstatus = 'F' THEN '"done"' ELSE 'null' END || '}}' AS payload
        FROM {orders}""",
)
def raw_payload(f: Frames):
    noted = f.orders.withColumn("note", F.when(F.col("o_orderstatus") == "F", "done"))
    return noted.select(
        "o_orderkey", c.raw_payload(["o_orderkey", "o_custkey", "o_orderstatus", "note"]).alias("payload")
    )


@query(
    "o_orderkey:i h safe sk member day_key:i",
    """SELECT o_orderkey, sha256(concat_ws('||', COALESCE(s, ''), o_orderpriority)) AS h,
        sha256(concat_ws('||', COALESCE(length(s) || ':' || s, '~'), length(o_orderpriority) || ':' || o_orderpriority))
        AS safe, md5(concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderstatus)) AS sk, COALESCE(s, '-1') AS member,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS day_key
        FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS s FROM {orders})""",
)
def hashes_and_keys(f: Frames):
    nullable = f.orders.withColumn("s", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    return nullable.select(
        "o_orderkey", c.record_hash(["s", "o_orderpriority"]).alias("h"),
        c.record_hash(["s", "o_orderpriority"], null_safe=True).alias("safe"),
        c.surrogate_key("o_custkey", "o_orderstatus").alias("sk"),
        c.known_or_unknown("s").alias("member"), c.date_key("o_orderdate").alias("day_key"),
    )


@query(
    "event_id:i day:d hour:i iso_week:i prefix upper_type k:i first_k:i seconds:i",
    """SELECT event_id, CAST(ts AS DATE) AS day, hour(ts) AS hour, week(ts) AS iso_week, split_part(props, ':', 1) AS prefix,
        upper(trim(event_type)) AS upper_type, CAST(json_extract_string(props, '$.k') AS INT) AS k,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS first_k,
        date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS seconds FROM {events}
        WHERE contains(props, 'k')""",
)
def scalar_functions(f: Frames):
    start = F.lit("2024-01-01").cast("timestamp")
    return f.events.where(F.contains("props", F.lit("k"))).select(
        "event_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), F.weekofyear("ts").alias("iso_week"),
        F.split_part("props", F.lit(":"), F.lit(1)).alias("prefix"),
        F.upper(F.trim("event_type")).alias("upper_type"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("first_k"),
        c.seconds_between(start, "ts").alias("seconds"),
    )


@query(
    """l_suppkey:i n:i shipped:i returned:i parts:i net:n least:n most:n avg_quantity:n avg_returned:n any_returned:b""",
    """SELECT l_suppkey, COUNT(*) AS n, COUNT(l_shipdate) AS shipped, COUNT(*) FILTER (l_returnflag = 'R') AS returned,
        COUNT(DISTINCT l_partkey) AS parts,
        SUM(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS net,
        MIN(l_extendedprice) AS least, MAX(l_extendedprice) AS most, SUM(l_quantity) / COUNT(*) AS avg_quantity,
        AVG(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS avg_returned, BOOL_OR(l_returnflag = 'R') AS any_returned
        FROM {lineitem} GROUP BY 1""",
)
def aggregate_forms(f: Frames):
    returned = F.col("l_returnflag") == "R"
    price, off = F.col("l_extendedprice").cast("decimal(14,2)"), F.col("l_discount").cast("decimal(4,2)")
    return f.lineitem.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_shipdate").alias("shipped"),
        F.count_if(returned).alias("returned"), F.count_distinct("l_partkey").alias("parts"),
        F.sum(price * (1 - off)).alias("net"), F.min("l_extendedprice").alias("least"),
        F.max("l_extendedprice").alias("most"), F.avg("l_quantity").alias("avg_quantity"),
        F.avg(F.when(returned, F.col("l_quantity"))).alias("avg_returned"), F.bool_or(returned).alias("any_returned"),
    )


@query(
    "n:i volume:n low:i mid:i high:i",
    """SELECT COUNT(*) AS n, COALESCE(SUM(CAST(o_totalprice AS DECIMAL(14,2))), 0) AS volume,
        COUNT(*) FILTER (o_totalprice < 100000) AS low,
        COUNT(*) FILTER (o_totalprice >= 100000 AND o_totalprice < 300000) AS mid,
        COUNT(*) FILTER (o_totalprice >= 300000) AS high FROM {orders}""",
)
def global_banded(f: Frames):
    price = F.col("o_totalprice")
    return f.orders.agg(
        F.count(F.lit(1)).alias("n"), c.sum_or_zero(price.cast("decimal(14,2)")).alias("volume"),
        F.count_if(price < 100000).alias("low"), F.count_if((price >= 100000) & (price < 300000)).alias("mid"),
        F.count_if(price >= 300000).alias("high"),
    )


@query(
    "o_orderkey:i o_totalprice:n",
    "SELECT * FROM {orders} ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100",
)
def top_orders(f: Frames):
    return f.orders.orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(100)


@query(
    "n_name n_regionkey:i",
    "SELECT n_name, n_regionkey FROM {nation} UNION SELECT r_name, r_regionkey FROM {region}",
)
def union_distinct(f: Frames):
    return f.nation.select("n_name", "n_regionkey").union(f.region.select("r_name", "r_regionkey")).distinct()


@query(
    "nation_name region_name customers:i suppliers:i",
    """SELECT n_name AS nation_name, r_name AS region_name, COALESCE(c, 0) AS customers, COALESCE(s, 0) AS suppliers
        FROM {nation} LEFT JOIN {region} ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT c_nationkey AS ck, COUNT(*) AS c FROM {customer} GROUP BY 1) ON n_nationkey = ck
        LEFT JOIN (SELECT s_nationkey AS sk, COUNT(*) AS s FROM {supplier} GROUP BY 1) ON n_nationkey = sk""",
)
def dim_geo(f: Frames):
    customers = f.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    suppliers = f.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    regions = f.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region_name"))
    return (
        f.nation.join(regions, "n_regionkey", "left").join(customers, "n_nationkey", "left")
        .join(suppliers, "n_nationkey", "left").fillna(0, ["customers", "suppliers"])
        .select(F.col("n_name").alias("nation_name"), "region_name", "customers", "suppliers")
    )
