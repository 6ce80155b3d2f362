"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, up to `passes` times over.
A document's virtual start and finish time are the words its source has queued before and
after it, divided by the source's weight. Ordered by finish time, the queues interleave in
proportion to their weights; a queue that has ended leaves its share to the others.
Documents still in service where the budget ends are taken in part.

Documents are shuffled by a hash, so buckets of a source are slices of the hash's range:
running sums need one small total per bucket and a window inside each bucket, and a source
with a third of all rows is many buckets. The global order is made the same way, by slices
of virtual time. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Documents that a bucket holds on average.
BUCKET_ROWS = 20_000
#: Slices of virtual time in the global order.
SLICES = 4_096


def _running(df: DataFrame, keys: list[str], slot: str, order: list[Column], size: Column) -> DataFrame:
    """df with `before`: the sum of size over the rows of its keys that stand before it.

    Rows stand by slot, then by order. Totals per (keys, slot) are summed ahead of the
    rows, so a window holds the rows of one slot only.
    """
    by = [*keys, slot]
    totals = df.groupBy(*by).agg(F.sum(size).alias("_total"))
    ahead = Window.orderBy(slot) if not keys else Window.partitionBy(*keys).orderBy(slot)
    totals = totals.withColumn("_ahead", F.coalesce(F.sum("_total").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.withColumn("_within", F.coalesce(F.sum(size).over(within), F.lit(0)))
    return joined.join(totals.drop("_total"), by).withColumn("before", F.col("_within") + F.col("_ahead")).drop("_within", "_ahead")


def targets(sources: DataFrame, share: float, passes: int) -> DataFrame:
    """sources (source, weight, total) with `target` and the water level `level`.

    Budget: share of all totals. A source gets min(passes * total, level * weight), level
    such that the budget is used up: the fixed point of resharing by weight what a source
    cannot use. Sources are a list that fits one task.
    """
    ratio = F.when(F.col("weight") > 0, passes * F.col("total") / F.col("weight"))
    upto = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    df = sources.withColumn("ratio", ratio)
    df = df.withColumn("left_budget", share * F.sum("total").over(everything) - F.coalesce(F.sum(passes * F.col("total")).over(upto), F.lit(0)))
    df = df.withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
    df = df.withColumn("capped", F.col("ratio") * F.col("left_weight") <= F.col("left_budget"))
    level = F.first(F.when(~F.col("capped"), F.col("left_budget") / F.col("left_weight")), ignorenulls=True).over(
        everything.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    df = df.withColumn("level", F.coalesce(level, F.max("ratio").over(everything), F.lit(0.0)))
    target = F.least((passes * F.col("total")).cast("double"), F.col("level") * F.col("weight"))
    return df.withColumn("target", target).drop("ratio", "left_budget", "left_weight", "capped")


def rank_weights(sources: DataFrame, weights: list[float]) -> DataFrame:
    """Adds rank (by code point, null last) and weight: weights in turn by rank."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    return ranked.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") % len(weights)))


def mix(docs: DataFrame, size: Column, weights: list[float], share: float, passes: int = 2, seed: int = 7,
        key: str = "doc_id", source: str = "source", text_hash: str | None = None, row_id: str | None = None) -> DataFrame:
    """The mix's schedule: one row per document and pass.

    doc_id, source, size, source_size, target, n (the document's number in its source's
    bucket), bucket, pass (0 first), start and finish (virtual), taken (words), mix_start
    (words of the mix before it; its budget where nothing is served). Rows with taken 0 are
    not in the mix; the others, by mix_start, are the mix. Equal inputs give equal mixes.
    Repeated rows are documents of their own; null sizes count 0, null sources are one
    source, an empty table gives none.
    A column text_hash joins the key in the shuffle, so rows with equal keys stand apart; a
    column row_id (unique) is carried along as such.
    """
    row = [F.col(row_id).alias("row_id")] if row_id else []
    doc = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
                      F.xxhash64(F.lit(seed), key, *[text_hash] * bool(text_hash)).alias("h"), *row)
    doc = staged(doc, "mix").withColumn("skey", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    sources = doc.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("total"), F.count("*").alias("rows"))
    plan = targets(rank_weights(sources, weights), share, passes).select("skey", "rank", "weight", "total", "rows", "target", "level")

    # By an expression, so that the rows do not count as dealt by skey: the windows below deal them by
    # (skey, bucket), and a large source is many tasks.
    doc = doc.join(plan.withColumnRenamed("skey", "_plan"), F.concat("skey", F.lit("")) == F.col("_plan")).drop("_plan")
    unit = F.col("h").cast("double") / 2.0**64 + 0.5
    doc = doc.withColumn("bucket", F.floor(unit * F.ceil(F.col("rows") / F.lit(BUCKET_ROWS))))
    order = [F.col(c) for c in ("h", "doc_id", "size", *["row_id"] * bool(row_id))]
    doc = doc.withColumn("n", F.row_number().over(Window.partitionBy("skey", "bucket").orderBy(*order)))
    doc = _running(doc, ["skey"], "bucket", [F.col("n")], F.col("size"))

    # Words in service per pass: whole documents up to the water level, the one there in part.
    served = doc.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    served = served.withColumn("queued", F.col("before") + F.col("pass") * F.col("total"))
    room = F.floor("target") - F.col("queued")
    served = served.withColumn("served", F.greatest(F.lit(0), F.least("size", room)))
    served = served.withColumn("start", F.col("queued") / F.col("weight"))
    served = served.withColumn("finish", (F.col("queued") + F.col("served")) / F.col("weight"))
    slot = F.least(F.floor(F.col("finish") / F.col("level") * SLICES), F.lit(SLICES))
    # Rows that serve nothing add nothing to the sums: any slot does.
    anywhere = F.pmod(F.xxhash64("h", "n", "pass"), F.lit(SLICES))
    served = served.withColumn("slot", F.when(F.col("served") > 0, slot).otherwise(anywhere))
    tie = [F.col("finish"), F.col("rank"), F.col("pass"), F.col("bucket"), F.col("n")]
    ordered = _running(served.withColumnRenamed("before", "_queued"), [], "slot", tie, F.col("served"))
    total = sources.agg(F.floor(share * F.sum("total")).alias("budget")).scalar()
    taken = F.greatest(F.lit(0), F.least(F.col("served"), total - F.col("before")))
    return ordered.select(
        "doc_id", "source", "size", F.col("total").alias("source_size"), "target", "skey", "bucket", "n", "pass",
        "start", "finish", taken.cast("long").alias("taken"),
        F.when(F.col("served") > 0, F.col("before")).otherwise(total).cast("long").alias("mix_start"), *["row_id"] * bool(row_id),
    )


def taken_per_document(schedule: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the words taken in all passes."""
    return schedule.groupBy("skey", "bucket", "n").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum("taken").alias("taken"),
    ).drop("skey", "bucket", "n")


def take(docs: DataFrame, size: Column, weights: list[float], share: float, passes: int = 2, seed: int = 7,
         key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of docs, with their columns, that the mix takes, each as often as it takes them.

    A document in service where the budget ends is taken whole if half of its words are.
    Documents without words are not taken. Every row is queued and counted on its own: rows
    are written once with a number, so equal or null keys do no harm.
    """
    rows = staged(docs.select(
        F.struct("*").alias("row"), F.col(key).alias("_key"), F.col(source).alias("_source"), size.alias("_size"),
        F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_row")), "mix-rows")
    schedule = mix(rows, F.col("_size"), weights, share, passes, seed, "_key", "_source", "_hash", "_row")
    counted = (F.col("size") > 0) & (2 * F.col("taken") >= F.col("size"))
    times = schedule.where(counted).groupBy("row_id").agg(F.count("*").cast("int").alias("_times"))
    joined = rows.join(times, F.col("_row") == F.col("row_id"))
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), F.col("_times")))).select("row.*")
