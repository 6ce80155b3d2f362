"""Secret scan with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. A ledger folder keeps
which (blob, rule version) pairs have been scanned and what was found; a run scans one copy
of each blob, and of its rules only those that the ledger has not seen, adds its findings,
and joins all findings back to all paths that hold the blob. All of it is DataFrame
functions.

A run writes its findings, then its seen pairs, both under its own number; findings without
the run's seen pairs are not read, so a run that died is simply done again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: kind: (pattern, group whose length counts, least length). Java regular expressions.
#: The first three are fixed values of the contract: leftmost matches that do not overlap,
#: kept if long enough. Runs of one class can ask for their length in the pattern.
RULES = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
    "pem": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
}
BASE = ("assign", "access", "hex")
FINDING = "sha string, rule string, kind string, kind_no int, start bigint, end bigint, run string"
SEEN = "sha string, rules array<string>, run string"


def rule_versions(rules: dict) -> dict[str, str]:
    """kind: a name for the rule as it is now; another pattern is another rule."""
    return {k: f"{k}-{uuid.uuid5(uuid.NAMESPACE_URL, repr(r)).hex[:12]}" for k, r in rules.items()}


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, empty if nothing was written yet."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def _pieces(text: Column, kind_no: int, rule: tuple) -> Column:
    """Per match: lengths of what stands before it (since the last match) and of itself; ok if long enough."""
    pattern, group, least = rule
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    return F.filter(
        F.transform(F.arrays_zip(between.alias("b"), whole.alias("m"), counted.alias("g")), lambda x, i: F.struct(
            F.lit(kind_no).alias("kind_no"), i.alias("i"), x["b"].alias("gap"), F.length(x["m"]).alias("len"),
            (F.length(x["g"]) >= least).alias("ok"))),
        lambda x: x["len"].isNotNull(),
    )


def find(blobs: DataFrame, rules: dict, versions: dict[str, str]) -> DataFrame:
    """Findings of blobs (sha, t, todo: rule versions to apply). Places count code points, end exclusive.

    The texts between matches and the matches give the places by a running sum over the
    matches of one blob and kind.
    """
    kinds = list(rules)
    nothing = F.array().cast("array<struct<kind_no:int,i:int,gap:int,len:int,ok:boolean>>")
    found = F.concat(*[
        F.when(F.array_contains("todo", versions[k]) & F.col("t").rlike(rules[k][0]), _pieces(F.col("t"), n, rules[k])).otherwise(nothing)
        for n, k in enumerate(kinds)
    ])
    rows = blobs.select("sha", F.explode(found).alias("x")).select("sha", "x.*")
    rows = rows.dropDuplicates(["sha", "kind_no", "i"])
    upto = Window.partitionBy("sha", "kind_no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(upto)).where("ok")
    name = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("kind_no"))
    return rows.select(
        "sha", name([versions[k] for k in kinds]).alias("rule"), name(kinds).alias("kind"), "kind_no",
        (F.col("end") - F.col("len")).alias("start"), "end",
    )


def scan(docs: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: dict = RULES) -> DataFrame:
    """path, sha and spans (kind, kind_no, start, end; by start, then rule order) of each row of docs.

    Rows are versions of paths; repeated rows stay. Null texts are empty. Updates the
    ledger. A blob that many paths hold is scanned once; which copy is read is settled by
    the smallest path.
    """
    spark = docs.sparkSession
    versions = rule_versions(rules)
    wanted = F.array(*[F.lit(v) for v in versions.values()])
    body = F.coalesce(F.col(text), F.lit(""))
    addressed = docs.select(F.col(path).alias("path"), F.sha2(body, 256).alias("sha"))

    seen = _read(spark, f"{ledger}/seen", SEEN)
    known = seen.groupBy("sha").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("known"))
    unseen = addressed.groupBy("sha").agg(F.min("path").alias("path"))
    unseen = unseen.join(known, "sha", "left").withColumn(
        "todo", F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>")))).where("size(todo) > 0")
    texts = docs.select(F.col(path).alias("path"), F.sha2(body, 256).alias("sha"), body.alias("t"))
    reps = unseen.select(F.col("sha").alias("r_sha"), F.col("path").alias("r_path"), "todo").hint("shuffle_hash")
    blobs = texts.join(reps, (F.col("sha") == F.col("r_sha")) & F.col("path").eqNullSafe(F.col("r_path")))

    run = uuid.uuid4().hex
    find(blobs, rules, versions).withColumn("run", F.lit(run)).write.mode("append").parquet(f"{ledger}/findings")
    unseen.select("sha", F.col("todo").alias("rules"), F.lit(run).alias("run")).write.mode("append").parquet(f"{ledger}/seen")

    finished = _read(spark, f"{ledger}/seen", SEEN).select("run", "sha").distinct()
    findings = _read(spark, f"{ledger}/findings", FINDING).where(F.col("rule").isin(list(versions.values())))
    findings = findings.join(finished, ["run", "sha"], "left_semi")
    spans = findings.groupBy("sha").agg(F.sort_array(F.collect_list(F.struct("start", "kind_no", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>")
    return addressed.join(spans, "sha", "left").withColumn("spans", F.coalesce("spans", none))
