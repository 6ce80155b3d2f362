"""URL filter from mined association rules.

URLs are sets of tokens (host labels, path and query words, tagged by where they stand).
FP-growth finds the token combinations that are frequent among labelled URLs; those whose
rule "combination -> block" has enough support and confidence become block rules. Tokens that
occur in exactly the same labelled URLs are mined as one class: any of them says the same, and
n words that always come together are one item instead of 2 ** n combinations. A rule is
indexed under the class that fewest URLs have: a URL looks up its tokens and is blocked where
it has a token of each of a found rule's classes. Explicit (host, path) rules come before mined ones.

Everything is DataFrame functions and Spark's own FP-growth. Mined rules are few (support
bounds their number) but nothing here relies on it: they stay a table.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, staged

BLOCK, ALLOW = "label=block", "label=allow"
#: A rule is of so large a share of the labelled URLs, and of so many at least.
MIN_SUPPORT = 0.002
MIN_URLS = 5
MIN_CONFIDENCE = 0.9


def split_url(url: Column) -> tuple[Column, Column]:
    """host: after the first :// up to / ? # or the end, A to Z in lower case; path: then up to ? # or the end."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: h: host labels, p: path words, q: words after ? or #."""
    tagged = lambda tag, text, cut: F.transform(
        F.filter(F.split(F.lower(text), cut), lambda w: w != ""), lambda w: F.concat(F.lit(tag), w))
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*[?#](?s:(.*))$", 1)
    return F.array_distinct(F.concat(
        tagged("h:", host, r"\."), tagged("p:", path, r"[^\p{L}\p{N}]+"), tagged("q:", after, r"[^\p{L}\p{N}]+")))


def explicit(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """pages (id, host, path, ...) with rule and said (allow, block or null): the longest fitting rule.

    rules: (verdict, host, path). A rule fits its host and all subdomains where the path
    starts with the rule's. Rules meet hosts by equal host suffixes.
    """
    spark = pages.sparkSession
    deepest = max(host.count(".") + 1 for _, host, _ in rules)
    known = spark.createDataFrame([(v, h, p, h + p, len(h + p)) for v, h, p in rules],
                                  "r_said string, r_host string, r_path string, r_rule string, r_len int")
    suffixes = F.array(*[F.substring_index("host", ".", -n) for n in range(1, deepest + 1)])
    split = pages.withColumn("suffix", F.explode(F.array_distinct(suffixes)))
    fits = split.join(known, (F.col("suffix") == F.col("r_host")) & F.col("path").startswith(F.col("r_path")))
    best = fits.groupBy("id").agg(F.max(F.struct("r_len", "r_rule", "r_said")).alias("best"))
    best = best.select(F.col("id").alias("b_id"), F.col("best.r_rule").alias("rule"), F.col("best.r_said").alias("said"))
    return pages.join(best, F.col("id") == F.col("b_id"), "left").drop("b_id")


def token_classes(baskets: DataFrame, least: int) -> DataFrame:
    """token, item: tokens of baskets (row, tokens) in `least` rows or more; item is the smallest
    token that occurs in exactly the same rows, told by their number and two sums of 64-bit row hashes."""
    total = lambda *seed: F.sum(F.xxhash64("row", *seed).cast("decimal(38,0)"))
    spread = baskets.select("row", F.explode(F.array_distinct("tokens")).alias("token"))
    rows = spread.groupBy("token").agg(F.count("*").alias("n"), total().alias("s1"), total(F.lit(1)).alias("s2")).where(F.col("n") >= least)
    items = rows.groupBy("n", "s1", "s2").agg(F.min("token").alias("item"))
    return rows.join(items, ["n", "s1", "s2"]).select("token", "item")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_urls: int = MIN_URLS) -> DataFrame:
    """Block rules (antecedent, confidence, support, classes) from labelled (tokens, blocked boolean).

    antecedent: one token of each class; classes: all tokens of each, in the same order. Rows
    without tokens count towards the support. No labelled rows, no rules.
    """
    rows = staged(labelled.select("tokens", "blocked", F.monotonically_increasing_id().alias("row")), "labelled-urls")
    n = max(rows.count(), 1)
    support = min(1.0, max(min_support, min_urls / n))
    classes = staged(token_classes(rows, math.ceil(support * n)), "token-classes")
    spread = rows.select("row", F.explode("tokens").alias("token")).join(classes, "token")
    mapped = spread.groupBy("row").agg(F.collect_set("item").alias("items"))
    label = F.when(F.col("blocked"), BLOCK).otherwise(ALLOW)
    baskets = rows.join(mapped, "row", "left").select(
        F.array_append(F.coalesce("items", F.array().cast("array<string>")), label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.array_contains("consequent", BLOCK) & ~F.array_contains("antecedent", ALLOW))
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    whole = classes.groupBy("item").agg(F.array_sort(F.collect_set("token")).alias("class"))
    parts = rules.withColumn("item", F.explode("antecedent")).join(whole, "item")
    of_rule = F.array_sort(F.collect_list(F.struct("item", "class")))
    return parts.groupBy("antecedent", "confidence", "support").agg(F.transform(of_rule, lambda x: x["class"]).alias("classes"))


def match(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages (id, tokens) that a rule blocks: id, mined (the strongest rule's antecedent), confidence.

    Each rule is posted under the tokens of one class, the one that fewest pages have; nulls have no tokens.
    """
    parts = rules.select("antecedent", "confidence", "classes", F.posexplode("classes").alias("nth", "class"))
    spread = parts.withColumn("token", F.explode("class"))
    seen = pages.select("id", F.explode("tokens").alias("token"))
    common = seen.join(spread.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    counted = spread.join(common, "token", "left").groupBy("antecedent", "confidence", "classes", "nth").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.collect_list("token").alias("class"))
    least = counted.groupBy("antecedent", "confidence", "classes").agg(F.min_by("class", F.struct("n", "nth")).alias("class"))
    keyed = least.select("antecedent", "confidence", "classes", F.explode("class").alias("token"))
    hits = pages.select("id", "tokens", F.explode("tokens").alias("token")).join(keyed, "token")
    hits = hits.where(F.forall("classes", lambda c: F.arrays_overlap(c, F.col("tokens"))))
    best = F.max(F.struct("confidence", F.col("antecedent").alias("mined")))
    return hits.groupBy("id").agg(best.alias("best")).select("id", "best.mined", "best.confidence")


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict, mined, confidence of every page.

    labels: (id, blocked) for some pages; pages that an explicit rule decides are labelled
    by it. Without explicit or mined rule a page is allowed. Null urls have empty host and
    path. Repeated rows are judged alike and stay; an empty table gives no rows. Other columns of
    pages are not returned, whatever their names. A url is one set of tokens however long it is.
    """
    host, path = split_url(F.col(url))
    split = pages.select(F.col(key).alias(key), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    distinct = split.select("url", "host", "path").withColumn("url", F.coalesce("url", F.lit("")))
    distinct = distinct.withColumn("id", F.sha2("url", 256)).dropDuplicates(["id"])
    distinct = distinct.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    said = explicit(distinct, rules)
    by_label = pages.select(F.col(key).alias("l_id"), F.sha2(F.coalesce(F.col(url), F.lit("")), 256).alias("id")).join(
        labels.select(F.col("id").alias("l_id"), "blocked"), "l_id").groupBy("id").agg(F.max("blocked").alias("blocked"))
    labelled = said.join(by_label, "id", "left").select(
        "tokens", F.coalesce(F.col("said") == "block", "blocked").alias("blocked")).where("blocked IS NOT NULL")
    mined = match(said.select("id", "tokens"), staged(mine(labelled), "url-rules"))
    verdicts = said.select("id", "rule", "said").join(mined, "id", "left")
    out = split.withColumn("id", F.sha2(F.coalesce("url", F.lit("")), 256)).join(verdicts, "id", "left")
    verdict = F.coalesce("said", F.when(F.col("mined").isNotNull(), "block"), F.lit("allow"))
    return out.select(key, "host", "path", "rule", verdict.alias("verdict"), "mined", "confidence")
