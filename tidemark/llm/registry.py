"""The operators' registered queries, one per operator, and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, byte_bpe, decontam_wand, divergence, langid_codes, license_index, mixing, quality_votes, secret_ledger,
    simhash_trees, suffix_radix, token_coder, url_rules,
)
from tidemark.llm.common import n_words, table
from tidemark.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Fixed values of the contract.
SOURCE_WEIGHTS = [3, 1, 2]
BUDGET_SHARE = 1.5
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    schedule = mixing.mix(docs, n_words(F.col("text")), SOURCE_WEIGHTS, BUDGET_SHARE, passes=2)
    return mixing.taken_per_document(schedule)


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 0).alias("blocked"))
    return url_rules.judge(table(spark, folder, "pages"), labels, URL_RULES)


@query
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_ledger.scan(table(spark, folder, "documents"), shared_folder(spark, "secret-ledger"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_ledger.BASE))
    return found.select(F.col("path").alias("doc_id"), *[count(k) for k in secret_ledger.BASE],
                        F.sha2(text(base), 256).alias("base_sha256"), text("spans").alias("spans"))


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_votes.judge(table(spark, folder, "documents"), keep=["doc_id"])
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *[f"measures.{m}" for m in measures], "base_failed", "kept", "quality")


@query
def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = license_index.scan(table(spark, folder, "documents"), keep=["doc_id"])
    labels = lambda *arrays: F.array_join(F.sort_array(F.array_distinct(F.concat(*[
        F.transform(a, lambda x: x["label"]) for a in arrays]))), ",")
    starts = F.transform("base", lambda x: x["at"].cast("long"))
    best = F.coalesce(F.array_max(F.transform("matches", lambda x: x["score"])), F.lit(0.0))
    return found.select(
        "row.doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels("base").alias("base_labels"), labels("base", "matches").alias("labels"),
        F.least(F.lit(1.0), best).alias("score"),
    )


@query
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_trees.near_duplicates(table(spark, folder, "documents"), simhash_trees.CLOSE)
    bytes_ = [F.substring(F.hex("print"), at, 2) for at in range(15, 0, -2)]  # highest first
    return found.select("doc_id", F.lower(F.concat(*bytes_)).alias("fingerprint"), "component_id")


@query
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid_codes.identify(table(spark, folder, "documents"))


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam_wand.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = shared_folder(spark, "token-files")
    token_coder.write(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_coder.documents(spark, path)


@query
def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_radix.removed(table(spark, folder, "documents"))


@query
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizers = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.linked(table(spark, folder, "documents"), tokenizers)


@query
def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


ORACLES["op12_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
e AS (SELECT r, lang, source, unnest(t) AS term FROM d),
kept AS (SELECT lang, term FROM e GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM e JOIN kept USING (lang, term) GROUP BY lang, source, term),
by_term AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
by_lang AS (SELECT lang, count(*) AS v, sum(n) AS total FROM by_term GROUP BY lang),
g AS (SELECT lang, source FROM d GROUP BY lang, source),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (totals.total + v) AS p,
    1 + (1000000000::HUGEINT * (by_term.n + 1)) // (by_lang.total + v) AS q
  FROM totals JOIN by_lang USING (lang) JOIN by_term USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT * FROM terms),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
