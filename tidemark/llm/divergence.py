"""Audit of how the sources of a language differ, by exact term shares.

Documents become sparse vectors of term counts over their language's terms, those of MIN_DF
documents or more, by CountVectorizer with the largest vocabulary there is: a term is fitted
together with its language's name, so that one fit gives every language its own vocabulary.
Sums of the vectors by (lang, source) and by lang are the counts that all shares come from:
a group gives term t the share 1 + floor(SCALE * (count + 1) / (N + V)) of SCALE. The distance
of a share p from another one q is floor((p - q) * (p - q) / q).

Sources are compared sparsely: terms are dealt into blocks, a block's task goes over the terms
that either source has and adds the rest, which all have one value, by their number. A block
gives one row per pair of sources, however many terms it has. A common term is a row of its
block per source and nothing more.

The fit collects its vocabulary in the driver and sends it to every task. It is used where the
number of terms proves that no vocabulary is over VOCABULARY, as each kept term stands in MIN_DF
documents; beyond that the same counts come from shuffled aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, ship, staged

ship(__name__)

#: What ends a term.
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of its language that a term must stand in.
MIN_DF = 3
SCALE = 1_000_000_000
#: Ranks of the terms' list.
TERM_RANKS = 200
#: Terms of a vocabulary that is collected, at most: some 200 bytes each in the driver and in every executor.
VOCABULARY = 2_000_000
#: Counts (of a term in a source) that a block of terms holds on average.
BLOCK_COUNTS = 200_000
#: Sources of a language that one task compares with all of them.
SOURCES = 500
#: Between a language's name and a term; no term holds it.
MARK = "\x00"


def terms(text: Column) -> Column:
    """The terms of a text, in order, with A to Z in lower case and everything else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    lower = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lower, NOT_TERM), "")


def with_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, terms; null text, lang and source are empty strings."""
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    return filled.select("lang", "source", terms(F.col("text")).alias("terms"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), in three steps of a thousand that fit a long."""
    whole, left = F.lit(0), count + 1
    for _ in range(3):
        both = left * 1000
        whole = whole * 1000 + _div(both, total + kept)
        left = both % (total + kept)
    return whole + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def fit(documents: DataFrame) -> CountVectorizerModel:
    """The vocabulary of documents (lang, terms): lang, MARK and term for each."""
    named = documents.select(F.transform("terms", lambda t: F.concat("lang", F.lit(MARK), t)).alias("terms"))
    # An empty vocabulary is an error there: a mark that stands for no term is always in it.
    never = documents.sparkSession.range(MIN_DF).select(F.array(F.lit(MARK)).alias("terms"))
    return CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(MIN_DF), vocabSize=2**31 - 1).fit(named.unionByName(never))


def _summed(vectors: DataFrame) -> DataFrame:
    """source, index, n: sums of the vectors (source, vector) by source and place, of the places that occur.

    A vector's place names its language. Tasks add what they read before it is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(0).dictionary_encode()
            *_, places, values = batch.column(1).flatten()  # of sparse vectors
            many = np.diff(np.asarray(places.offsets))
            of = np.repeat(np.asarray(source.indices).astype(np.int64), many)
            flat = lambda c: np.asarray(c.values)[c.offsets[0].as_py() : c.offsets[-1].as_py()]
            cell = of << 32 | flat(places).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            cell, n = cell[order], flat(values)[order].astype(np.int64)
            new = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, np.int64)
            sums = np.add.reduceat(n, new) if len(new) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [source.dictionary.take(pa.array(cell[new] >> 32)), pa.array((cell[new] & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)],
                ["source", "index", "n"])

    return vectors.mapInArrow(run, "source string, index int, n long").groupBy("source", "index").agg(F.sum("n").alias("n"))


def counts_by_vectors(documents: DataFrame) -> DataFrame:
    """lang, source, term, n of every kept term that a group has."""
    spark, model = documents.sparkSession, fit(documents)
    named = documents.select("source", F.transform("terms", lambda t: F.concat("lang", F.lit(MARK), t)).alias("terms"))
    summed = _summed(model.transform(named).select("source", "vector"))
    names = pa.table({"index": pa.array(range(len(model.vocabulary)), pa.int32()), "name": pa.array(model.vocabulary, pa.string())})
    split = F.length("name") - F.instr(F.reverse("name"), MARK)  # characters before the last mark
    vocabulary = spark.createDataFrame(names).select(
        "index", F.substring("name", F.lit(1), split).alias("lang"), F.substring("name", split + 2, F.length("name")).alias("term"))
    return summed.join(vocabulary, "index").select("lang", "source", "term", "n")


def counts_by_aggregates(documents: DataFrame) -> DataFrame:
    """The same, by shuffled aggregates. Totals are written before documents are counted, so that
    the shuffled rows of one go before those of the other come."""
    each = documents.select("lang", "source", F.explode("terms").alias("term"))
    total = staged(each.groupBy("lang", "source", "term").agg(F.count("*").alias("n")), "divergence-sums", compression="zstd")
    df = documents.select("lang", F.explode(F.array_distinct("terms")).alias("term")).groupBy("lang", "term").agg(F.count("*").alias("df"))
    return total.join(df.where(F.col("df") >= MIN_DF).select("lang", "term"), ["lang", "term"], "left_semi")


def _pairs(block: pa.Table) -> pa.Table:
    """lang, source, item, value of each source that is mine and each other one of its language, over a block's terms.

    Rows of the block: lang, source, mine, zero (the share of a term that the source lacks), term, p (its share).
    A row without term is there for each source, whatever terms it has.
    """
    block = block.combine_chunks()
    sources, terms = (block.column(c).combine_chunks().dictionary_encode() for c in ("source", "term"))
    names, of = sources.dictionary, np.asarray(sources.indices)
    zero, mine = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    zero[of], mine[of] = (block.column(c).to_numpy() for c in ("zero", "mine"))
    has, term = np.asarray(terms.is_valid()), np.asarray(terms.indices.fill_null(0)).astype(np.int64)
    order = np.flatnonzero(has)[np.lexsort((term[has], of[has]))]
    term, of, p = term[order], of[order], block.column("p").to_numpy()[order]
    n_terms, edges = term.max(initial=-1) + 1, np.searchsorted(of, np.arange(len(names) + 1))
    many = np.diff(edges)

    def by_source(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.append(x, 0), edges[:-1]) * (many > 0)

    ours = np.flatnonzero(mine)
    out = np.empty((len(ours), len(names)), np.int64)
    for k, s in enumerate(ours):
        own = slice(edges[s], edges[s + 1])
        row, has = np.full(n_terms, zero[s]), np.zeros(n_terms, bool)
        row[term[own]], has[term[own]] = p[own], True
        # Terms of the other source; this one's that the other lacks; and those that both lack.
        there = by_source(_distance(row[term], p))
        lacked = np.array([_distance(p[own], z).sum() for z in zero]) - by_source(np.where(has[term], _distance(row[term], zero[of]), 0))
        neither = n_terms - (many + many[s] - by_source(has[term].astype(np.int64)))
        out[k] = there + lacked + neither * _distance(zero[s], zero)
    a, b = np.nonzero(ours[:, None] != np.arange(len(names)))
    lang = pa.repeat(block.column("lang")[0], len(a))
    return pa.table([lang, names.take(pa.array(ours[a])), names.take(pa.array(b)), pa.array(out[a, b])], ["lang", "source", "item", "value"])


def _distance(p, q):
    return (p - q) * (p - q) // q


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank.

    Part pair: each other source of the language, by distance over all kept terms; part term:
    the terms that a group uses more than its language does, TERM_RANKS of them. Ranks go
    by value, highest first, and by the item's UTF-8. Null text, lang and source are empty
    strings; repeated rows count each; other columns are ignored. A language with one source
    has no pairs, a group without kept terms no terms; an empty table gives no rows.
    """
    seen = Observation()
    documents = with_terms(docs, text, lang, source).observe(seen, F.sum(F.size("terms")).alias("terms"))
    documents = staged(documents, "divergence-terms", compression="zstd")
    fits = (seen.get["terms"] or 0) <= MIN_DF * VOCABULARY
    counts = staged((counts_by_vectors if fits else counts_by_aggregates)(documents), "divergence-counts")
    groups = documents.select("lang", "source").distinct()
    by_term = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    of_lang = by_term.groupBy("lang").agg(F.sum("n_lang").alias("total_lang"), F.count("*").alias("kept"))
    totals = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    totals = totals.join(of_lang, "lang", "left").fillna(0, ["total", "total_lang", "kept"])
    totals = staged(totals, "divergence-totals")

    shares = counts.join(totals, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept")))
    zero = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"))).otherwise(F.lit(1))
    return _term_part(shares, by_term).unionByName(_pair_part(shares, totals.withColumn("zero", zero)))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    row = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(row).alias("rank"))


def _term_part(shares: DataFrame, by_term: DataFrame) -> DataFrame:
    own = shares.join(by_term, ["lang", "term"])
    own = own.withColumn("q", _share(F.col("n_lang"), F.col("total_lang"), F.col("kept"))).where("p > q")
    value = _div((F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    return _ranked(own.select("lang", "source", F.col("term").alias("item"), value.alias("value")), "term").where(F.col("rank") <= TERM_RANKS)


def _pair_part(shares: DataFrame, totals: DataFrame) -> DataFrame:
    """The terms of a language are dealt into blocks; where it has many sources, each block goes to several tasks,
    each for some of the sources. Every source has a row without term in every block."""
    n_blocks, n_parts = (F.greatest(F.lit(1), F.ceil(F.col(c) / most)).cast("long") for c, most in (("n", BLOCK_COUNTS), ("s", SOURCES)))
    sizes = totals.groupBy("lang").agg(F.count("*").alias("s")).join(shares.groupBy("lang").agg(F.count("*").alias("n")), "lang", "left")
    sizes = staged(sizes.fillna(0, ["n"]).select("lang", n_blocks.alias("blocks"), n_parts.alias("parts")), "divergence-blocks")
    sources = totals.select("lang", "source", "zero").join(sizes, "lang")
    none = sources.withColumns({"term": F.lit(None).cast("string"), "p": F.lit(0).cast("long")}).withColumn(
        "block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    some = shares.select("lang", "source", "term", "p").join(sources, ["lang", "source"]).withColumn(
        "block", F.pmod(F.xxhash64("term"), "blocks"))
    rows = some.unionByName(none).withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).withColumn(
        "mine", F.pmod(F.xxhash64("source"), "parts") == F.col("part"))
    found = rows.select("lang", "block", "part", "source", "mine", "zero", "term", "p").groupBy("lang", "block", "part").applyInArrow(
        _pairs, "lang string, source string, item string, value long")
    return _ranked(found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair")
