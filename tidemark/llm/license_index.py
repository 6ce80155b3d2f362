"""License scan by a positional index of rare words.

Templates are short licence notices. Of each template's words the rarest in the corpus
(highest IDF, from document counts over all documents) go into the index with their
positions, so many that the others weigh less than a match must: every match is looked up. A file looks up only these words: each hit puts a template at an offset, and
equal offsets from several hits fall together. A placed template is then compared word
by word, weighted by IDF, and must hold one of its mandatory phrases at its place.

The index holds words of the templates only, so its size does not depend on the data;
matching is an expression per row, without a shuffle. Only the word counts are aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, let

#: label, notice, mandatory phrases (one of them must stand at its place in the notice).
#: Public notices; the first sentence of long ones.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "licensed under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["hereby granted free of charge"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["general public license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4"]),
    ("reserved", "all rights reserved", ["all rights reserved"]),
]
#: Base phrases and their labels; fixed values of the contract.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Share of a template's weight that a placed one must have.
MIN_COVERAGE = 0.8
WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def file_words(text: Column) -> Column:
    """Lower-cased (A to Z) words; a word is a run of letters, digits and non-ASCII characters."""
    return F.filter(F.split(ascii_lower(text), WORD_BREAKS), lambda w: w != "")


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def idf(docs: DataFrame, text: str, templates=TEMPLATES) -> DataFrame:
    """One row: idf, a map from each template word to ln((1 + documents) / (1 + documents with it))."""
    vocabulary = _lit_array(sorted({w for _, notice, _ in templates for w in notice.split()}))
    found = docs.select(F.array_intersect(vocabulary, file_words(F.coalesce(F.col(text), F.lit("")))).alias("found"))
    # One row per document for the total ("" is no word), one per word it has.
    counted = found.select(F.explode(F.concat(F.array(F.lit("")), "found")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = counted.agg(F.coalesce(F.map_from_entries(F.collect_list(F.struct("word", "n"))), F.create_map().cast("map<string,bigint>")).alias("c"))
    total = F.coalesce(F.try_element_at("c", F.lit("")), F.lit(0))
    weight = lambda w: F.log((1.0 + total) / (1 + F.coalesce(F.try_element_at("c", w), F.lit(0)))) + 0.01
    return counts.select(F.map_from_entries(F.transform(vocabulary, lambda w: F.struct(w.alias("k"), weight(w).alias("v")))).alias("idf"))


def index(spark: SparkSession, weights: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row: templates (label, words with idf, phrases with place) and postings (word, template, place)."""
    rows = [
        (label, notice.split(), [(notice[: notice.index(p)].count(" "), p.count(" ") + 1) for p in phrases])
        for label, notice, phrases in templates
    ]
    schema = "label string, words array<string>, phrases array<struct<place:int,length:int>>"
    listed = spark.createDataFrame(rows, schema).select(F.monotonically_increasing_id().alias("n"), "*")
    listed = listed.agg(F.sort_array(F.collect_list(F.struct("n", "label", "words", "phrases"))).alias("t"))
    listed = listed.withColumn("weights", weights.scalar())
    weighed = F.transform("t", lambda t: F.struct(
        t["label"].alias("label"), t["words"].alias("words"), t["phrases"].alias("phrases"),
        F.transform(t["words"], lambda w: F.element_at("weights", w)).alias("idf"),
    ))

    def rarest(t: Column) -> Column:
        """The rarest words, until the others together weigh less than MIN_COVERAGE of all."""
        by_idf = F.sort_array(F.transform(t["words"], lambda w, i: F.struct(
            (-F.get(t["idf"], i)).alias("order"), i.alias("place"), w.alias("word"))))
        weigh = lambda ws: F.aggregate(ws, F.lit(0.0), lambda a, x: a - x["order"])
        return let(by_idf, lambda ws: F.filter(
            ws, lambda _, i: weigh(F.slice(ws, i + 1, F.size(ws))) >= MIN_COVERAGE * weigh(ws) - 1e-9))

    postings = lambda ts: F.flatten(F.transform(ts, lambda t, n: F.transform(rarest(t), lambda x: F.struct(
        x["word"].alias("word"), n.alias("n"), x["place"].alias("place")))))
    built = listed.select(weighed.alias("templates")).withColumn("postings", postings(F.col("templates")))
    return built.select(F.struct(
        "templates", "postings", F.array_distinct(F.transform("postings", lambda p: p["word"])).alias("rare")).alias("index"))


def _placed(w: Column, ix: Column) -> Column:
    """Distinct (template, offset) that the file's rare words propose."""
    hits = F.filter(F.transform(w, lambda x, i: F.when(F.array_contains(ix["rare"], x), F.struct(x.alias("word"), i.alias("at")))),
                    lambda x: x.isNotNull())
    offsets = F.flatten(F.transform(hits, lambda h: F.transform(
        F.filter(ix["postings"], lambda p: p["word"] == h["word"]),
        lambda p: F.struct(p["n"].alias("n"), (h["at"] - p["place"]).alias("at")))))
    return F.array_distinct(offsets)


def _scores(w: Column, placed: Column, ix: Column) -> Column:
    """label, start, score of each placed template that is verified."""
    def score(x: Column) -> Column:
        def verified(t: Column) -> Column:
            equal = F.transform(t["words"], lambda v, i: F.coalesce(F.get(w, x["at"] + i) == v, F.lit(False)))

            def weigh(eq: Column) -> Column:
                total = F.aggregate(t["idf"], F.lit(0.0), lambda a, v: a + v)
                have = F.aggregate(F.zip_with(t["idf"], eq, lambda v, e: F.when(e, v).otherwise(0.0)), F.lit(0.0), lambda a, v: a + v)
                mandatory = F.exists(t["phrases"], lambda p: F.forall(F.slice(eq, p["place"] + 1, p["length"]), lambda e: e))
                return F.struct(t["label"].alias("label"), x["at"].alias("at"), F.when(mandatory, have / total).otherwise(0.0).alias("score"))

            return let(equal, weigh)

        return let(F.get(ix["templates"], x["n"]), verified)

    return F.filter(F.transform(placed, score), lambda s: s["score"] >= MIN_COVERAGE)


def _phrase_hits(w: Column) -> Column:
    """label and start of every base phrase."""
    kinds = [(phrase.split(), label) for phrase, label in PHRASES.items()]

    def at(x: Column, i: Column) -> Column:
        out = F.lit(None).cast("struct<label:string,at:int>")
        for parts, label in kinds:
            same = x == parts[-1]
            for back, p in enumerate(reversed(parts[:-1]), 1):
                same = same & F.coalesce(F.get(w, i - back) == p, F.lit(False))
            out = F.when(same, F.struct(F.lit(label).alias("label"), (i - len(parts) + 1).alias("at"))).otherwise(out)
        return out

    return F.filter(F.transform(w, at), lambda h: h.isNotNull())


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (struct of docs' kept columns), n_words, base (label, at), matches (label, at, score).

    base holds every place of a base phrase. matches holds every verified template place.
    Null and empty texts have no words, so neither; an empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    ix = index(docs.sparkSession, idf(docs, text))
    df = docs.select(F.struct(*(keep or ["*"])).alias("row"), file_words(body).alias("w"))
    df = df.withColumn("ix", ix.scalar())
    none = F.array().cast("array<struct<label:string,at:int,score:double>>")
    some = F.arrays_overlap("w", F.col("ix")["rare"])
    licensed = F.array_contains("w", "license")
    return df.select(
        "row", F.size("w").cast("long").alias("n_words"),
        F.when(licensed, _phrase_hits(F.col("w"))).otherwise(F.array().cast("array<struct<label:string,at:int>>")).alias("base"),
        F.when(some, _scores(F.col("w"), _placed(F.col("w"), F.col("ix")), F.col("ix"))).otherwise(none).alias("matches"),
    )
