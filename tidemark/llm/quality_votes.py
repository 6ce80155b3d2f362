"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Votes are counted per
pattern over the whole corpus; expectation-maximisation on these counts estimates, for
every rule, how often its good and its bad votes are right, and from that each document's
probability of being good. Two conditions reject a document whatever the votes; `judge`
calls them base_failed.

Bad documents are bad in one way each, so bad votes seldom meet and the votes alone do not
tell which side is right. Each rule's accuracy therefore starts from a stated trust, which
weighs as much as the votes themselves (TRUST, TRUST_WEIGHT).

The histogram has at most 3 ** len(RULES) rows whatever the corpus, so the fit is one
expression over one row; everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, let, staged, words

#: name: (bad if, good if), SQL over the measures; neither: abstains. Bad goes first.
RULES = {
    "length": ("n_words < 10", "n_words >= 40"),
    "repeats": ("100 * n_repeat_words > 20 * n_words", "false"),
    "symbols": ("20 * n_symbols > n_words", "false"),
    "lines": ("n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines", "false"),
    "capitals": ("5 * n_upper > 2 * n_letters AND n_letters >= 40", "false"),
    "exclaims": ("10 * n_exclaims > n_words AND n_words >= 20", "false"),
    "word_length": ("word_chars < 2 * n_words OR word_chars > 15 * n_words",
                    "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    # Distinct words grow with the square root of a long text's words; the two bars meet at 400.
    "variety": ("n_words >= 50 AND 8 * n_distinct < least(n_words, 20 * sqrt(n_words))", "3 * n_distinct > least(n_words, 20 * sqrt(n_words))"),
}
ITERATIONS = 40
#: Stated share of good documents; how often a bad vote is right to begin with (a good vote:
#: as often as that share), and how much that counts against the votes.
GOOD = 0.8
TRUST = 0.9
TRUST_WEIGHT = 1.0


def _repeat_words(h: Column) -> Column:
    """Words covered by a window whose hash occurs twice; h: hashes of all 5-word windows, in order."""
    def covered(s: Column) -> Column:
        same = lambda i, e: F.get(s, i)["h"] == e["h"]
        twice = F.filter(s, lambda e, i: F.coalesce(same(i - 1, e), F.lit(False)) | F.coalesce(same(i + 1, e), F.lit(False)))
        places = F.sort_array(F.transform(twice, lambda e: e["p"]))
        start = F.struct(F.lit(-100).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(5), p - a["last"])).alias("total")),
            lambda a: a["total"],
        )

    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(h)) < F.size(h), let(pairs, covered)).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A struct column `measures` per document; null and empty texts measure 0 throughout.

    The columns of docs in `keep` (all by default) stay, in a struct column `row`, so no
    name can clash. Windows are compared by 64-bit hashes of their five words' hashes.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(F.struct(*(keep or ["*"])).alias("row"), body.alias("t"))
    df = df.withColumn("w", words(F.col("t")))
    df = df.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    # Of each word and the four after it; the last four begin none.
    window = F.transform(
        F.slice("wh", F.lit(1), F.greatest(F.size("wh") - 4, F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(F.col("wh"), i + k) for k in range(1, 5)]),
    )
    df = df.withColumn("h", window)
    kept_only = lambda cls: F.length(F.regexp_replace("t", f"[^{cls}]+", ""))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    df = df.withColumn("lines", lines)
    return df.select("row", F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        kept_only(r"#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("h")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        kept_only(r"\p{Lu}").cast("long").alias("n_upper"),
        kept_only(r"\p{L}").cast("long").alias("n_letters"),
        kept_only("!").cast("long").alias("n_exclaims"),
        F.size(F.array_distinct("wh")).cast("long").alias("n_distinct"),
    ).alias("measures"))


def votes() -> Column:
    """One vote per rule, in order, from the columns of `measures`."""
    def vote(bad: str, good: str) -> Column:
        return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)

    return F.array(*[vote(*rule) for rule in RULES.values()])


def fit(patterns: DataFrame) -> DataFrame:
    """One row `model`: good, the share of good documents, and rules: per rule, that share among
    the documents with its vote -1 and among those with its vote 1 ([bad vote, good vote]).

    patterns: votes array<int>, n double or long (how many documents). Starts from "a
    document with a bad vote is bad". An empty table gives the stated shares.
    """
    start = F.transform("p", lambda x: F.struct(
        x["votes"].alias("votes"), x["n"].alias("n"),
        F.when(F.exists(x["votes"], lambda v: v == -1), 1 - TRUST).otherwise(0.95).alias("good"),
    ))

    def share(posts: Column, counts, prior: Column) -> Column:
        """Of good among the documents that counts names, with the prior's weight."""
        mass = F.aggregate(posts, F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("good")), lambda a, x: F.struct(
            (a["n"] + F.when(counts(x), x["n"]).otherwise(0.0)).alias("n"),
            (a["good"] + F.when(counts(x), x["n"] * x["good"]).otherwise(0.0)).alias("good")))
        return let(mass, lambda m: (m["good"] + prior * (1 + TRUST_WEIGHT * m["n"])) / (m["n"] + 1 + TRUST_WEIGHT * m["n"]))

    def model(posts: Column) -> Column:
        return F.struct(
            share(posts, lambda x: F.lit(True), F.lit(GOOD)).alias("good"),
            F.transform(F.sequence(F.lit(0), F.lit(len(RULES) - 1)), lambda r: F.array(
                share(posts, lambda x: F.get(x["votes"], r) == -1, F.lit(1 - TRUST)),
                share(posts, lambda x: F.get(x["votes"], r) == 1, F.lit(GOOD)))).alias("rules"))

    def again(posts: Column, _: Column) -> Column:
        return let(model(posts), lambda m: F.transform(posts, lambda x: F.struct(
            x["votes"].alias("votes"), x["n"].alias("n"), posterior(m, x["votes"]).alias("good"))))

    listed = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("p"))
    posts = F.aggregate(F.sequence(F.lit(1), F.lit(ITERATIONS)), start, again)
    return listed.select(let(posts, model).alias("model"))


def posterior(model: Column, vote_list: Column) -> Column:
    """Probability that a document with these votes is good; an abstention tells nothing.

    A vote counts by how far the share of good documents behind it is from that of all.
    """
    odds = lambda p: F.log(p / (1 - p))
    parts = F.zip_with(vote_list, model["rules"], lambda v, r: F.when(v == 0, 0.0).otherwise(
        odds(F.get(r, F.when(v == 1, 1).otherwise(0))) - odds(model["good"])))
    return 1 / (1 + F.exp(-F.aggregate(parts, odds(F.lit(GOOD)), lambda a, x: a + x)))


def accuracies(model: DataFrame) -> DataFrame:
    """rule, bad_votes_right, good_votes_right: what the fit believes of each rule."""
    names = F.array(*[F.lit(n) for n in RULES])
    pairs = F.arrays_zip(names.alias("rule"), F.col("model.rules").alias("shares"))
    return model.select(F.explode(pairs).alias("x")).select(
        "x.rule", (1 - F.get("x.shares", F.lit(0))).alias("bad_votes_right"), F.get("x.shares", F.lit(1)).alias("good_votes_right"))


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """row (struct of docs' columns), measures, base_failed, quality (0 to 1), kept.

    kept: not base_failed, and quality of at least threshold. A document without words
    fails (fewer than 10). Repeated rows count once each. An empty table gives no rows.
    The measures are written once; the fit and the verdicts read them back.
    """
    measured = staged(measure(docs, text, keep), "quality").select("*", "measures.*").select(
        "row", "measures", votes().alias("votes"),
        F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words").alias("base_failed"),
    )
    model = fit(measured.groupBy("votes").agg(F.count("*").alias("n")))
    judged = measured.withColumn("model", model.scalar())
    judged = judged.withColumn("quality", posterior(F.col("model"), F.col("votes"))).drop("model")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that judge keeps, with their columns."""
    return judge(docs, text).where("kept").select("row.*")
