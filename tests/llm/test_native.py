"""Mixing, URL rules, secret ledger, quality votes and license index against plain Python."""

import hashlib
import math
import re
import random
import string
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import license_index, mixing, quality_votes, registry, secret_ledger, url_rules
from tidemark.llm.common import n_words, table, words
from tidemark.session import shared_folder

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a"), (5, "x " * 30_000), (6, "Ünï cödé\u00a0wörds \x1c\x85 z"),
    (7, "one two three four five six seven eight nine ten"), (7, "one two three four five six seven eight nine ten"),
    (None, "no id here but words all the same and some more of them"), (8, "a b c d e a b c d e x a b c d e"),
    (9, "same line\nsame line\n\n \nother\nsame line"), (10, "# * $ % & | < > #$%"),
]


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_words_are_runs_outside_blanks(documents):
    docs = documents(*ODD)
    for r in docs.select("text", words(F.col("text")).alias("w"), n_words(F.col("text")).alias("n")).collect():
        assert r["w"] == WORD.findall(r["text"] or "") and r["n"] == len(r["w"])


# mixing

def water_level(totals, weights, share, passes):
    """Targets by resharing the excess until nothing is above its cap."""
    left, free, out = share * sum(totals), dict(enumerate(weights)), {}
    while free:
        level = left / sum(free.values())
        over = [k for k in free if level * free[k] >= passes * totals[k]]
        if not over:
            return [out.get(k, level * weights[k]) for k in range(len(totals))]
        for k in over:
            out[k] = float(passes * totals[k])
            left -= out[k]
            del free[k]
    return [out[k] for k in range(len(totals))]


def test_mix_meets_targets(spark):
    docs = table(spark, SF, "documents")
    got = rows_of(registry.op1_mixing(spark, SF))
    sizes = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    names = sorted(set(source.values()))
    totals = [sum(sizes[d] for d in sizes if source[d] == s) for s in names]
    wanted = dict(zip(names, water_level(totals, [[3, 1, 2][k % 3] for k in range(len(names))], 1.5, 2)))
    assert len(got) == len(sizes)
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(wanted[source[r["doc_id"]]])
        assert r["source_size"] == totals[names.index(source[r["doc_id"]])]
    for s in names:
        assert sum(r["taken"] for r in got if source[r["doc_id"]] == s) == pytest.approx(wanted[s], abs=2)
    again = rows_of(registry.op1_mixing(spark, SF))
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_order_interleaves_by_weight(documents):
    docs = documents(*[(n, "w " * 10, None, "ab"[n % 2]) for n in range(400)])
    plan = mixing.mix(docs, n_words(F.col("text")), [3, 1], 0.5, passes=1)
    rows = sorted((r for r in rows_of(plan) if r["taken"]), key=lambda r: r["mix_start"])
    assert sum(r["taken"] for r in rows) == 2000
    ends = [r["mix_start"] + r["taken"] for r in rows]
    assert ends[:-1] == [r["mix_start"] for r in rows[1:]]
    for upto in (40, 80, 120):
        share = sum(r["source"] == "a" for r in rows[:upto]) / upto
        assert share == pytest.approx(0.75, abs=0.05)


def test_mix_odd_rows(documents, clashing):
    docs = clashing(documents(*[(*r, None, [None, "s", "t"][n % 3]) for n, r in enumerate(ODD)]))
    got = rows_of(mixing.taken_per_document(mixing.mix(docs, n_words(F.col("text")), [3, 1, 2], 1.5)))
    assert len(got) == len(ODD)
    assert sum(r["taken"] for r in got) <= 1.5 * sum(r["size"] for r in got) + 1
    assert rows_of(mixing.mix(documents(), n_words(F.col("text")), [3], 1.5)) == []
    assert rows_of(mixing.taken_per_document(mixing.mix(documents((1, None)), n_words(F.col("text")), [3], 1.5)))[0]["taken"] == 0


def test_mix_takes_rows(documents, clashing):
    docs = clashing(documents(*[(n, "w " * 10, "en", "ab"[n >= 300]) for n in range(400)], (None, "x y", "en", "a")))
    got = mixing.take(docs, n_words(F.col("text")), [1, 1], 1.0, passes=2)
    assert got.columns == docs.columns
    by_source = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert by_source["b"] == 200 and by_source["a"] == pytest.approx(200, abs=2)


def test_rows_past_the_targets_share_no_slot(documents, monkeypatch):
    most, real = [], mixing._running

    def spy(df, keys, slot, *rest):
        if not keys:
            most.append(df.groupBy(slot).count().agg(F.max("count")).first()[0])
        return real(df, keys, slot, *rest)

    monkeypatch.setattr(mixing, "_running", spy)
    docs = documents(*[(n, "w " * 10, "en", "ab"[n % 2]) for n in range(2000)])
    got = rows_of(mixing.mix(docs, n_words(F.col("text")), [3, 1], 1.5))
    assert most[0] < 20 and len(got) == 4000 and sum(r["taken"] for r in got) == 30_000


@pytest.mark.parametrize("same", [False, True])
def test_mix_takes_rows_of_equal_keys_one_by_one(documents, same):
    """A third of the ids null (or one id), over both sources, with different or equal texts."""
    docs = documents(*[(n if n % 3 else None if n % 2 else 7, "w " * 9 + ("x" if same else f"x{n}"), "en", "ab"[n >= 300]) for n in range(400)])
    got = rows_of(mixing.take(docs, n_words(F.col("text")), [1, 1], 1.0, passes=2))
    by_source = [sum(r["source"] == s for r in got) for s in "ab"]
    assert by_source == [pytest.approx(200, abs=2), 200]


# URL rules

def judged_by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in registry.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/x?q#f", "http://example.com/en/", "http://example.com/en", "x://a.net/es/1",
        "x://a.net?/es/", "://net/fr/", "http://xnet/fr/", "http://example.com#/en/", "a://b://c.com/", "http://É.com/é/", "http://m.example.com/en/p"]


def test_urls_by_hand(spark):
    pages = spark.createDataFrame(list(enumerate(URLS * 2)), "page_id long, url string")
    labels = spark.createDataFrame([], "id long, blocked boolean")
    got = {r["page_id"]: r for r in url_rules.judge(pages, labels, registry.URL_RULES).collect()}
    assert len(got) == 2 * len(URLS)
    for n, url in enumerate(URLS * 2):
        host, path, rule, verdict = judged_by_hand(url)
        assert (got[n]["host"], got[n]["path"], got[n]["rule"]) == (host, path, rule)
        assert got[n]["verdict"] == (verdict or "allow") or (verdict is None and got[n]["mined"])


def test_every_page(spark):
    pages = {r["page_id"]: r["url"] for r in table(spark, SF, "pages").collect()}
    got = rows_of(registry.op2_url_filter(spark, SF))
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = judged_by_hand(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["mined"] else "allow"))


def test_mined_rules_match_by_brute_force(spark):
    rng = random.Random(3)
    baskets = [sorted(set(rng.choices("abcdefgh", k=4))) for _ in range(300)]
    blocked = [("a" in b and "b" in b) for b in baskets]
    labelled = spark.createDataFrame(list(zip(baskets, blocked)), "tokens array<string>, blocked boolean")
    rules = url_rules.mine(labelled, 0.01, 0.9)
    found = {tuple(sorted(r["antecedent"])): r["confidence"] for r in rules.collect()}
    assert found[("a", "b")] == 1.0
    for tokens, confidence in found.items():
        held = [y for b, y in zip(baskets, blocked) if set(tokens) <= set(b)]
        assert confidence == pytest.approx(sum(held) / len(held)) and confidence >= 0.9
    pages = spark.createDataFrame([(str(n), b) for n, b in enumerate(baskets)], "id string, tokens array<string>")
    hit = {int(r["id"]) for r in url_rules.match(pages, rules).collect()}
    assert hit == {n for n, b in enumerate(baskets) if any(set(t) <= set(b) for t in found)}


def test_words_that_come_together_are_one_class(spark):
    """Verdicts against all combinations, by brute force; and twenty common words are mined in seconds."""
    rng = random.Random(4)
    baskets = []
    for _ in range(200):
        b = rng.sample("abcdefgh", 3) + ["x", "y", "z"]  # x y z: in all rows; a comes with a2 and a3
        baskets.append(b + ["a2", "a3"] if "a" in b else b)
    blocked = ["a" in b and "b" in b or "c" in b and "d" in b for b in baskets]
    labelled = spark.createDataFrame(list(zip(baskets, blocked)), "tokens array<string>, blocked boolean")
    rules = url_rules.mine(labelled, 0.01, 0.9)
    assert {"a", "a2", "a3"} in [set(c) for r in rules.collect() for c in r["classes"]]

    least = 5
    found = []
    for k in (1, 2, 3, 4):
        for some in combinations(sorted({t for b in baskets for t in b}), k):
            held = [y for b, y in zip(baskets, blocked) if set(some) <= set(b)]
            if sum(held) >= least and sum(held) >= 0.9 * len(held):
                found.append(set(some))
    queries = [rng.sample(["a", "a2", "a3", "b", "c", "d", "e", "f", "x", "new"], k=rng.randint(1, 5)) for _ in range(150)]
    pages = spark.createDataFrame([(str(n), q) for n, q in enumerate(queries)], "id string, tokens array<string>")
    hit = {int(r["id"]) for r in url_rules.match(pages, rules).collect()}
    wanted = {n for n, q in enumerate(queries) if any(f <= set(q) for f in found)}
    assert wanted and hit == wanted

    words = [f"w{n}" for n in range(20)]
    wide = spark.createDataFrame([(words + [f"u{n % 7}"], n % 7 == 0) for n in range(200)], "tokens array<string>, blocked boolean")
    mined = url_rules.mine(wide).collect()
    assert {tuple(r["antecedent"]) for r in mined} == {("u0",), ("u0", "w0")}
    assert all(set(words) in map(set, r["classes"]) for r in mined if "w0" in r["antecedent"])


def test_url_odd_rows(spark, clashing):
    """Clashing columns, a very long url, one of many tokens, repeated rows."""
    urls = ["http://a.org/" + "x" * 200_000, "http://b.org/" + "/".join(f"t{n}" for n in range(3000)), "http://c.com/", "http://c.com/"]
    pages = spark.createDataFrame([(n % 3, u) for n, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(0, True), (1, False), (None, True)], "id long, blocked boolean")
    got = rows_of(url_rules.judge(clashing(pages).withColumn("host", F.lit("h")).withColumn("tokens", F.lit(1)), labels, registry.URL_RULES))
    assert sorted((r["host"], r["rule"], r["verdict"]) for r in got) == [
        ("a.org", None, "allow"), ("b.org", None, "allow"), ("c.com", "com/", "allow"), ("c.com", "com/", "allow")]


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([], "id long, blocked boolean")
    assert url_rules.judge(pages, labels, registry.URL_RULES).collect() == []


# secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
BASE = [("assign", ASSIGN, lambda m: len(m[2]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]


def secrets_by_hand(text):
    spans = sorted((m.start(), n, kind, m.end()) for n, (kind, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m))
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
    return [sum(x[2] == k for x in spans) for k, _, _ in BASE], hashlib.sha256(joined.encode()).hexdigest()


SECRETS = [
    "token: api_key = abcdefgh12345", "é𝔘 PassWord='abcdefgh' AKIA" + "A" * 12 + " AKIA" + "B" * 11, "ab" * 15, "ab" * 16 + "g" + "0" * 40,
    "api-key=12345678 apikey=12345678 api_key :  \"12345678\"", "secret=token=12345678 secret=short passwd=AKIA" + "Z9" * 20,
    "x" + "f" * 31 + "F" + "e" * 32, "-----BEGIN RSA PRIVATE KEY----- eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMe", "toKen=AbCdEfGh\nSECRET = 0123456789abcdef0123456789abcdef",
    "paſſword=12345678 to\u212aen=12345678",
]


def check_secrets(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        counts, sha = secrets_by_hand(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts and r["base_sha256"] == sha


def test_secrets_by_hand(documents, folder, spark):
    texts = dict(enumerate([*SECRETS, *[t for _, t in ODD]]))
    got = rows_of(registry.op4_secrets(spark, folder(documents=documents(*texts.items()))))
    check_secrets(got, texts)
    assert next(r["spans"] for r in got if r["doc_id"] == 7).startswith("pem:0:31,jwt:32:")


def test_secrets_of_a_table(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    check_secrets(rows_of(registry.op4_secrets(spark, SF)), texts)


def test_ledger_scans_only_what_is_new(documents, spark):
    ledger = shared_folder(spark, "ledger")
    first = documents((1, "token=abcdefgh1"), (2, "nothing"), (3, "token=abcdefgh1"), (3, "token=abcdefgh1"))
    found = {(r["path"], len(r["spans"])) for r in secret_ledger.scan(first, ledger).collect()}
    assert found == {(1, 1), (2, 0), (3, 1)}
    seen = lambda: spark.read.parquet(f"{ledger}/seen")
    assert seen().count() == 2
    second = first.unionByName(documents((4, "token=abcdefgh1"), (5, "AKIA" + "A" * 16)))
    found = {(r["path"], len(r["spans"])) for r in secret_ledger.scan(second, ledger).collect()}
    assert found == {(1, 1), (2, 0), (3, 1), (4, 1), (5, 1)} and seen().count() == 3
    rules = secret_ledger.RULES | {"access": ("AKIA[A-Z0-9]{4,}", 0, 8), "new": ("nothing", 0, 1)}
    found = {(r["path"], len(r["spans"])) for r in secret_ledger.scan(second, ledger, rules=rules).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1)}
    assert seen().count() == 6 and seen().where("size(rules) = 2").count() == 3


def test_ledger_of_nothing(documents, spark):
    assert secret_ledger.scan(documents(), shared_folder(spark, "ledger")).collect() == []


def test_findings_of_a_dead_run_are_not_read(documents, spark):
    ledger = shared_folder(spark, "ledger")
    docs = documents((1, "token=abcdefgh1"))
    secret_ledger.scan(docs, ledger)
    half = spark.read.parquet(f"{ledger}/findings").withColumn("run", F.lit("died"))
    half.write.mode("append").parquet(f"{ledger}/findings")
    assert [len(r["spans"]) for r in secret_ledger.scan(docs, ledger).collect()] == [1]


# quality

def measures_by_hand(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    many = {x for x in windows if windows.count(x) > 1} if len(windows) < 3000 else set(windows)
    covered = {k + j for k, x in enumerate(windows) if x in many for j in range(5)}
    n_dup = len(lines) - len(set(lines))
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": n_dup, "n_repeat_words": len(covered),
            "base_failed": len(w) < 10 or 100 * len(covered) > 20 * len(w)}


def check_measures(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        wanted = measures_by_hand(texts[r["doc_id"]])
        assert {k: r[k] for k in wanted} == wanted
        assert not (r["kept"] and r["base_failed"])


def test_measures_by_hand(documents, folder, spark):
    texts = dict(enumerate([t for _, t in ODD]))
    check_measures(rows_of(registry.op7_quality(spark, folder(documents=documents(*texts.items())))), texts)


def test_measures_of_a_table_and_verdicts(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    check_measures(rows_of(registry.op7_quality(spark, SF)), texts)


def test_verdicts_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
    kept = {r["doc_id"]: r["kept"] or r["n_words"] < 10 for r in rows_of(registry.op7_quality(spark, folder))}
    good = [kept[d] for d in labels if labels[d]]
    bad = [kept[d] for d in labels if not labels[d]]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.15 * len(bad)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=25).map(" ".join), min_size=1, max_size=6))
def test_repeat_words_by_brute_force(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_votes.measure(docs).select("row.*", "measures.*").collect():
        assert r["n_repeat_words"] == measures_by_hand(r["text"])["n_repeat_words"]


def em_by_hand(counts):
    """The share of good documents, and of them behind each rule's bad and good votes; counts: {votes: documents}."""
    q = quality_votes
    good = {v: 1 - q.TRUST if -1 in v else 0.95 for v in counts}

    def share(of, prior):
        n = sum(counts[v] for v in counts if of(v))
        return (sum(counts[v] * good[v] for v in counts if of(v)) + prior * (1 + q.TRUST_WEIGHT * n)) / (n + 1 + q.TRUST_WEIGHT * n)

    def model():
        return share(lambda v: True, q.GOOD), [
            [share(lambda v: v[r] == side, prior) for side, prior in ((-1, 1 - q.TRUST), (1, q.GOOD))] for r in range(len(q.RULES))]

    for _ in range(q.ITERATIONS):
        now = model()
        good = {v: posterior_by_hand(now, v) for v in counts}
    return model()


def posterior_by_hand(model, vote_list):
    odds = quality_votes.GOOD / (1 - quality_votes.GOOD)
    for vote, (bad, good) in zip(vote_list, model[1]):
        p = {-1: bad, 0: model[0], 1: good}[vote]
        odds *= p / (1 - p) / (model[0] / (1 - model[0]))
    return odds / (1 + odds)


@pytest.mark.parametrize("seed", range(3))
def test_fit_and_posterior_by_plain_em(spark, seed):
    """On random votes, on votes of one side only, and of a rule that never votes."""
    rng = random.Random(seed)
    sides = [rng.choice([(-1, 0, 1), (-1, 0), (0, 1), (0,)]) for _ in quality_votes.RULES]
    counts = {tuple(rng.choice(s) for s in sides): rng.randint(1, 10 ** rng.randint(0, 6)) for _ in range(40)}
    patterns = spark.createDataFrame([(list(v), n) for v, n in counts.items()], "votes array<int>, n long")
    model = quality_votes.fit(patterns)
    got = model.first()["model"]
    share, rules = em_by_hand(counts)
    assert got["good"] == pytest.approx(share, abs=1e-9)
    assert [list(r) for r in got["rules"]] == [pytest.approx(r, abs=1e-9) for r in rules]
    judged = patterns.withColumn("model", model.scalar()).select("votes", quality_votes.posterior(F.col("model"), F.col("votes")).alias("p"))
    for r in judged.collect():
        assert r["p"] == pytest.approx(posterior_by_hand((share, rules), r["votes"]), abs=1e-9)


def test_quality_keeps_rows_whole(documents, clashing):
    good = " ".join(f"word{n}" for n in range(60))
    docs = clashing(documents((1, good), (1, good), (2, "x " * 60), (None, good), (3, None)))
    got = quality_votes.keep_good(docs)
    assert got.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == ["1", "1", "None"]
    assert quality_votes.keep_good(documents()).collect() == []


def test_variety_is_of_the_whole_text(documents):
    rng = random.Random(1)
    head = " ".join(f"word{rng.randrange(20)}" for _ in range(400))
    tail = " ".join(f"other{int(3000 * rng.random() ** 2)}" for _ in range(4000))
    dull = " ".join(f"word{rng.randrange(20)}" for _ in range(4400))
    docs = documents((1, head + " " + tail), (2, tail + " " + head), (3, dull))
    got = {r["row"]["doc_id"]: r for r in quality_votes.judge(docs).collect()}
    rule = list(quality_votes.RULES).index("variety")
    assert got[1]["votes"] == got[2]["votes"] and got[1]["votes"][rule] == 1 and got[3]["votes"][rule] == -1
    assert got[1]["measures"]["n_distinct"] == len(set((head + " " + tail).split()))
    assert got[1]["kept"] and got[2]["kept"] and not got[3]["kept"]


# licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FILE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_by_hand(text):
    w = FILE_WORD.findall((text or "").translate(LOWER))
    hits = [(k, label) for phrase, label in license_index.PHRASES.items() for k in range(len(w)) if w[k : k + phrase.count(" ") + 1] == phrase.split()]
    return {"n_words": len(w), "n_base": len(hits), "first_word": min((k for k, _ in hits), default=None),
            "last_word": max((k for k, _ in hits), default=None), "base_labels": ",".join(sorted({x for _, x in hits}))}


def check_licenses(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        wanted = base_by_hand(texts[r["doc_id"]])
        assert {k: r[k] for k in wanted} == wanted
        assert set(wanted["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


LICENSED = [
    "MIT License", "the mit\n*license* and MIT-License", "General Public\tLicense general public public license", "mit  éLicense", "limit license",
    "Licensed under CC BY-NC 4.0.", "Apache License 2\nThis program: redistribute it and/or modify it",
    "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "Redistribution and use in text and other forms, with or without modification, are permitted provided that the following conditions are met",
]


def test_licenses_by_hand(documents, folder, spark):
    texts = dict(enumerate([*LICENSED, *[t for _, t in ODD]]))
    got = rows_of(registry.op8_licenses(spark, folder(documents=documents(*texts.items()))))
    check_licenses(got, texts)
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[5] == "cc-by-nc" and labels[7] == "gpl" and labels[8] == "bsd" and labels[9] == "" and labels[4] == ""


def test_licenses_of_a_table(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    check_licenses(rows_of(registry.op8_licenses(spark, SF)), texts)


def test_license_rows_stay_whole(documents, clashing):
    docs = clashing(documents((1, "MIT License"), (1, "MIT License"), (None, None)))
    got = license_index.scan(docs)
    assert got.select("row.*").columns == docs.columns and got.count() == 3
    assert license_index.scan(documents()).collect() == []


def license_matches(text, idf):
    """label, place and score of every template that is there, tried at every place."""
    words, found = license_words(text), set()
    for label, notice, phrases in license_index.TEMPLATES:
        t = notice.split()
        for at in range(-len(t) + 1, len(words)):
            equal = [0 <= at + i < len(words) and words[at + i] == v for i, v in enumerate(t)]
            score = sum(idf[v] for v, e in zip(t, equal) if e) / sum(idf[v] for v in t)
            there = any(all(equal[k : k + p.count(" ") + 1]) for p in phrases for k in [notice[: notice.index(p)].count(" ")])
            if there and score >= license_index.MIN_COVERAGE:
                found.add((label, at, round(score, 9)))
    return found


def license_words(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))) if w]


def test_license_matches_by_brute_force(documents):
    rng, rows = random.Random(5), []
    for n in range(300):
        words = rng.choice(license_index.TEMPLATES)[1].split()
        for at in rng.sample(range(len(words)), min(len(words), rng.randrange(6))):
            words[at] = rng.choice(["x", "the", words[0]])
        rows.append((n, " ".join(["so"] * rng.randrange(3) + words + ["The", "MIT"] * rng.randrange(2))))
    words = sorted({w for _, notice, _ in license_index.TEMPLATES for w in notice.split()})
    having = [set(license_words(t)) for _, t in rows]
    idf = {w: math.log((1 + len(rows)) / (1 + sum(w in h for h in having))) + 0.01 for w in words}
    got = {r["row"]["doc_id"]: {(m["label"], m["at"], round(m["score"], 9)) for m in r["matches"]} for r in license_index.scan(documents(*rows)).collect()}
    assert got == {n: license_matches(t, idf) for n, t in rows}
    assert sum(map(bool, got.values())) > 100


def test_notice_without_its_rarest_words_is_found(documents):
    notice = license_index.TEMPLATES[2][1].split()
    altered = " ".join([*notice[:-3], "x", "y", "z"])  # words that stand nowhere else are the rarest
    docs = documents((1, altered), *[(n, "some other words") for n in range(2, 200)])
    assert [m["label"] for m in license_index.scan(docs).where("row.doc_id = 1").first()["matches"]] == ["mit"]


def test_a_source_is_dealt_by_its_buckets(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    docs = documents(*[(n, "a b", "en", "one") for n in range(200)])
    schedule = mixing.mix(docs, F.lit(2), [1.0], 1.0)
    plan = schedule._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(skey#\d+, bucket#\d+", plan)
    assert schedule.where("taken > 0").count() == 200
