"""The divergence audit against plain Python and the query against its SQL."""

import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import divergence, registry
from workload.check import duck

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= 3}
        counts = defaultdict(Counter)
        for _, source, terms in mine:
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for s in counts:
            pairs = [(o, sum(f(share(counts[s], t), share(counts[o], t)) for t in kept)) for o in counts if o != s]
            terms = [(t, f(share(counts[s], t), share(whole, t))) for t in counts[s] if share(counts[s], t) > share(whole, t)]
            for part, items, most in (("pair", pairs, None), ("term", terms, 200)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(items[:most])]
    return sorted(out)


ROWS = [
    ("The Cat, the dog; THE end", "en", "a"), ("the cat sat cat cat", "en", "b"), ("a cat and the Ünï ünï", "en", "c"), ("Ünï the ünï", "en", "c"),
    ("Ünï é é", "en", "a"), (None, "en", "empty"), ("no kept terms here", "en", "odd"), ("x y x", "de", "a"), ("x y", "de", "b"), ("x q", "de", "b"),
    ("alone", "fr", "a"), ("alone", "fr", "b"), ("null lang", None, None), ("null lang", None, "a"), ("null lang", "", ""), ("", "only", "one"),
    ("mark\x00within the cat", "en", "z\x00z"), ("null null", "", None),
]


def frame(spark, rows):
    return spark.createDataFrame([(n, *r, len(r[0] or "")) for n, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("vocabulary, block, sources", [(2_000_000, 200_000, 500), (0, 3, 2), (2_000_000, 1, 1)])
def test_by_hand(spark, rows, monkeypatch, vocabulary, block, sources):
    monkeypatch.setattr(divergence, "VOCABULARY", vocabulary)
    monkeypatch.setattr(divergence, "BLOCK_COUNTS", block)
    monkeypatch.setattr(divergence, "SOURCES", sources)
    assert rows(divergence.audit(frame(spark, ROWS))) == sorted(by_hand(ROWS), key=str)


def test_odd_rows(spark, rows, clashing):
    names = ["terms", "term", "n", "total", "kept", "vector", "block", "value"]
    docs = clashing(frame(spark, ROWS * 2)).selectExpr("*", *[f"1 AS {n}" for n in names])
    assert rows(divergence.audit(docs)) == sorted(by_hand(ROWS * 2), key=str)
    assert rows(divergence.audit(frame(spark, []))) == []


def test_shares_of_large_counts(spark):
    row = spark.createDataFrame([(10**12, 3 * 10**12, 10**7)], "n long, total long, kept long")
    got = row.select(divergence._share(*(row[c] for c in row.columns))).first()[0]
    assert got == 1 + 10**9 * (10**12 + 1) // (3 * 10**12 + 10**7)


def test_terms_list_ends_at_its_ranks(spark, rows):
    many = " ".join("".join("abcdefghij"[int(d)] for d in str(n)) for n in range(300))
    docs = [(many, "en", "a")] * 3 + [("a b", "en", "b")] * 400
    got = rows(divergence.audit(frame(spark, docs)))
    assert got == sorted(by_hand(docs), key=str) and sum(r[1] == "a" and r[2] == "term" for r in got) == 200


def test_query_against_sql(spark, rows):
    got = registry.QUERIES["op12_divergence"](spark, SF)
    cursor = duck(SF).execute(registry.ORACLES["op12_divergence"])
    assert [d[0] for d in cursor.description] == got.columns
    assert rows(got) == sorted(cursor.fetchall(), key=str)
