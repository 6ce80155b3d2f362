"""SimHash trees, language codes, decontamination, token files and repeats against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import decontam_wand, langid_codes, registry, simhash_trees, suffix_radix, token_coder
from tidemark.llm.common import table
from tidemark.llm.components import components
from tidemark.session import shared_folder

from test_native import LOWER, ODD, WORD, rows_of

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def texts_of(spark, folder=SF):
    return {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}


# components

@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), max_size=40))
def test_components_by_brute_force(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root[n] for n in linked}


def test_components_of_a_long_path(spark):
    df = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in components(df).collect()} == {0}


# SimHash

def print_by_hand(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_by_hand(prints):
    """prints: doc_id -> fingerprint; smallest doc_id reachable over links of 3 bits."""
    ids = sorted(prints)
    root = {i: i for i in ids}
    changed = True
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 3]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_simhash_of_a_table(spark):
    prints = {d: print_by_hand(t) for d, t in texts_of(spark).items()}
    got = rows_of(registry.op3_simhash(spark, SF))
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == prints and len(got) == len(prints)
    assert {r["doc_id"]: r["component_id"] for r in got} == groups_by_hand(prints)


def test_simhash_odd_rows(spark, documents, clashing, folder):
    got = rows_of(registry.op3_simhash(spark, folder(documents=clashing(documents(*ODD)))))
    assert len(got) == len(ODD)
    zero = [r for r in got if r["doc_id"] in (1, 2, 3)]
    assert {r["fingerprint"] for r in zero} == {"0" * 16} and {r["component_id"] for r in zero} == {1}
    assert all(int(r["fingerprint"], 16) == print_by_hand(dict(ODD)[r["doc_id"]]) for r in got)
    assert next(r for r in got if r["doc_id"] is None)["component_id"] is None
    assert simhash_trees.near_duplicates(documents()).collect() == []


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 3))
def test_trees_link_what_brute_force_links(seed, width):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, (4, width), dtype=np.uint64)
    x = centres[rng.integers(0, 4, 60)]
    for _ in range(4):
        x = x ^ (np.uint64(1) << rng.integers(0, 64, x.shape, dtype=np.uint64)) * rng.integers(0, 2, x.shape, dtype=np.uint64)
    shard = np.sort(rng.integers(0, 3, 60))
    root = simhash_trees.forest_links(shard, x, 3)
    near = (np.bitwise_count(x[:, None] ^ x[None]).sum(axis=2) <= 3) & (shard[:, None] == shard[None])
    wanted = np.arange(60)
    for _ in range(60):
        wanted = np.where(near, wanted[None], 99).min(axis=1)
    assert (root == wanted).all()


def test_every_close_pair_shares_a_shard():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**64, (2000, 1), dtype=np.uint64)
    y = x.copy()
    for _ in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, y.shape, dtype=np.uint64)
    assert (simhash_trees._keys(x, simhash_trees.CLOSE) == simhash_trees._keys(y, simhash_trees.CLOSE)).any(axis=1).all()


def test_one_of_each_group(documents, clashing):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{n}" for n in range(3000)]
    base = list(rng.choice(vocabulary, 300))
    near = base[:150] + ["changed"] + base[151:]
    other = list(rng.choice(vocabulary, 300))
    half = base[:150] + list(rng.choice(vocabulary, 150))
    docs = clashing(documents((5, " ".join(base)), (2, " ".join(near)), (7, " ".join(base)), (2, " ".join(near)),
                              (9, " ".join(other)), (10, " ".join(half))))
    got = simhash_trees.one_of_each(docs)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [2, 9, 10]


def test_groups_are_of_similar_texts_only(documents):
    """Against the exact similarity of all pairs, on texts just above and below 0.8 and in chains."""
    rng = np.random.default_rng(3)
    fresh = iter(range(10**6))
    texts = []
    for n in range(40):  # a base; runs replaced at its end so that just enough or too few shingles are shared
        base = [f"b{n}x{k}" for k in range(404)]
        texts.append(base)
        for cut in (44, 45, 70, 110)[: 1 + n % 4]:
            texts.append(base[: 404 - cut] + [f"f{next(fresh)}" for _ in range(cut)])
    texts.append(["refrain"] * 500 + [f"one{k}" for k in range(40)])
    texts.append(["refrain"] * 500 + [f"two{k}" for k in range(40)])
    step = [f"c{k}" for k in range(400)]
    for _ in range(4):
        texts.append(step)
        step = step[30:] + [f"f{next(fresh)}" for _ in range(30)]
    sets = [set(zip(*(t[k:] for k in range(5)))) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    got = {r["doc_id"] for r in simhash_trees.one_of_each(documents(*[(n, " ".join(t)) for n, t in enumerate(texts)])).collect()}
    wanted = set(root)
    assert not wanted - got  # nothing below 0.8 goes
    assert len(got - wanted) <= 2  # and hardly a link is missed


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, 3000), st.integers(0, 400))
def test_bound_admits_every_similar_pair(seed, common, own):
    rng = np.random.default_rng(seed)
    h = rng.integers(0, 2**64, common + 2 * own, dtype=np.uint64)
    if seed % 3 == 0:  # all in few buckets: counts of 255 and more
        h = np.unique(h // np.uint64(simhash_trees.BUCKETS) * np.uint64(simhash_trees.BUCKETS))
    one, two = np.unique(h[: common + own]), np.unique(np.r_[h[:common], h[common + own :]])
    counts = np.frombuffer(simhash_trees.bucket_counts(one) + simhash_trees.bucket_counts(two), np.uint8).reshape(2, -1)
    n = np.array([len(one), len(two)])
    got = simhash_trees.may_be_similar(counts, n, np.array([0]), np.array([1]))
    both = len(np.intersect1d(one, two))
    if 5 * both >= 4 * (len(one) + len(two) - both):
        assert got[0]
    if common == 0 and own > 0 and seed % 3:
        assert not got[0] or own > 200


def test_near_texts_that_are_not_similar_are_not_all_paired(spark, documents, monkeypatch):
    """A group of 150 texts at similarity 0.75 of each other: after the first search hardly a pair is a candidate, all rows stay."""
    rng, tried = np.random.default_rng(7), []
    base = [f"b{k}" for k in range(1200)]
    texts = []
    for n in range(150):
        text = list(base)
        for k in rng.choice(240, 17, replace=False):
            text[5 * k] = f"n{n}x{k}"
        texts.append(" ".join(text))
    similar = simhash_trees._similar

    def counted(pairs, sets):
        tried.append(pairs.count())
        return similar(pairs, sets)

    monkeypatch.setattr(simhash_trees, "_similar", counted)
    got = simhash_trees.one_of_each(documents(*enumerate(texts))).collect()
    assert len(got) == 150
    assert tried[0] > 150 and sum(tried[1:]) < 150 * 149 / 2 / 10


def test_each_fingerprint_is_one_node_and_each_text_is_searched_again_once(documents, monkeypatch):
    """Texts that differ in blanks and case have one fingerprint; near texts that fail meet in many shards."""
    rng, nodes, parts = np.random.default_rng(8), [], []
    base = [f"b{k}" for k in range(1200)]
    texts = [" ".join(base), "  ".join(base), " ".join(base).upper()]
    for n in range(30):
        text = list(base)
        for k in rng.choice(240, 17, replace=False):
            text[5 * k] = f"n{n}x{k}"
        texts += [" ".join(text), "\t".join(text)]
    meetings, staged = simhash_trees.meetings, simhash_trees.staged

    def met(prints, scheme):
        nodes.append((prints.count(), prints.select("print").distinct().count()))
        return meetings(prints, scheme)

    def kept(df, purpose, **options):
        out = staged(df, purpose, **options)
        if purpose == "parts":
            parts.append((out.count(), out.select("id").distinct().count()))
        return out

    monkeypatch.setattr(simhash_trees, "meetings", met)
    monkeypatch.setattr(simhash_trees, "staged", kept)
    got = sorted(r["doc_id"] for r in simhash_trees.one_of_each(documents(*enumerate(texts))).collect())
    assert nodes == [(31, 31)]
    assert parts and all(a == b <= 63 for a, b in parts)
    sets = [set(zip(*(t.lower().split()[k:] for k in range(5)))) for t in texts]
    similar = [[5 * len(x & y) >= 4 * len(x | y) for y in sets] for x in sets]
    root = list(range(len(texts)))
    for _ in root:
        root = [min(r for r, s in zip(root, row) if s) for row in similar]
    assert got == sorted(set(root))


def test_short_texts_one_word_apart_are_one_group(documents):
    """Four shingles of five: such fingerprints differ in 192 bits on average, which half of the pairs exceed."""
    rows = []
    for n in range(80):
        text = [f"t{n}x{k}" for k in range(9)]
        rows += [(2 * n, " ".join(text[:8])), (2 * n + 1, " ".join(text))]
    rows += [(200 + k, " ".join(f"c{w}" for w in range(k, k + 20))) for k in range(4)]  # 15 of 17 shared, step by step
    assert sorted(r["doc_id"] for r in simhash_trees.one_of_each(documents(*rows)).collect()) == [*range(0, 160, 2), 200]


def test_missed_pairs_are_found_whatever_the_fingerprints(documents, monkeypatch):
    """Nothing is proposed by fingerprints; texts of all lengths around 0.8, some with a passage that all share."""
    rng, texts = np.random.default_rng(11), []
    passage = [f"p{k}" for k in range(60)]
    for n in range(60):
        base = (passage if n % 3 == 0 else []) + [f"b{n}x{k}" for k in range(int(rng.integers(1, 150)))]
        texts += [base, base[: len(base) - len(base) // 6], base[len(base) // 9 :] + [f"e{n}"]]
    texts += [[], [" "]]
    monkeypatch.setattr(simhash_trees, "meetings", lambda prints, scheme: prints.selectExpr("id AS shard", "id AS a", "id AS b").limit(0))
    docs = documents(*[(n, " ".join(t)) for n, t in enumerate(texts)])
    got = sorted(r["doc_id"] for r in simhash_trees.one_of_each(docs).collect())
    sets = [{tuple(t[k : k + 5]) for k in range(max(len(t) - 4, 1))} for t in [" ".join(t).split() for t in texts]]
    similar = [[5 * len(x & y) >= 4 * len(x | y) for y in sets] for x in sets]
    root = list(range(len(texts)))
    for _ in root:
        root = [min(r for r, s in zip(root, row) if s) for row in similar]
    assert got == sorted(set(root)) and len(got) < len(texts)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([5, 100, 2_000_000]))
def test_similar_sets_meet_by_their_rarest(seed, at_once):
    rng = np.random.default_rng(seed)
    pool, sets = rng.integers(0, 2**64, 80, dtype=np.uint64), []
    for _ in range(6):
        base = rng.choice(pool, rng.integers(1, 40), replace=False)
        sets += [np.unique(np.r_[base[rng.random(len(base)) > 0.08], rng.choice(pool, rng.integers(0, 3))]) for _ in range(5)]
    sets.sort(key=len)
    n, root = np.array([len(s) for s in sets]), rng.integers(0, 12, len(sets))
    steps = rng.integers(0, 4, simhash_trees.RARITIES).astype(np.uint8)
    doc, shingle, left = simhash_trees._rows_of_rarest(n, [simhash_trees.rarest(s, steps).tobytes() for s in sets])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(simhash_trees, "FRONTIER", at_once)
        met = [p for a, b in simhash_trees.may_meet(shingle, doc, left, n, root) for p in zip(a.tolist(), b.tolist())]
    assert len(met) == len(set(met)) and all(root[a] != root[b] for a, b in met)
    for b in range(len(sets)):
        for a in range(b):
            both = len(np.intersect1d(sets[a], sets[b]))
            if root[a] != root[b] and n[a] and 5 * both >= 4 * (n[a] + n[b] - both):
                assert (a, b) in met


def test_one_of_each_group_whatever_the_ids(documents, clashing):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice([f"w{n}" for n in range(3000)], 200)) for _ in range(6)]
    near = texts[0].replace(texts[0].split()[100], "changed")
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[5]),
            (8, texts[5]), (3, near), (9, texts[2])]
    got = rows_of(simhash_trees.one_of_each(clashing(documents(*rows))))
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted([
        ("3", near), ("None", texts[1]), ("9", texts[2]), ("7", texts[3]), ("7", texts[4]), ("7", texts[5])])


# language

def test_language_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    got = rows_of(registry.op5_language(spark, "/root/testdata/sf0.01"))
    assert len(got) == len(lang)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_language_odd_rows(documents, clashing):
    learn = [(n, "the and of to in is it" if n % 2 else "der die das und ist ein", "en" if n % 2 else "de") for n in range(40)]
    odd = [(100, None), (101, "123 ?! 456"), (102, ""), (None, "the and of"), (103, "the and " * 400_000), (104, "é" * 3), (100, None)]
    got = langid_codes.identify(clashing(documents(*learn, *odd))).collect()
    assert len(got) == 47
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by_id[100] == by_id[101] == by_id[102] == "und" and by_id[103] == "en" and by_id[None] == "en" and by_id[104] in ("en", "de")
    assert all(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de") for r in got if r["doc_id"] is not None and r["doc_id"] < 40)
    assert {r["lang_pred"] for r in langid_codes.identify(documents(*odd)).collect()} == {"und"}
    assert langid_codes.identify(documents()).collect() == []
    assert {r["lang_pred"] for r in langid_codes.identify(documents((0, "ab cd", "xx"), (1, "ab", "xx"), (3, "ab", "xx"))).collect()} == {"xx"}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 20])
def test_codewords_differ(n):
    codes = langid_codes.codewords(n)
    apart = [(a != b).sum() for k, a in enumerate(codes) for b in codes[:k]]
    assert len(codes) == n and min(apart, default=1) >= (1 if n < 3 else 2)
    if n > langid_codes.CODE_ALL:
        assert min(apart) >= 20


# decontamination

ITEM = "Which river is the longest in the northern part of this invented country? The river Alpha beats the river Beta by miles."


def test_leaks_of_a_table_by_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    items = {r["item_id"]: r["text"] for r in table(spark, folder, "benchmark").collect()}
    wanted = {(d, i) for d, t in texts_of(spark, folder).items() for i, x in items.items() if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in registry.op6_decontamination(spark, folder).collect()}
    shingles = {i: decontam_wand.shingles(decontam_wand.item_words(x)) for i, x in items.items()}
    every = {d: decontam_wand.shingles(decontam_wand.item_words(t)) for d, t in texts_of(spark, folder).items()}
    covered = {(d, i) for d, s in every.items() for i, x in shingles.items() if x and len(x & s) >= 0.8 * len(x)}
    assert wanted and wanted <= got == covered


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_no_score_above_the_threshold_is_missed(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{n}" for n in range(40)]
    items = [(n, " ".join(rng.choice(vocabulary, rng.integers(1, 12)))) for n in range(23)]
    index = decontam_wand.Index(items)
    words = [f"{w}" for w in rng.choice(vocabulary + ["other"] * 20, 90)]
    terms = np.array([index.term.get(w, -1) for w in words])
    got = {(first, n): s for _, first, n, s in decontam_wand._candidates(index, [terms[:0], terms])}
    for first in range(0, 90, index.longest):
        there = set(terms[first : first + 2 * index.longest].tolist())
        for n in range(len(index.ids)):
            score = sum(x for t in there if t >= 0 for m, x in index.postings[t] if m == n)
            assert (score >= decontam_wand.THRESHOLD) == ((first, n) in got)


def test_leaks_odd_rows(spark, documents, clashing):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, "!?"), (4, "Yes."), (1, ITEM)], "item_id long, text string")
    filler = "unrelated words " * 60_000
    docs = clashing(documents((1, filler + ITEM.upper() + " " + filler), (2, ITEM[:60]), (3, None), (None, ITEM), (4, ITEM.replace(" ", "\n ")),
                              (5, "of the river in this country is the part"), (1, ""), (6, ITEM.replace("miles", "yards"))))
    leaks = decontam_wand.leaks(docs, items).where("item_id = 1").collect()
    assert {r["doc_id"] for r in leaks} == {1, None, 4, 6}
    kept = decontam_wand.without_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]
    assert decontam_wand.leaks(documents(), items).collect() == []
    assert decontam_wand.leaks(documents((1, ITEM)), items.limit(0)).collect() == []


def test_only_the_rows_that_leak_are_dropped(spark, documents, clashing):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = clashing(documents((None, "x " + ITEM), (None, "clean"), (None, None), (5, ITEM), (5, "clean too"), (5, ITEM)))
    kept = decontam_wand.without_leaks(docs, items, by_row=True)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == [("5", "clean too"), ("None", "None"), ("None", "clean")]


# token files

@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(0, 70_000) | st.integers(0, 3), max_size=60), max_size=6))
def test_blocks_round_trip(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    back = token_coder.unpack(token_coder.pack(blocks))
    assert [b.tolist() for b in back] == [b.tolist() for b in blocks]


def test_blocks_are_small_and_checked():
    rng = np.random.default_rng(1)
    plain = [np.zeros(8192, np.uint32), np.tile(np.arange(50, dtype=np.uint32), 164)[:8192], rng.integers(0, 2**32, 8192).astype(np.uint32)]
    packed = token_coder.pack(plain)
    assert all((a == b).all() for a, b in zip(plain, token_coder.unpack(packed)))
    assert len(packed[0]) < 100 and len(packed[1]) < 4000
    hurt = bytearray(packed[1])
    hurt[-200] ^= 16
    with pytest.raises(ValueError):
        token_coder.unpack([bytes(hurt)])
    with pytest.raises(ValueError):
        token_coder.unpack([b"nonsense"])


def test_coder_tables_are_small_and_their_bytes_the_same():
    """op9: most time went into fetching table rows of 64 bytes; what is coded has not changed."""
    assert token_coder.Mixer(8, 3).table.nbytes // 8 < 80_000
    blocks = [(np.arange(8192, dtype=np.uint64) ** 2 * (n + 3) % 4093 % (40 * n + 1)).astype(np.uint32) for n in range(4)]
    assert [zlib.crc32(p) for p in token_coder.pack(blocks)] == [79614907, 3663157909, 3406477419, 860031705]


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_crc_of_two_parts(a, b):
    assert token_coder.combine_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def tokens_by_hand(texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [e.ids + [1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_tokens(rows, texts):
    """texts: in order."""
    ids = tokens_by_hand([t for _, t in texts])
    starts = np.cumsum([0, *map(len, ids)])
    wanted = [(d, int(s), len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for (d, _), s, i in zip(texts, starts, ids)]
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=lambda r: r[1]) == wanted


def test_token_files_of_a_table(spark):
    check_tokens(rows_of(registry.op9_token_files(spark, SF)), sorted(texts_of(spark).items()))


def test_token_files_odd_rows(spark, documents, clashing, monkeypatch):
    monkeypatch.setattr(token_coder, "BLOCK_IDS", 16)
    monkeypatch.setattr(token_coder, "LANES", 5)
    rows = [(1, None), (2, ""), (3, "a \x1c b c d\x85e"), (5, "<|endoftext|> x<|startoftext|>y İΣ é don't"),
            (7, "long text of many words " * 200), (8, "\t\r\n \x0b\x0c"), (9, "z"), (9, "z"), (12, "12345 ünï̈")]
    path = shared_folder(spark, "tokens")
    token_coder.write(clashing(documents(*reversed(rows), (None, "first"))), path, TOKENIZER, 1)
    check_tokens(rows_of(token_coder.documents(spark, path)), [(None, "first"), *rows])
    ids = [i for _, _, part in sorted((r["part"], r["first"], r["ids"]) for r in token_coder.read(spark, path).collect()) for i in part]
    assert ids == [i for doc in tokens_by_hand([t for _, t in [(None, "first"), *rows]]) for i in doc]


def test_token_files_of_nothing(spark, documents):
    path = shared_folder(spark, "tokens")
    token_coder.write(documents(), path, TOKENIZER, 1)
    assert token_coder.documents(spark, path).collect() == []


# repeats

def repeats_by_hand(texts):
    """texts: (doc_id, text) in order -> per document what removed() returns."""
    seen, out = set(), []
    for doc, text in texts:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            window = b[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def as_tuples(rows):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows), key=str)


def planted(seed, n=40):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdé"), rng.integers(1, 5)))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for k in range(n):
        own = [" ".join(word() for _ in range(rng.integers(1, 60))) for _ in range(3)]
        cut = rng.integers(0, 120)
        texts.append((k, own[0] + (passage[cut:] if k % 2 else passage[: len(passage) - cut]) + own[1] + (own[0] if k % 5 == 0 else "") + own[2]))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot", [2, 5, 10_000])
def test_repeats_by_brute_force(spark, documents, monkeypatch, seed, hot):
    monkeypatch.setattr(suffix_radix, "CHUNK", 700)
    monkeypatch.setattr(suffix_radix, "SLICE_RUNS", 50)
    plain = suffix_radix.repeated_spans
    monkeypatch.setattr(suffix_radix, "repeated_spans", lambda docs: plain(docs, hot))
    texts = planted(seed)
    assert as_tuples(suffix_radix.removed(documents(*texts)).collect()) == sorted(repeats_by_hand(texts), key=str)


def test_repeats_odd_rows(spark, documents, clashing):
    same = "the same words over and over again until the text is longer than a hundred bytes, which it now surely is."
    rows = [(None, same), (1, None), (2, ""), (3, same), (4, "a" * 350), (5, "a" * 99), (6, same[:-1]), (7, "ab" * 200 + same + "ab" * 100), (8, "é" * 120)]
    got = suffix_radix.removed(clashing(documents(*reversed(rows))), keep_text=True).collect()
    assert as_tuples(got) == sorted(repeats_by_hand(rows), key=str)
    assert next(r["kept"] for r in got if r["doc_id"] == 3) == b""
    assert suffix_radix.removed(documents()).collect() == []


def test_repeated_rows_are_one(spark, documents):
    one = "".join(chr(97 + k * k % 23) + chr(97 + k % 19) for k in range(200))
    got = suffix_radix.removed(documents((1, one), (1, one), (2, one))).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 400)]
    apart = suffix_radix.removed(documents((1, one), (1, "x" * 50 + one))).collect()
    assert sorted(r["n_removed"] for r in apart) in ([0, 400],)


def test_repeats_of_a_table(spark):
    assert as_tuples(registry.op10_repeats(spark, SF).collect()) == sorted(repeats_by_hand(sorted(texts_of(spark).items())), key=str)


def test_leaks_do_not_depend_on_shards(spark, documents, monkeypatch):
    """Items with a long common stem: their own words alone tell them apart."""
    stem = " ".join(f"stem{n}" for n in range(25))
    items = spark.createDataFrame([(n, f"{stem} own{n}a own{n}b own{n}c own{n}d own{n}e. Answer{n} is{n} this{n} one{n} here{n}") for n in range(10)], "item_id long, text string")
    texts = [(n, f"before {stem} own{n}a own{n}b own{n}c own{n}d own{n}e. Answer{n} is{n} this{n} one{n} here{n} after") for n in range(5)]
    docs = documents(*texts, (100, stem), (101, f"{stem} other words follow here and there and everywhere"))
    found = []
    for words in (200_000, 60):
        monkeypatch.setattr(decontam_wand, "SHARD_WORDS", words)
        rows = decontam_wand.leaks(docs, items).collect()
        found.append(sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in rows))
    assert found[0] == found[1] and [r[:2] for r in found[0]] == [(n, n) for n in range(5)]


def test_repeats_of_rows_with_one_id(spark, documents):
    """A third of the ids null, each with a text of its own."""
    rng = random.Random(3)
    own = lambda: "".join(rng.choices("abcdefgh", k=150))
    shared = own()
    rows = [(None if n % 3 == 0 else n, own() + (shared if n % 2 else "")) for n in range(30)]
    got = suffix_radix.removed(documents(*rows)).collect()
    assert sum(r["n_removed"] > 0 for r in got) == 14
    assert sum(r["n_removed"] for r in got if r["n_removed"]) >= 14 * 150
