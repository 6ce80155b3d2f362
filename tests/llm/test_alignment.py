"""Tokenizer alignment against plain Python: the libraries' own ids, sets of offsets, counts of pairs."""

import hashlib
from collections import Counter, defaultdict
from functools import cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment, registry
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
BOTH = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
A, B = Tokenizer.from_file(BOTH.a), SentencePieceProcessor(model_file=BOTH.b)
A.encode_special_tokens = True
ODD = [
    "", None, " ", "  ", "a", "don't  stop", " leading", "trailing ", "tabs\tand\nlines \n\n here", "x\n y", "x \ny", "a  b   c    d",
    "<|endoftext|> <s> </s> <unk> plain", "naïve ﬁ Ünïcode 日本語 🙂👩‍👩‍👧", "a▁b holds a piece's blank", "▁", "\x00\x01 controls", "nbsp\xa0in　side \xa0",
    "é́ é combining", "1234567890 3.14 -- !!! ...", "word " * 50 + "x" * 300,
]

@cache
def a_bytes(n):
    spare = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    return bytes(spare[ord(c) - 256] if ord(c) > 255 else ord(c) for c in A.id_to_token(n))


@cache
def b_bytes(n):
    piece = B.id_to_piece(n)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(n) else piece.replace("▁", " ").encode()


def by_hand(text):
    """The groups: lists of A ids and of B ids."""
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    parts = [a_bytes(n) for n in a], [b_bytes(n) for n in b]
    if {b"".join(p) for p in parts} != {(" " + text).encode()}:
        return []
    ends = [{end: k + 1 for k, end in enumerate(accumulate(map(len, p)))} for p in parts]
    groups, done = [], (0, 0)
    for cut in sorted(ends[0].keys() & ends[1].keys()):
        upto = ends[0][cut], ends[1][cut]
        groups.append((a[done[0] : upto[0]], b[done[1] : upto[1]]))
        done = upto
    return groups


def expected(texts):
    groups = [by_hand(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count, best = Counter(p for c in links for p in c), defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for g, c in zip(groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                     sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
                     hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return rows


def found(docs):
    return [(r[0], tuple(r)[1:]) for r in alignment.linked(docs, BOTH).collect()]


def test_odd_texts(documents):
    assert sorted(found(documents(*enumerate(ODD)))) == list(enumerate(expected(ODD)))


def test_rare_pairs_meet_their_counts(documents, monkeypatch):
    texts = [r["text"] for r in documents(*[(n, f"same words {n % 3} and own{n} words") for n in range(40)]).collect()]
    for head in (0, 5, 40):
        monkeypatch.setattr(alignment, "HEAD", head)
        assert sorted(found(documents(*enumerate(texts)))) == list(enumerate(expected(texts)))


def test_ids_without_the_fast_encoder(monkeypatch):
    fast = alignment.Tokens(BOTH.a, BOTH.b)
    monkeypatch.setattr(alignment.Tokens, "_ranked", staticmethod(lambda spec: None))
    slow = alignment.Tokens(BOTH.a, BOTH.b)
    plain = lambda t: [(a.tolist(), b.tolist()) for a, b in t.ids(ODD)]
    assert plain(fast) == plain(slow)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t'é▁\xa0.9日", max_size=30))
def test_ids_are_those_of_the_whole_text(text):
    tokens = test_ids_are_those_of_the_whole_text.tokens
    (a, b), = tokens.ids([text])
    groups = by_hand(text)
    assert (a.tolist(), b.tolist()) == ([x for g, _ in groups for x in g], [y for _, g in groups for y in g])


test_ids_are_those_of_the_whole_text.tokens = alignment.Tokens(BOTH.a, BOTH.b)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=80))
def test_groups_by_sets_of_ends(kinds):
    """kinds: at each offset a token ends in A (0), in B (1) or in both."""
    a = [n for n, k in enumerate(kinds) if k != 1 or n == len(kinds) - 1]
    b = [n for n, k in enumerate(kinds) if k != 0 or n == len(kinds) - 1]
    cuts = sorted(set(a) & set(b))
    between = lambda ends: [sum(p < e <= c for e in ends) for p, c in zip([-1, *cuts], cuts)]
    assert [x.tolist() for x in alignment.group_sizes(a, b)] == [between(a), between(b)]


def test_groups_of_long_stretches_from_arrays():
    """Stretches around the blocks' lengths, end offsets as arrays: no lists are made of them."""
    rng = np.random.default_rng(4)
    for kept in (0.5, 0.9, 0.99, 1.0):
        for n in (1, 7, 8, 9, 16, 24, 25, 400):
            ends = np.cumsum(rng.integers(1, 9, n))
            a, b = (ends[np.r_[rng.random(n - 1) < kept, True]] for _ in range(2))
            cuts = np.intersect1d(a, b)
            wanted = [np.diff(np.searchsorted(x, cuts, "right"), prepend=0).tolist() for x in (a, b)]
            assert [x.tolist() for x in alignment.group_sizes(a, b)] == wanted


@pytest.mark.parametrize("at_once", [1, 7, 4_000_000])
def test_links_in_parts(at_once, monkeypatch):
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", at_once)
    groups = [[([1, 2, 1], [3, 3]), ([1], [3])], [], [([2], [4])] * 3, [([5, 6], [7, 8, 7])]]
    lists = [[[x for a, _ in g for x in a] for g in groups], [[y for _, b in g for y in b] for g in groups],
             [[len(a) for a, _ in g] for g in groups], [[len(b) for _, b in g] for g in groups]]
    lists = [[np.array(x, np.int64) for x in column] for column in lists]
    got = [(k // 100, k % 100, n) for part in alignment._per_document(lists, 10, 10) for k, n in zip(*(c.tolist() for c in part))]
    want = [(r, p, n) for r, g in enumerate(groups) for p, n in sorted(Counter(10 * x + y for a, b in g for x in a for y in b).items())]
    assert got == want


def test_odd_rows(documents, clashing):
    rows = [(None, "same"), (None, "same"), (1, "one two"), (1, "other"), (2, None)]
    got = sorted(found(clashing(documents(*rows))), key=str)
    assert got == sorted(zip([d for d, _ in rows], expected([t for _, t in rows])), key=str)
    assert found(documents()) == []


def test_query_over_a_table(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in registry.QUERIES["op11_alignment"](spark, SF).collect()}
    want = expected([r["text"] for r in docs])
    assert {n: tuple(r)[1:] for n, r in got.items()} == {r["doc_id"]: w for r, w in zip(docs, want)}


def test_groups_as_arrays(documents):
    rows = alignment.align(documents((1, "un common words"), (2, None)), BOTH).collect()
    for r, text in zip(sorted(rows), ("un common words", None)):
        groups = by_hand(text)
        assert [r["a_ids"], r["b_ids"]] == [[x for a, _ in groups for x in a], [y for _, b in groups for y in b]]
        assert [r["a_sizes"], r["b_sizes"]] == [[len(a) for a, _ in groups], [len(b) for _, b in groups]]
