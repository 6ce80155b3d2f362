"""Byte-level BPE against the library on whole texts, for chunks of any size."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, registry
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WHOLE = tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
ODD = [
    "", None, " ", "a", "don't we'll they've I'm " * 40, " " * 500, "a" * 700 + " b", "\n \n" * 200, "x  y   z\t\tq\n\n " * 60,
    "<|endoftext|> as text " * 30, "naïve Ünïcode 日本語テキスト ελληνικά " * 25, "🙂👩‍👩‍👧 ok" * 50, "1234567890" * 80, "!?'r 's 'S ''' " * 50,
    "word " * 13 + "b" * 200 + " tail of words" * 20, "\x00\x1f\x85  　x" * 40, "é́ " * 90,
]


def by_hand(text):
    return WHOLE.encode_ordinary(text or "")


@pytest.mark.parametrize("chunk, overlap", [(32, 17), (64, 40), (200, 50), (1 << 16, 1 << 10)])
def test_ids_of_odd_texts_at_any_cut(documents, chunk, overlap):
    docs = documents(*enumerate(ODD))
    encoded = byte_bpe.encode(docs, RANKS, PATTERN, chunk=chunk, overlap=overlap)
    got = {r["doc_id"]: r for r in byte_bpe.decode(encoded, RANKS).collect()}
    assert {n: r["ids"] for n, r in got.items()} == {n: by_hand(t) for n, t in enumerate(ODD)}
    assert {n: bytes(r["bytes"]).decode() for n, r in got.items()} == {n: t or "" for n, t in enumerate(ODD)}


def test_pieces_meet_where_chunks_agree(documents):
    texts = documents((1, "some words in a row " * 30)).selectExpr("'t' AS id", "doc_id", "1L AS copies", "text")
    found = sorted(byte_bpe.pieces(byte_bpe.cut(texts, 100, 40), PATTERN, 40).collect(), key=lambda r: r["at"])
    assert len(found) == 6
    assert all(r["end"] > r["size"] for r in found[:-1]) and found[-1]["end"] == found[-1]["size"]
    assert [r["at"] + r["begin"] for r in found[1:]] == [r["at"] + r["end"] for r in found[:-1]]


def test_chunks_without_a_seam_are_joined(documents):
    texts = documents((1, "ab " * 30 + "c" * 500 + " de" * 100)).selectExpr("'t' AS id", "doc_id", "1L AS copies", "text")
    found = byte_bpe.pieces(byte_bpe.cut(texts, 100, 40), PATTERN, 40).collect()
    assert max(r["size"] for r in found) >= 500 and sum(r["size"] for r in found) == 890


def test_odd_rows(spark, documents, clashing):
    rows = [(None, "ab " * 50), (None, "ab " * 50), (None, "cd " * 50), (1, None), (1, "x"), (1, "x"), (2, "ef " * 50)]
    encoded = byte_bpe.encode(clashing(documents(*rows)), RANKS, PATTERN, chunk=32, overlap=20)
    got = sorted(((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()), key=str)
    assert got == sorted(((d, tuple(by_hand(t))) for d, t in rows), key=str)
    assert byte_bpe.decode(byte_bpe.encode(documents(), RANKS, PATTERN), RANKS).collect() == []
    with pytest.raises(ValueError):
        byte_bpe.encode(documents(), RANKS, PATTERN, chunk=10, overlap=12)


def test_query_over_a_table(spark):
    got = {r["doc_id"]: r.asDict() for r in registry.QUERIES["op13_byte_bpe"](spark, SF).collect()}
    docs = table(spark, SF, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    assert len(got) == len(docs)
    for r in docs:
        ids = by_hand(r["text"])
        assert got[r["doc_id"]] == {"doc_id": r["doc_id"], "n_tokens": len(ids), "ids_sha256": sha(",".join(map(str, ids)).encode()),
                                    "decoded_sha256": sha(r["text"].encode())}
