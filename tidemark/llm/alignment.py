"""Alignment of two tokenizers' tokens by diagonal run skipping, and counts of linked ids.

Both tokenizations of a text cover the same bytes. Where a token of each ends at one offset,
the text is cut; what lies between two cuts is a group, and all its tokens are linked. The
end offsets are two rising arrays: from a cut on, blocks of doubling length (from 8 tokens) are compared at
the current index shift, so that a stretch of one-to-one groups is jumped in a few steps;
where a block differs the stretch's end is the first bit that does. The irregular group there is
resolved by walking both arrays to the next common end, which gives the new shift.

A pair of ids counts once for each document that links it. Documents' pairs are counted
where they are read and summed by Spark. Scoring goes over the documents again: counts that
are high, at most HEAD of them whatever the corpus, are sent to every task; pairs with lower
counts meet theirs in a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, staged

ship(__name__)

#: Words whose tokens a task remembers, the longest of them, and rows that it holds unpacked.
MEMO, MEMO_CHARS, ROWS_AT_ONCE = 300_000, 64, 250
#: Pairs that a task counts before it passes them on, and links that are spelled out at a time.
HELD, LINKS_AT_ONCE = 500_000, 250_000
#: Counts that are sent to every task, at most: 16 bytes each.
HEAD = 1_000_000
#: Blanks that no other white space touches: both tokenizers begin anew there.
SINGLE = re.compile(r"(?<=\S) (?=\S)")
DOUBLE = re.compile(r"\s | \s")
#: The pattern of byte-level tokenizers files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LISTS = ["a_ids", "b_ids", "a_sizes", "b_sizes"]


@dataclass(frozen=True)
class Tokenizers:
    """Paths of a byte-level BPE (A, a tokenizers file) and a SentencePiece model that adds a space (B)."""

    a: str
    b: str

    def load(self) -> "Tokens":
        return Tokens(self.a, self.b)

    def sizes(self) -> tuple[int, int]:
        """Of the vocabularies."""
        tokens = self.load()
        return len(tokens.a_bytes), len(tokens.b_bytes)


class Tokens:
    """Ids of a space and a text by A and B. B's are remembered word by word.

    A word here begins with a single blank: B has no piece with a blank after another
    character, so no merge goes across one.
    """

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor

        with open(a, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.b = SentencePieceProcessor(model_file=b)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, n in vocabulary.items():
            self.a_bytes[n] = _byte_level(token)
        self.b_bytes = [_piece(self.b.id_to_piece(n)) for n in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        self.encode_a = self._ranked(spec) or self._plain(a)
        self.known: dict[str, bytes] = {}
        #: Known words whose bytes B does not give back.
        self.odd: set[str] = set()

    @staticmethod
    def _plain(path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    @staticmethod
    def _ranked(spec: dict):
        """An encoder with the file's ids as ranks, which is much faster and the same where ids follow the merges' order
        after those of the bytes; None where they do not, or the file asks for more than byte-level BPE."""
        from tiktoken import Encoding

        model, before = spec["model"], spec["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before["use_regex"] and not (
            before["add_prefix_space"] or spec["normalizer"] or model["dropout"] or model.get("ignore_merges"))
        if not plain or any(model["vocab"].get(x + y) != 256 + n for n, (x, y) in enumerate(merges)):
            return None
        ranks = {_byte_level(token): n for token, n in model["vocab"].items() if n < 256 + len(merges)}
        encode = Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda text: np.array(encode(text), np.int32)

    def _learn(self, words: list[str]) -> None:
        """Remembers words' ids by B."""
        of = self.b_bytes
        for w, ids in zip(words, self.b.encode(words)):
            if b"".join([of[n] for n in ids]) != b" " + w.encode():
                self.odd.add(w)
            self.known[w] = array("i", ids).tobytes()

    def _of_b(self, text: str, words: list[str]) -> np.ndarray | None:
        """Ids by B; None where their bytes are not the text's. Bytes that are wrong in a word can be right in the whole."""
        if not self.odd or self.odd.isdisjoint(words):
            return np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32)
        ids = self.b.encode(text)
        return np.array(ids, np.int32) if b"".join([self.b_bytes[n] for n in ids]) == (" " + text).encode() else None

    def ids(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids by A and by B of each text, none where the bytes of one of them are not the text's."""
        for at in range(0, len(texts), ROWS_AT_ONCE):
            some = texts[at : at + ROWS_AT_ONCE]
            split = [_words(t or "") for t in some]
            every = set(chain.from_iterable(split))
            if len(self.known) + len(every) > MEMO:
                self.known, self.odd = {}, set()
            new = list(every - self.known.keys())
            self._learn(new)
            for text, words in zip(some, split):
                b = self._of_b(text, words) if text else None
                if b is None:
                    yield _NONE, _NONE
                    continue
                a = self.encode_a(" " + text)
                # Byte-level tokens are the text's bytes unless the vocabulary lacks some.
                yield (a, b) if self.a_sizes[a].sum() == self.b_sizes[b].sum() else (_NONE, _NONE)
            for w in new:
                if len(w) > MEMO_CHARS:
                    del self.known[w]


_NONE = np.empty(0, np.int32)


def _words(text: str) -> list[str]:
    """The text cut at blanks that no other white space, or end of the text, touches."""
    if DOUBLE.search(text) or text[:1].isspace() or text[-1:].isspace():
        return SINGLE.split(text)
    return text.split(" ")


def _byte_level(token: str) -> bytes:
    """The bytes of a byte-level token: printable bytes are their own characters, the others follow U+0100 in turn."""
    return bytes(b for b in map(_BYTE_OF.get, token) if b is not None)


def _bytes_of_characters() -> dict[str, int]:
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


_BYTE_OF = _bytes_of_characters()


def _piece(piece: str) -> bytes:
    """The bytes of a piece: <0xHH> is one byte, U+2581 a space."""
    if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def group_sizes(a: Sequence[int], b: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B in each group, in order; a, b: end offsets of their tokens, with the same last one."""
    # Blocks are compared as bytes, eight an offset; single offsets are read through the views.
    whole_a, whole_b = (np.asarray(x, np.int64).tobytes() for x in (a, b))
    at_a, at_b = memoryview(whole_a).cast("q"), memoryview(whole_b).cast("q")
    i = j = groups = 0
    end = len(at_a)
    irregular: list[tuple[int, int, int]] = []  # group, tokens of A, tokens of B
    while i < end:
        begin, step = i, 8
        while (block := whole_a[8 * i : 8 * (i + step)]) == (other := whole_b[8 * j : 8 * (j + step)]) and block:
            i += len(block) // 8
            j += len(block) // 8
            step *= 2
        if block != other:  # the stretch ends at the first bit that differs
            odd = int.from_bytes(block, "little") ^ int.from_bytes(other, "little")
            same = ((odd & -odd).bit_length() - 1) // 64
            i += same
            j += same
        groups += i - begin
        if i == end:
            break
        first, other = i, j
        x, y = at_a[i], at_b[j]
        while x != y:
            if x < y:
                i += 1
                x = at_a[i]
            else:
                j += 1
                y = at_b[j]
        i += 1
        j += 1
        irregular.append((groups, i - first, j - other))
        groups += 1
    sizes = np.ones((2, groups), np.int32)
    if irregular:
        at, m, n = zip(*irregular)
        sizes[0, at], sizes[1, at] = m, n
    return sizes[0], sizes[1]


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ROWS_AT_ONCE rows."""
    for batch in batches:
        yield from (batch.slice(at, ROWS_AT_ONCE) for at in range(0, batch.num_rows, ROWS_AT_ONCE))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)])
    values = np.concatenate([np.empty(0, np.int32), *parts]).astype(np.int32, copy=False)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _packed(parts: list[np.ndarray]) -> pa.Array:
    """Each list's integers as the bytes of unsigned 32-bit ones: Spark moves and stores them unseen."""
    return pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), "<u4").astype(np.int64) for v in column]


def align(docs: DataFrame, tokenizers: Tokenizers, key: str = "doc_id", text: str = "text", packed: bool = False) -> DataFrame:
    """doc_id, a_ids, b_ids, a_sizes, b_sizes (tokens of each group) of every row of docs, as arrays or packed.

    Null and empty texts, and texts whose bytes one of the tokenizers does not give back, have
    no tokens. Null keys and repeated rows stay, other columns are ignored; an empty table
    gives no rows. A long text is tokenized and aligned as a whole, by one task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizers.load()
        for batch in _few(batches):
            a_ids, b_ids, a_sizes, b_sizes = [], [], [], []
            for a, b in tokens.ids(batch.column(1).to_pylist()):
                m, n = group_sizes(np.cumsum(tokens.a_sizes[a]), np.cumsum(tokens.b_sizes[b]))
                for column, value in zip((a_ids, b_ids, a_sizes, b_sizes), (a, b, m, n)):
                    column.append(value)
            columns = map(_packed if packed else _lists, (a_ids, b_ids, a_sizes, b_sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *LISTS])

    kind = "binary" if packed else "array<int>"
    wanted = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return wanted.mapInArrow(run, ", ".join(["doc_id long", *(f"{c} {kind}" for c in LISTS)]))


def document_pairs(lists: list[list[np.ndarray]], n_a: int, n_b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked ids of aligned rows (their a_ids, b_ids, a_sizes, b_sizes): key (row in the batch * n_a * n_b + a * n_b + b), rising, and how often.
    Keys are distinct within one of the parts that are given; a row may go on in the next part."""
    a, b, m, n = (np.concatenate([np.empty(0, np.int64), *column]) for column in lists)
    row = np.repeat(np.arange(len(lists[2])), [len(x) for x in lists[2]]) * (n_a * n_b)
    at_a, at_b = np.cumsum(m) - m, np.cumsum(n) - n
    links = m * n
    upto = np.cumsum(links)
    first = 0
    while first < len(m):
        # Whole groups up to LINKS_AT_ONCE links; one that is larger goes alone, by its distinct ids.
        end = int(np.searchsorted(upto, (upto[first - 1] if first else 0) + LINKS_AT_ONCE, "right"))
        if end <= first:
            x, of_x = np.unique(a[at_a[first] : at_a[first] + m[first]], return_counts=True)
            y, of_y = np.unique(b[at_b[first] : at_b[first] + n[first]], return_counts=True)
            step = max(1, LINKS_AT_ONCE // len(y))
            for k in range(0, len(x), step):
                yield (row[first] + x[k : k + step, None] * n_b + y).ravel(), np.outer(of_x[k : k + step], of_y).ravel()
            first += 1
            continue
        k = links[first:end]
        group = np.repeat(np.arange(first, end), k)
        nth = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        step = n[group]
        keys = row[group] + a[at_a[group] + nth // step] * n_b + b[at_b[group] + nth % step]
        yield np.unique(keys, return_counts=True)
        first = end


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all parts, rising, and the sums of what they come with."""
    if len(parts) == 1:
        return parts[0]
    key, n = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[new], np.add.reduceat(n, new)


def _per_document(lists: list[list[np.ndarray]], n_a: int, n_b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """document_pairs, each row's pairs in one part only."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for part in document_pairs(lists, n_a, n_b):
        if held and part[0][0] // (n_a * n_b) != held[-1][0][-1] // (n_a * n_b):
            yield _summed(held)
            held = []
        held.append(part)
    if held:
        yield _summed(held)


def pair_counts(aligned: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """pair (a * n_b + b), n: how many rows of aligned (packed) link the two ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in _few(batches):
            for key, _ in _per_document([_unpacked(c) for c in batch.columns], n_a, n_b):
                held.append(np.unique(key % (n_a * n_b), return_counts=True))
                rows += len(held[-1][0])
                if rows > HELD:
                    held = [_summed(held)]
                    rows = len(held[0][0])
                    if rows > HELD // 2:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, held.pop())), ["pair", "n"])
                        rows = 0
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, _summed(held))), ["pair", "n"])

    counted = aligned.select(*LISTS).mapInArrow(run, "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def _threshold(counts: DataFrame) -> int:
    """The smallest power of two such that at most HEAD counts are as high."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect()  # 64 rows at most
    threshold, above = 1 << 62, 0
    for r in sorted(sizes, reverse=True):
        above += r["count"]
        if above > HEAD:
            break
        threshold = 1 << r["power"]
    return threshold


def _arrays(df: DataFrame) -> list[np.ndarray]:
    """Columns of a frame of a checked size, ordered by the first."""
    found = df.toArrow()
    order = np.argsort(np.asarray(found.column(0)))
    return [np.asarray(c)[order] for c in found.columns]


class Spelling:
    """Groups as text: `a1,a2|b1;a3|b2`, ids in decimal."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        text = [b"%d%s" % (n, end) for end in (b",", b"|") for n in range(n_a)]
        self.text = np.array(text + [b"%d%s" % (n, end) for end in (b",", b";") for n in range(n_b)], object)

    def __call__(self, a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray) -> bytes:
        """a, b: ids; m, n: how many of them each group has."""
        ends_a, ends_b = np.cumsum(m), np.cumsum(n)
        both = np.empty(len(a) + len(b), np.int64)
        # An A token stands after the B tokens of the groups before its own, a B token after its group's A tokens.
        at_a = np.arange(len(a)) + np.repeat(ends_b - n, m)
        at_b = np.arange(len(b)) + np.repeat(ends_a, n)
        both[at_a], both[at_b] = a, b + 2 * self.n_a
        both[at_a[ends_a - 1]] += self.n_a
        both[at_b[ends_b - 1]] += self.n_b
        return b"".join(self.text[both].tolist())[:-1]


def report(aligned: DataFrame, counts: DataFrame, n_a: int, n_b: int) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of aligned's rows (packed), which have a unique column row.

    n_best: links whose count is the highest that their A id has anywhere, ties included;
    count_sum: the sum of the links' counts; groups_sha256: of the groups' Spelling, empty without tokens.
    """
    threshold = _threshold(counts)
    head = _arrays(counts.where(F.col("n") >= threshold).select("pair", "n"))
    # One row for each id of A at most: the vocabulary bounds it.
    tops = _arrays(counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n").alias("n")))
    best = np.zeros(n_a, np.int64)
    best[tops[0]] = tops[1]
    sent = aligned.sparkSession.sparkContext.broadcast((head[0], head[1], best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, ns, best = sent.value
        spelled = Spelling(n_a, n_b)
        pairs, ns = np.append(pairs, -1), np.append(ns, 0)  # a place for pairs beyond the last one
        for batch in _few(batches):
            total, tops, links = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            rest: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 4]
            lists = [_unpacked(batch.column(c)) for c in LISTS]
            for key, often in _per_document(lists, n_a, n_b):
                row, pair = np.divmod(key, n_a * n_b)
                most = best[pair // n_b]
                at = np.searchsorted(pairs[:-1], pair)
                known = pairs[at] == pair
                n = np.where(known, ns[at], 0)
                np.add.at(total, row, often * n)
                np.add.at(tops, row, often * (known & (n == most)))
                np.add.at(links, row, often)
                rest.append(tuple(c[~known] for c in (row, pair, often, most)))
            of, *fields = (np.concatenate(c) for c in zip(*rest))
            edges = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(list(map(pa.array, fields)), ["pair", "often", "best"]))
            digests = [hashlib.sha256(spelled(*ids)).hexdigest() if len(ids[0]) else "" for ids in zip(*lists)]
            sizes = [pa.array([len(x) for x in column], pa.int64()) for column in lists[:3]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id")), *sizes, *map(pa.array, (links, tops, total)), pa.array(digests, pa.string()), rare],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare"])

    found = staged(aligned.mapInArrow(
        run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
             "rare array<struct<pair: long, often: long, best: long>>"), "alignment-report")
    rare = found.select("row", F.inline("rare")).join(counts.where(F.col("n") < threshold), "pair")
    added = rare.groupBy("row").agg(F.sum(F.col("often") * F.col("n")).alias("more"),
                                    F.sum(F.when(F.col("n") == F.col("best"), F.col("often")).otherwise(0)).alias("tops"))
    return found.join(added, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("tops", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")


def linked(docs: DataFrame, tokenizers: Tokenizers, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The report of docs' alignment; see align for odd rows.

    The alignment is written once to the shared folder; counting and reporting read it."""
    n_a, n_b = tokenizers.sizes()
    aligned = align(docs, tokenizers, key, text, packed=True).withColumn("row", F.monotonically_increasing_id())
    aligned = staged(aligned, "alignment", compression="zstd")
    return report(aligned, staged(pair_counts(aligned, n_a, n_b), "pair-counts"), n_a, n_b)
