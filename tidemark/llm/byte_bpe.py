"""Byte-level BPE of whole texts by overlapping chunks.

A text is cut into chunks of CHUNK characters, each with OVERLAP characters of the next one.
Chunks are pre-tokenised wherever they lie, from their first character on, which may stand
within a pre-token. Where a chunk and the one before it have a pre-token end in common, they
agree on all that follows: that place is their seam, and a piece goes from seam to seam.
Chunks without a common end (a pre-token longer than the overlap) are joined and scanned
again, until all seams are found. Pieces are encoded pre-token by pre-token; a text's ids are
its pieces' ids in order. Texts of one chunk are encoded where they are read; only longer
ones move. Decoding puts the bytes of the ids one after the other.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, staged

ship(__name__)

#: Characters of a chunk, and of the next one that it also sees.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: A match that ends so many characters before its window's end, or more, would end there in
#: the whole text too: what a pattern looks at beyond the run that it takes.
MARGIN = 16
#: Pre-tokens whose ids a task remembers, and the longest of them.
MEMO, MEMO_CHARS = 1_000_000, 64

CHUNK_SCHEMA = "id string, doc_id long, copies long, at long, size long, last boolean, text string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Ids of pre-tokens by the ranks; the library merges each pre-token's bytes."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        self.split = regex.compile(pattern).findall
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    def _new(self, token: str) -> bytes:
        ids = array("i", self.encode(token)).tobytes()
        if len(token) <= MEMO_CHARS:
            if len(self.known) >= MEMO:
                self.known.clear()
            self.known[token] = ids
        return ids

    def ids(self, tokens: list[str]) -> bytes:
        """The ids of pre-tokens, as 32-bit integers."""
        get = self.known.get
        return b"".join([get(t) or self._new(t) for t in tokens])


def _lists(raw: list[bytes]) -> pa.Array:
    """An array of lists of 32-bit integers from their bytes."""
    offsets = np.cumsum([0, *[len(r) // 4 for r in raw]])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(raw), np.int32)))


def _whole(texts: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids of texts (doc_id, text) of one chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            raw = [encoder.ids(encoder.split(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(raw)], ["doc_id", "ids"])

    return texts.mapInArrow(run, "doc_id long, ids array<int>")


def cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The chunks of texts (id, doc_id, copies, text): at and size of each, and the text of its window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *row, text in zip(*(c.to_pylist() for c in batch.columns)):
                for at in range(0, len(text), chunk):
                    size = min(chunk, len(text) - at)
                    values = (*row, at, size, at + size == len(text), text[at : at + chunk + overlap])
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    names, types = zip(*[("id", pa.string()), ("doc_id", pa.int64()), ("copies", pa.int64()), ("at", pa.int64()),
                         ("size", pa.int64()), ("last", pa.bool_()), ("text", pa.string())])
    names = list(names)
    return texts.mapInArrow(run, CHUNK_SCHEMA)


def scan(chunks: DataFrame, pattern: str) -> DataFrame:
    """Chunks with the ends of their pre-tokens, counted in the window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split = regex.compile(pattern).findall
        for batch in batches:
            ends = [np.cumsum([len(t) for t in split(text)], dtype=np.int32).tobytes() for text in batch.column(6).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(ends)], [*batch.schema.names, "ends"])

    return chunks.mapInArrow(run, f"{CHUNK_SCHEMA}, ends array<int>")


def seams(scanned: DataFrame, overlap: int) -> DataFrame:
    """id, at, begin and end of each chunk's piece, counted in its window; end is null where no seam is found.

    The seam of two chunks is the first end that both have, and that the first one's window can
    be trusted with: not the last ones, unless the text ends there. Only the ends in overlaps move."""
    narrow = scanned.selectExpr(
        "id", "at", "size", "last", f"transform(filter(ends, e -> e <= {overlap}), e -> at + e) AS head",
        f"transform(filter(ends, e -> e > size AND (e <= char_length(text) - {MARGIN} OR char_length(text) < size + {overlap})), e -> at + e) AS tail")
    row = Window.partitionBy("id").orderBy("at")
    met = F.array_min(F.array_intersect("tail", F.lead("head").over(row)))
    found = narrow.select("id", "at", F.when(F.col("last"), F.col("size")).otherwise(met - F.col("at")).alias("end"))
    begin = F.coalesce(F.lag(F.col("at") + F.col("end")).over(row) - F.col("at"), F.lit(0))
    return found.select("id", "at", begin.alias("begin"), "end")


def _joined(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """The chunks of texts with a missing seam: those without one are joined with the next."""
    row = Window.partitionBy("id").orderBy("at")
    follows = F.coalesce(F.lag(F.col("end").isNotNull()).over(row), F.lit(True))
    runs = found.withColumn("run", F.sum(follows.cast("long")).over(row)).select("id", "at", "run")
    parts = chunks.join(runs, ["id", "at"]).groupBy("id", "doc_id", "copies", "run").agg(
        F.sort_array(F.collect_list(F.struct("at", "size", "last", "text"))).alias("parts"))
    own = "array_join(transform(slice(parts, 1, size(parts) - 1), p -> substring(p.text, 1, int(p.size))), '')"
    return parts.selectExpr(
        "id", "doc_id", "copies", "parts[0].at AS at", "aggregate(parts, 0L, (n, p) -> n + p.size) AS size",
        "element_at(parts, -1).last AS last", f"concat({own}, element_at(parts, -1).text) AS text")


def pieces(chunks: DataFrame, pattern: str, overlap: int) -> DataFrame:
    """Scanned chunks with begin and end of their pieces, which put together are their texts."""
    done = None
    while True:
        now = staged(scan(chunks.repartition("id", "at"), pattern), "bpe-chunks")
        found = staged(seams(now, overlap), "bpe-seams")
        lacking = found.where("end IS NULL").select("id").distinct()
        whole = now.join(found, ["id", "at"]).join(lacking, "id", "left_anti")
        done = whole if done is None else done.unionByName(whole)
        if lacking.isEmpty():
            return done
        chunks = _joined(now.drop("ends").join(lacking, "id", "left_semi"), found.join(lacking, "id", "left_semi"))


def _of_pieces(chunks: DataFrame, path: str, pattern: str) -> DataFrame:
    """id, doc_id, copies, at, ids of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            raw = []
            for text, ends, begin, end in zip(*(c.to_pylist() for c in batch.columns[4:])):
                edges = [begin, *[e for e in ends if begin < e <= end]]
                raw.append(encoder.ids([text[a:b] for a, b in zip(edges, edges[1:])]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], _lists(raw)], ["id", "doc_id", "copies", "at", "ids"])

    wanted = chunks.select("id", "doc_id", "copies", "at", "text", "ends", "begin", "end")
    return wanted.mapInArrow(run, "id string, doc_id long, copies long, at long, ids array<int>")


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids (array<int>) of every row of docs; ranks: path of the ranks' file.

    Special tokens are ordinary text. Null and empty texts have no ids, null keys stay,
    repeated rows give a row each, other columns are ignored; an empty table gives no rows.
    Equal long texts of one key are encoded once. The pattern must not look behind a match,
    nor further than MARGIN past one that ends before its window does.
    """
    if not MARGIN < overlap <= chunk:
        raise ValueError("the overlap is over MARGIN and at most a chunk")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short, long = (rows.where(f"char_length(text) {sign} {chunk}") for sign in ("<=", ">"))
    name = F.sha2(F.concat_ws(" ", F.lit("of"), "doc_id", F.sha2("text", 256)), 256)
    texts = long.groupBy(name.alias("id")).agg(
        F.first("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("text").alias("text"))
    found = _of_pieces(pieces(cut(texts, chunk, overlap), pattern, overlap), ranks, pattern)
    whole = found.groupBy("id", "doc_id", "copies").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("pieces"))
    of_long = whole.selectExpr("doc_id", "flatten(pieces.ids) AS ids", "explode(sequence(1L, copies)) AS copy").drop("copy")
    return _whole(short, ranks, pattern).unionByName(of_long)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids and bytes, what the ids stand for; an id without a rank is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: token for token, rank in read_ranks(ranks).items()}
        for batch in batches:
            offsets = np.asarray(batch.column(1).offsets).tolist()
            parts = list(map(token.__getitem__, np.asarray(batch.column(1).values).tolist()[: offsets[-1]]))
            found = [b"".join(parts[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], ["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, bytes binary")
