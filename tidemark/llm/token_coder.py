"""Token ids in files: an adaptive context-mixing range coder over independent blocks.

A block lists its distinct ids; each id is then coded as its rank there, digit by digit
(base 16, highest first). For each digit three adaptive
predictions are mixed by adding their counts, longer contexts counting more: order 0 (the
digits so far), order 1 (also the id before), order 2 (also the two ids before). The mixed
counts drive a range coder. Every block of BLOCK_IDS ids starts anew and carries its own
checksum, so blocks are read one by one, in any order, and a damaged one is noticed.

Blocks of a task are coded side by side: one numpy step codes one digit of every block.

Files: Parquet rows of blocks, in partitions that follow each other in document order, each
block with the documents that begin in it. Spark writes and commits them, so they live in
any store and a lost executor costs retries only. A block's bytes: MAGIC, number of ids,
digits per id, number of distinct ids, CRC-32 of the ids as little-endian unsigned 32-bit
integers; the distinct ids; then the code as little-endian unsigned 16-bit words.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship, write_once

ship(__name__)

MAGIC = b"TMX1"
HEADER = "<4sIBII"
HEADER_SIZE = struct.calcsize(HEADER)
BLOCK_IDS = 8_192
#: Blocks coded side by side; bounds a task's memory at about 0.35 MB each.
LANES = 768
#: What a seen digit adds to its counts of order 0, 1 and 2; every digit starts with 1.
GAIN = (1, 4, 12)
#: Hashed contexts of order 1 and of order 2, per block.
CONTEXTS = 1 << 10
#: Text bytes that a partition of the files holds on average.
PARTITION_BYTES = 32 << 20
#: Chunks of text whose ids are remembered.
MEMO = 400_000
ENCODED_AT_ONCE = 2_000

_LOW, _FULL = np.uint64((1 << 48) - 1), np.uint64(1 << 32)
_1, _4, _15, _16, _32, _48 = map(np.uint64, (1, 4, 15, 16, 32, 48))
_K1, _K2, _K3, _K4, _K5 = map(np.uint64, (0x9E3779B1, 0xC2B2AE35, 0x85EBCA6B, 0x27D4EB2F, 0x9E3779B97F4A7C15))
_CONTEXT_SHIFT = np.uint64(64 - CONTEXTS.bit_length() + 1)
BLOCK_SCHEMA = ("part int, block int, first long, n int, doc_ids array<long>, doc_starts array<long>, "
                "doc_sizes array<long>, code binary")


def digits_for(vocabulary: int) -> int:
    return max(1, (max(vocabulary - 1, 1).bit_length() + 3) // 4)


class Mixer:
    """The predictions of many blocks at once; encoder and decoder see the same."""

    _upto = np.triu(np.ones((16, 16), np.float32))

    def __init__(self, lanes: int, digits: int):
        sizes = ((16**digits - 1) // 15, CONTEXTS, CONTEXTS)
        self.lanes = lanes
        # One table for the three orders, a part for each; rows of a lane stand together. It holds how often
        # a digit was seen, in two bytes (a block has fewer digits), as most time goes into fetching its rows.
        self.table = np.zeros((lanes * sum(sizes), 16), np.uint16)
        self.flat = self.table.reshape(-1)
        parts = np.cumsum([0, lanes * sizes[0], lanes * sizes[1]]).astype(np.uint64)
        self.base = parts[:, None] + np.arange(lanes, dtype=np.uint64) * np.array(sizes, np.uint64)[:, None]
        self.gain = np.array(GAIN, np.float32)[:, None, None]
        self.at = np.zeros((3, lanes), np.uint64)
        self.hash = np.zeros((2, lanes), np.uint64)
        self.rows, self.counts = np.zeros((3 * lanes, 16), np.uint16), np.zeros((lanes, 16), np.float32)
        self.parts = np.zeros((3, lanes, 16), np.float32)
        self.sums = np.zeros((lanes, 16), np.float32)
        self.one = self.two = np.zeros(lanes, np.uint64)
        self.begin()

    def begin(self) -> None:
        """Of an id."""
        self.node = np.zeros(self.lanes, np.uint64)
        np.multiply(self.one, _K1, out=self.hash[0])
        np.multiply(self.two, _K2, out=self.hash[1])
        self.hash[1] += self.hash[0] * _K3

    def predict(self) -> None:
        """Counts of the 16 digits, and their running sums."""
        np.add(self.base[0], self.node, out=self.at[0])
        context = self.hash + self.node * _K4
        context *= _K5
        context >>= _CONTEXT_SHIFT
        np.add(self.base[1:], context, out=self.at[1:])
        np.take(self.table, self.at.reshape(-1).view(np.int64), axis=0, out=self.rows, mode="clip")
        np.multiply(self.rows.reshape(self.parts.shape), self.gain, out=self.parts)
        np.add(self.parts[0], self.parts[1], out=self.counts)
        self.counts += self.parts[2]
        self.counts += 1
        np.matmul(self.counts, self._upto, out=self.sums)

    def learn(self, digit: np.ndarray) -> None:
        """digit: uint64."""
        cell = (self.at * _16 + digit).reshape(-1).view(np.int64)
        self.flat[cell] += np.uint16(1)
        self.node = self.node * _16 + digit + _1

    def end(self, ids: np.ndarray) -> None:
        self.two, self.one = self.one, ids.astype(np.uint64)
        self.begin()


def encode_blocks(blocks: list[np.ndarray], digits: int) -> list[bytes]:
    """The code words of each block of ids; shorter blocks are coded as if zeros followed."""
    lanes, length = len(blocks), max(map(len, blocks), default=0)
    ids = np.zeros((length, lanes), np.uint32)
    for n, b in enumerate(blocks):
        ids[: len(b), n] = b
    mixer, row16 = Mixer(lanes, digits), np.arange(lanes, dtype=np.uint64) * _16
    room = length * digits + 5
    out = np.zeros(lanes * room, np.int32)
    # A place before the first word takes the carry that never comes.
    at = np.arange(lanes, dtype=np.int64) * room + 1
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, 1 << 48, np.uint64)
    counts, sums = mixer.counts.reshape(-1), mixer.sums.reshape(-1)
    for now in ids:
        now = now.astype(np.uint64)
        for shift in range(4 * (digits - 1), -1, -4):
            digit = (now >> np.uint64(shift)) & _15
            mixer.predict()
            cell = (row16 + digit).view(np.int64)
            one = counts[cell]
            unit = width // sums[15::16].astype(np.uint64)
            low += unit * (sums[cell] - one).astype(np.uint64)
            width = unit * one.astype(np.uint64)
            out[at - 1] += (low >> _48).astype(np.int32)  # the carry; evened out below
            low &= _LOW
            full = width < _FULL
            out[at] = (low >> _32).astype(np.int32) * full  # stays only where at moves on
            at += full
            move = full * _16
            low = (low << move) & _LOW
            width <<= move
            mixer.learn(digit)
        mixer.end(now)
    for k in (_32, _16, np.uint64(0)):
        out[at] = ((low >> k) & np.uint64(0xFFFF)).view(np.int64)
        at += 1
    ends = at - np.arange(lanes) * room
    out = out.reshape(lanes, room)
    for k in range(ends.max(initial=1) - 1, 0, -1):  # nothing was written beyond
        out[:, k - 1] += out[:, k] >> 16
        out[:, k] &= 0xFFFF
    return [out[n, 1 : ends[n]].astype("<u2").tobytes() for n in range(lanes)]


def decode_blocks(codes: list[bytes], sizes: list[int], digits: int) -> list[np.ndarray]:
    lanes, length = len(codes), max(sizes, default=0)
    room = max((len(c) for c in codes), default=0) // 2 + length * digits + 4
    words = np.zeros((lanes, room), np.uint16)
    for n, c in enumerate(codes):
        words[n, : len(c) // 2] = np.frombuffer(c, "<u2")
    mixer, row16 = Mixer(lanes, digits), np.arange(lanes, dtype=np.uint64) * _16
    ids = np.zeros((length, lanes), np.uint32)
    begin = words[:, :3].astype(np.uint64)
    code = (begin[:, 0] << _32) | (begin[:, 1] << _16) | begin[:, 2]
    words = words.reshape(-1)
    width, at = np.full(lanes, 1 << 48, np.uint64), np.arange(lanes, dtype=np.int64) * room + 3
    counts, sums = mixer.counts.reshape(-1), mixer.sums.reshape(-1)
    for place in range(length):
        now = np.zeros(lanes, np.uint64)
        for _ in range(digits):
            mixer.predict()
            total = sums[15::16].astype(np.uint64)
            unit = width // total
            value = np.minimum(code // unit, total - _1).astype(np.float32)
            below = (mixer.sums <= value[:, None]).view(np.uint64)  # a byte of 0 or 1 per digit
            digit = np.bitwise_count(below[:, 0]).astype(np.uint64) + np.bitwise_count(below[:, 1])
            cell = (row16 + digit).view(np.int64)
            one = counts[cell]
            code -= unit * (sums[cell] - one).astype(np.uint64)
            width = unit * one.astype(np.uint64)
            full = width < _FULL
            move = full * _16
            code = (code << move) | (words[at] * full).astype(np.uint64)
            at += full
            width <<= move
            now <<= _4
            now |= digit
            mixer.learn(digit)
        ids[place] = now
        mixer.end(now)
    return [ids[:size, n].copy() for n, size in enumerate(sizes)]


def pack(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block's ids are coded by their rank among the block's distinct ids, which go before the code
    as differences in LEB128; fewer ids need fewer digits."""
    found = [np.unique(b, return_inverse=True) for b in blocks]
    digits = max((digits_for(len(ids)) for ids, _ in found), default=1)
    codes = encode_blocks([ranks for _, ranks in found], digits)
    out = []
    for block, (ids, _), code in zip(blocks, found, codes):
        listed = _leb128(np.diff(ids.astype(np.int64), prepend=0))
        out.append(struct.pack(HEADER, MAGIC, len(block), digits, len(ids), zlib.crc32(block.astype("<u4").tobytes())) + listed + code)
    return out


def unpack(packed: list[bytes]) -> list[np.ndarray]:
    """The ids of packed blocks; ValueError for bytes that are no block or damaged."""
    heads = [struct.unpack_from(HEADER, p) if len(p) >= HEADER_SIZE else (b"", 0, 0, 0, 0) for p in packed]
    if any(h[0] != MAGIC for h in heads):
        raise ValueError("not a block of token ids")
    lists = [_from_leb128(p, HEADER_SIZE, h[3]) for p, h in zip(packed, heads)]
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(packed)
    for digits in {h[2] for h in heads}:
        alike = [n for n, h in enumerate(heads) if h[2] == digits]
        ranks = decode_blocks([packed[n][lists[n][1] :] for n in alike], [heads[n][1] for n in alike], digits)
        for n, r in zip(alike, ranks):
            ids = np.cumsum(lists[n][0]).astype(np.uint32)
            if len(r) and (not len(ids) or r.max() >= len(ids)):
                raise ValueError("a block's code is damaged")
            out[n] = ids[r] if len(r) else out[n]
    if any(zlib.crc32(b.astype("<u4").tobytes()) != h[4] for b, h in zip(out, heads)):
        raise ValueError("a block's checksum differs")
    return out


def _leb128(values: np.ndarray) -> bytes:
    out = bytearray()
    for v in values.tolist():
        while v > 127:
            out.append(v & 127 | 128)
            v >>= 7
        out.append(v)
    return bytes(out)


def _from_leb128(data: bytes, at: int, n: int) -> tuple[list[int], int]:
    """n values, and where what follows begins."""
    values = []
    for _ in range(n):
        value = shift = 0
        while at < len(data):
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                break
        values.append(value)
    return values, at


class Tokens:
    """Ids of texts, remembered for each chunk between blanks.

    Right for tokenizers that never join characters across white space and drop it: a text
    has then the ids of its chunks, one after the other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Each text's ids as unsigned 32-bit integers."""
        chunked = [(t or "").replace("\n", " ").split(" ") for t in texts]
        new = list(set(chain.from_iterable(chunked)) - self.known.keys())
        if len(self.known) + len(new) > MEMO:
            self.known, new = {}, list(set(chain.from_iterable(chunked)))
        for at in range(0, len(new), ENCODED_AT_ONCE):  # what the library returns is large
            some = new[at : at + ENCODED_AT_ONCE]
            self.known.update(zip(some, self._encoded(some)))
        for chunks in chunked:
            yield b"".join(map(self.known.__getitem__, chunks))

    def _encoded(self, chunks: list[str]) -> Iterator[bytes]:
        """Each chunk's ids, from one call over all of them: a token's place tells its chunk."""
        begins = np.cumsum([0, *[len(c) + 1 for c in chunks]])
        found = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        places = np.fromiter(chain.from_iterable(found.offsets), np.int64)[::2]  # of pairs: first, end
        raw, edges = np.array(found.ids, "<u4").tobytes(), (4 * np.searchsorted(places, begins)).tolist()
        return (raw[a:b] for a, b in zip(edges, edges[1:]))


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of all texts to path, in ascending order of key (nulls first, equal keys by
    a hash of the text), each text followed by end_id. Null texts are empty. An empty table
    gives files without blocks."""
    total = docs.select(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(max(1, total // PARTITION_BYTES), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer)
        part, end = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        pending: list[bytes] = []
        starts: list[tuple[int, int, int]] = []  # document, place, ids
        held = done = upto = block = 0

        def cut(n_blocks: int) -> pa.RecordBatch:
            nonlocal pending, held, done, block, starts
            stream = np.frombuffer(b"".join(pending), "<u4")
            blocks = [stream[k * BLOCK_IDS : (k + 1) * BLOCK_IDS] for k in range(n_blocks)]
            used = sum(map(len, blocks))
            pending, held = [stream[used:].tobytes()], held - used
            firsts = [done + k * BLOCK_IDS for k in range(n_blocks)]
            begin = [[] for _ in blocks]
            for d in starts:
                if d[1] < done + used:
                    begin[(d[1] - done) // BLOCK_IDS].append(d)
            starts = [d for d in starts if d[1] >= done + used]
            numbers = list(range(block, block + n_blocks))
            done, block = done + used, block + n_blocks
            columns = [
                pa.array([part] * n_blocks, pa.int32()), pa.array(numbers, pa.int32()), pa.array(firsts, pa.int64()),
                pa.array([len(b) for b in blocks], pa.int32()),
                *[pa.array([[d[c] for d in ds] for ds in begin], pa.list_(pa.int64())) for c in range(3)],
                pa.array(pack(blocks), pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "block", "first", "n", "doc_ids", "doc_starts", "doc_sizes", "code"])

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), tokens.ids(batch.column(1).to_pylist())):
                n = len(ids) // 4 + 1
                starts.append((doc, upto, n))
                upto += n
                pending += [ids, end]
                held += n
                while held >= LANES * BLOCK_IDS:
                    yield cut(LANES)
        if held:
            yield cut(-(-held // BLOCK_IDS))

    write_once(ordered.drop("tie").mapInArrow(run, BLOCK_SCHEMA), path)


def combine_crc32(first: int, second: int, size: int) -> int:
    """CRC-32 of a text of two parts from the parts' CRC-32; size: bytes of the second."""
    def times(matrix: list[int], vector: int) -> int:
        total = 0
        for row in matrix:
            if vector & 1:
                total ^= row
            vector >>= 1
        return total

    step = [0xEDB88320, *[1 << n for n in range(31)]]  # one zero bit more
    size *= 8
    while size:
        if size & 1:
            first = times(step, first)
        step = [times(step, row) for row in step]
        size >>= 1
    return first ^ second


def read(spark: SparkSession, path: str) -> DataFrame:
    """part, first, n, ids (array<int>, unsigned 32-bit read as signed) of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _wide(batches, 3):
            ids = unpack(batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([b.astype(np.int32) for b in ids], pa.list_(pa.int32()))], ["part", "first", "n", "ids"])

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    return blocks.select("part", "first", "n", "code").mapInArrow(run, "part int, first long, n int, ids array<int>")


def _wide(batches: Iterator[pa.RecordBatch], code: int) -> Iterator[pa.RecordBatch]:
    """Batches of LANES blocks: the more are decoded side by side, the fewer steps."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        for at in range(0, batch.num_rows, LANES):
            held.append(batch.slice(at, LANES))
            rows += held[-1].num_rows
            while rows >= LANES:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield whole.slice(0, LANES)
                held, rows = [whole.slice(LANES)], rows - LANES
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of every document in the
    files, by decoding all blocks. A document's pieces in several blocks are checksummed each
    and put together in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _wide(batches, 4):
            rows = []
            firsts = batch.column(1).to_pylist()
            starts = batch.column(3).to_pylist()
            for part, first, begin, ids in zip(batch.column(0).to_pylist(), firsts, starts, unpack(batch.column(4).to_pylist())):
                raw = memoryview(ids.astype("<u4").tobytes())
                edges = [s - first for s in begin] + [len(ids)]
                if edges[0]:  # ends a document that began in a block before
                    rows.append((part, first, False, edges[0], zlib.crc32(raw[: 4 * edges[0]])))
                rows += [(part, first + a, True, b - a, zlib.crc32(raw[4 * a : 4 * b])) for a, b in zip(edges, edges[1:])]
            types = [pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["part", "at", "begins", "n", "crc"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for pieces in batch.column(4).to_pylist():
                crc = 0
                for n, piece in enumerate(pieces):
                    crc = piece["crc"] if n == 0 else combine_crc32(crc, piece["crc"], 4 * piece["n"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crcs, pa.int64())],
                                             ["doc_id", "part", "begin", "n_tokens", "ids_crc32"])

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    pieces = blocks.select("part", "first", "n", "doc_starts", "code").mapInArrow(
        run, "part int, at long, begins boolean, n long, crc long")
    # The files name each document's place and size, so a piece finds its document by a running maximum
    # over the few documents of one block; pieces that continue one are matched by the file's list.
    listed = blocks.select("part", F.explode(F.arrays_zip("doc_ids", "doc_starts", "doc_sizes")).alias("d")).select(
        "part", F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_starts").alias("begin"), F.col("d.doc_sizes").alias("n_tokens"))
    spans = listed.withColumn("at", F.explode(F.concat(F.array("begin"), F.expr(
        f"transform(sequence(begin div {BLOCK_IDS}, (begin + n_tokens - 1) div {BLOCK_IDS}), k -> k * {BLOCK_IDS})"
    )))).where("at >= begin").distinct()
    joined = spans.join(pieces.select("part", "at", "n", "crc"), ["part", "at"])
    grouped = joined.groupBy("part", "begin").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))
    whole = grouped.select("doc_id", "part", "begin", "n_tokens", "pieces").mapInArrow(
        together, "doc_id long, part int, begin long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n").alias("ids")).withColumn("ahead", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return whole.join(parts.select("part", "ahead"), "part").select(
        "doc_id", (F.col("ahead") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")
