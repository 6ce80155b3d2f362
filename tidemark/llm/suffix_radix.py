"""Repeated windows by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first DEPTH bytes, by most-significant-digit
passes: each pass groups the suffixes that are still alike by their next digit and lets
those go that are alone; the groups left after the last pass are exactly the repeated
windows. All but the first window of a group are repeats; bytes that repeats cover go.

Any order of digits gives the same groups. The first digit is the window's anchor, the
GRAM bytes with the smallest hash in it: neighbouring windows share their anchor, so the
first pass, the only one over all suffixes, moves one row per run of about 35 of them, with
no text. Its lone runs, most of all text, are gone before any text moves. The runs left
are fetched with their bytes and sorted through the other digits, four bytes each, in
tasks that hold many groups. Anchors met HOT times or more (a passage that much of the
corpus holds) are instead grouped by Spark on a 128-bit hash of the whole window, so no
task gathers such a group. Hashes of anchors only bring windows together; windows of a
task are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, staged

ship(__name__)

DEPTH = 100
#: Bytes of the first digit.
GRAM = 24
#: Runs with one anchor from which on Spark groups their windows.
HOT = 20_000
#: Runs that a task sorts on average.
SLICE_RUNS = 40_000
#: Bytes of text that are looked at together; bounds memory, not texts.
CHUNK = 1 << 21
#: Stands for a null id: before all others.
NULL_ID = -(1 << 63)

_LOW24 = np.uint64(0xFFFFFF)
RUNS = "d long, tie long, at long, windows int, offset int, anchor long, hot boolean, bytes binary"


def _grams(buffer: bytes) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at each place."""
    n = len(buffer) - GRAM + 1
    eight = np.ndarray((len(buffer) - 7,), "<u8", buffer=buffer, strides=(1,))
    h = np.zeros(n, np.uint64)
    for at, factor in ((0, 0x9E3779B97F4A7C15), (8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9)):
        h += eight[at : at + n] * np.uint64(factor)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _anchors(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and per window the place of its anchor: the smallest hash (upper 40 bits), first of equals."""
    h = _grams(buffer)
    windows, wide = len(buffer) - DEPTH + 1, DEPTH - GRAM + 1
    low, size = (h & ~_LOW24) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * size <= wide:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    low = np.minimum(low[:windows], low[wide - size : wide - size + windows])
    return h, (low & _LOW24).astype(np.int64)


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of about CHUNK bytes: bytes, and per piece in it the text's number, the place in the
    text and the end in the buffer. Pieces of one text overlap, so each window is in one of them."""
    some: list[tuple[bytes, int, int]] = []
    size = 0
    for n, text in enumerate(texts):
        for at in range(0, max(len(text) - DEPTH + 1, 0), CHUNK):
            piece = text[at : at + CHUNK + DEPTH - 1]
            some.append((piece, n, at))
            size += len(piece)
            if size >= CHUNK:
                yield _joined(some)
                some, size = [], 0
    if some:
        yield _joined(some)


def _joined(some: list[tuple[bytes, int, int]]):
    return (b"".join(p for p, _, _ in some), np.array([n for _, n, _ in some]), np.array([at for _, _, at in some]),
            np.cumsum([len(p) for p, _, _ in some]))


def runs_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor: text number, first window, windows, bytes before the anchor, gram hash."""
    for buffer, number, place, ends in _pieces(texts):
        h, anchor = _anchors(buffer)
        window = np.arange(len(anchor))
        piece = np.searchsorted(ends, window, "right")
        inside = window + DEPTH <= ends[piece]
        window, anchor, piece = window[inside], anchor[inside], piece[inside]
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])])
        sizes = np.diff(np.r_[first, len(window)])
        starts, piece, anchor = window[first], piece[first], anchor[first]
        begin = ends[piece] - np.diff(np.r_[0, ends])[piece]
        yield number[piece], starts - begin + place[piece], sizes, anchor - starts, h[anchor].view(np.int64)


def _pack(first: np.ndarray, windows: np.ndarray, offset: np.ndarray, hot) -> np.ndarray:
    return (first << 16) | (windows << 9) | (offset << 2) | hot


def anchor_rows(docs: DataFrame) -> DataFrame:
    """row, anchor, run (first window, windows and offset in one number) of every run of docs (row, t)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for number, first, windows, offset, h in runs_of([t or b"" for t in batch.column(1).to_pylist()]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[number]), pa.array(h), pa.array(_pack(first, windows, offset, 0))], ["row", "anchor", "run"])

    return docs.select("row", "t").mapInArrow(run, "row long, anchor long, run long")


def fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted runs (row, runs: array of packed numbers) with their bytes, from docs (row, d, tie, t).

    Equal runs of one batch are sent once, for the earliest place; the others are repeats as
    they stand and come without bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first_at: dict[tuple, tuple] = {}
            rows = []
            for d, tie, text, packed in zip(*[c.to_pylist() for c in batch.columns]):
                text = text or b""
                places = np.array(packed, np.int64)
                for p, windows, offset, hot in zip(*(x.tolist() for x in (places >> 16, places >> 9 & 127, places >> 2 & 127, places & 1))):
                    content = text[p : p + windows + DEPTH - 1]
                    if len(content) < windows + DEPTH - 1:
                        continue  # of another row with this hash
                    gram = xxhash.xxh3_64_intdigest(content[offset : offset + GRAM]) - (1 << 63)
                    key, here = (content, offset), (d, tie, p)
                    there = first_at.get(key)
                    if there is None or here < there[:3]:
                        first_at[key] = (*here, windows, offset, gram, bool(hot))
                    if there is not None and there[:3] != here:
                        rows.append((*max(here, there[:3]), windows, offset, gram, bool(hot), None))
            rows += [(*x, content) for (content, _), x in first_at.items()]
            for at in range(0, len(rows), 10_000):
                types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 10_000]), types)],
                                                 ["d", "tie", "at", "windows", "offset", "anchor", "hot", "bytes"])

    found = docs.join(wanted, "row").select("d", "tie", "t", "runs")
    return found.mapInArrow(run, RUNS)


def repeats(anchor: np.ndarray, offset: np.ndarray, windows: np.ndarray, content: list[bytes], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that stand earlier, too: number of the run, window in it.

    order: a number per run that grows with its place, such that order + j is the place of
    its window j. Radix passes: groups of (anchor, place in it), then four bytes a pass; who
    is alone goes.
    """
    sizes = np.fromiter(map(len, content), np.int64, len(content))
    data = b"".join(content) + bytes(4)
    four = np.ndarray((len(data) - 3,), "<u4", buffer=data, strides=(1,))
    run = np.repeat(np.arange(len(content)), windows)
    j = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = np.repeat(np.cumsum(sizes) - sizes, windows) + j
    key = np.unique(anchor, return_inverse=True)[1][run] * 128 + offset[run] - j
    for depth in range(0, DEPTH + 4, 4):
        by = np.argsort(key)
        ordered = key[by]
        group = np.empty(len(by), np.int64)
        group[by] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
        stays = np.bincount(group)[group] > 1
        run, j, at, group = run[stays], j[stays], at[stays], group[stays]
        if depth == DEPTH or not len(run):
            break
        key = (group << 32) | four[at + depth]
    place = order[run] + j
    by = np.lexsort((place, group))
    run, j, group, place = run[by], j[by], group[by], place[by]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])[: len(group)]
    earliest = np.repeat(place[first], np.diff(np.r_[first, len(group)]))
    return run[place != earliest], j[place != earliest]


def _sorted_spans(rows: pd.DataFrame) -> pd.DataFrame:
    """Spans of the slice's windows that stand earlier.

    Equal runs are one for the sort: the earliest stands for them, the others are repeats
    as they stand. Anchors whose runs are all equal need no sort.
    """
    rows = rows.drop_duplicates(["d", "tie", "at", "offset"]).sort_values(["d", "tie", "at", "offset"]).reset_index(drop=True)
    text = rows.groupby(["d", "tie"], sort=True).ngroup().to_numpy(np.int64)
    later = rows.duplicated(["anchor", "offset", "bytes"]).to_numpy()
    same = rows[later]
    whole = pd.DataFrame({"d": same["d"], "tie": same["tie"], "start": same["at"], "end": same["at"] + same["windows"] + DEPTH - 1})
    many = rows[~later].groupby("anchor")["at"].transform("size") > 1
    text, rows = text[~later][many], rows[~later][many]
    at = rows["at"].to_numpy()
    run, j = repeats(rows["anchor"].to_numpy(), rows["offset"].to_numpy(np.int64), rows["windows"].to_numpy(np.int64),
                     rows["bytes"].tolist(), (text << 40) + at)
    key = np.unique(run * 128 + j)
    begins = np.flatnonzero(np.r_[True, np.diff(key) != 1])[: len(key)]
    ends = np.r_[begins[1:], len(key)] - 1 if len(key) else begins
    run, j, last = key[begins] // 128, key[begins] % 128, key[ends] % 128
    part = pd.DataFrame({"d": rows["d"].to_numpy()[run], "tie": rows["tie"].to_numpy()[run],
                         "start": at[run] + j, "end": at[run] + last + DEPTH})
    return pd.concat([whole, part], ignore_index=True)


def _hot_spans(runs: DataFrame) -> DataFrame:
    """Spans of windows that stand earlier, by Spark's grouping on a hash of each window."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, tie, at, sizes, content = (batch.column(n) for n in (0, 1, 2, 3, 7))
            sizes = sizes.to_numpy().astype(np.int64)
            h = b"".join(xxhash.xxh3_128_digest(b[k : k + DEPTH]) for b, n in zip(content.to_pylist(), sizes.tolist()) for k in range(n))
            pairs = np.frombuffer(h, np.int64).reshape(-1, 2)
            j = np.arange(len(pairs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns = [np.repeat(c.to_numpy(), sizes) for c in (d, tie, at)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (pairs[:, 0], pairs[:, 1], columns[0], columns[1], columns[2] + j)], ["h1", "h2", "d", "tie", "start"])

    every = runs.mapInArrow(windows, "h1 long, h2 long, d long, tie long, start long")
    firsts = every.groupBy("h1", "h2").agg(F.min(F.struct("d", "tie", "start")).alias("first"))
    later = every.join(firsts, ["h1", "h2"]).where(F.struct("d", "tie", "start") != F.col("first"))
    return later.select("d", "tie", "start", (F.col("start") + DEPTH).alias("end"))


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """d, tie, start, end: byte spans of docs (d, tie, t) covered by windows that also start earlier;
    spans of one text may overlap or repeat."""
    docs = docs.withColumn("row", F.xxhash64("d", "tie"))  # rows of one id and different texts stand apart
    anchors = anchor_rows(docs)
    # Written, so that the join below has two plain sides and a common anchor can be split.
    counts = staged(anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "radix-anchors")
    again = anchors.join(counts, "anchor").select("row", F.col("run").bitwiseOR(F.when(F.col("n") >= hot, 1).otherwise(0)).alias("run"))
    wanted = staged(again.groupBy("row").agg(F.collect_set("run").alias("runs")), "radix-runs")
    total = wanted.agg(F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()[0]
    runs = staged(fetch(docs, wanted), "radix-runs", compression="zstd")

    plain = runs.where("bytes IS NULL").select("d", "tie", F.col("at").alias("start"), (F.col("at") + F.col("windows") + DEPTH - 1).alias("end"))
    sent = runs.where("bytes IS NOT NULL")
    n_slices = max(1, total // SLICE_RUNS)
    in_tasks = sent.where("NOT hot").withColumn("slice", F.pmod("anchor", F.lit(n_slices)))
    sorted_ = in_tasks.groupBy("slice").applyInPandas(lambda rows: _sorted_spans(rows), "d long, tie long, start long, end long")
    return plain.unionByName(sorted_).unionByName(_hot_spans(sent.where("hot")))


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal spans: overlapping and touching ones are one."""
    out: list[list[int]] = []
    for start, end in sorted(zip(starts, ends)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, binary) of every row.

    A byte goes if a DEPTH-byte window covers it that also starts earlier: in a row with a
    smaller id, or before in the same text. Rows with equal ids stand by a hash of their
    text; rows with equal id and text are one and get the same result each. Null texts are
    empty; null ids come first. The rest of a text may end in the middle of a character.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("t"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("d"), F.xxhash64("t").alias("tie"), "t")
    spans = staged(repeated_spans(rows.select("d", "tie", "t")), "radix-spans")
    by_doc = spans.groupBy("d", "tie").agg(F.collect_set(F.struct("start", "end")).alias("spans")).select(
        F.col("d").alias("s_d"), F.col("tie").alias("s_tie"), "spans")
    joined = rows.join(by_doc, (F.col("d") == F.col("s_d")) & (F.col("tie") == F.col("s_tie")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, t, spans in zip(*[c.to_pylist() for c in batch.columns]):
                gone = merged([s["start"] for s in spans or []], [s["end"] for s in spans or []])
                edges = [0, *[e for s in gone for e in s], len(t)]
                kept = b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((doc, len(t), len(t) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out), types)],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    found = joined.select("doc_id", "t", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return found if keep_text else found.drop("kept")
