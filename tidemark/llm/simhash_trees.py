"""SimHash near-duplicates by sharded BK-trees.

A document's fingerprint has a bit for every position that is set in over half of its
shingles' hashes. Fingerprints go to shards such that close ones meet in at least one; each
shard is a BK-tree, children keyed by their Hamming distance to the parent, and a search
follows only edges within the radius of the distance to the node. What a shard finds are
links; documents linked directly or through others form a component. Where a similarity is
asked for, links are candidates only: each is checked on the texts' shingles before it counts.
Fingerprints lose a few similar pairs, of short texts above all; so texts that are not joined up
by then also meet by their rarest shingles, of which similar ones share one: no pair is lost.

Shards are by key, so trees and queries meet in a shuffle and nothing is broadcast. Only
distinct fingerprints enter trees: thousands of exact copies are one node. The trees of a
task are built and searched together, level by level, as numpy arrays. A shard gives each
node at most one link (to the smallest of its part), never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, staged
from tidemark.llm.components import components

ship(__name__)

#: Rows of a shard table that one task takes on average.
SLICE_ROWS = 100_000
#: Bits that shards are searched on first, and the radius for longer fingerprints: similar ones
#: differ in 20 of these bits or so, give or take 4, strangers in 64, give or take 6.
COARSE, COARSE_RADIUS = 128, 36
#: Query-node pairs a search holds at a time.
FRONTIER = 2_000_000
#: Links of a row that are given at a time where all are asked for.
AT_ONCE = 32
#: A text's shingles are counted by their hash modulo so many, one byte a count: what two texts
#: share is at most the sum of the smaller counts. Pairs are compared so many at a time.
BUCKETS, COMPARED = 1024, 20_000
#: Shingles of all texts are counted by their hash modulo so many, to tell rare ones.
RARITIES = 1 << 20
#: Counts of those that are summed up as one row.
RARITIES_AT_ONCE = 4096
#: Rows of texts by rare shingles that one task takes on average.
LIST_ROWS = 250_000
#: Words of a text that are in memory as separate strings at a time.
WORDS_AT_ONCE = 200_000


@dataclass(frozen=True)
class Scheme:
    """words: words per shingle. bits: fingerprint length, a multiple of 64. radius: linked if so near.

    blocks: cut the fingerprint into so many blocks and shard by every choice of
    blocks - radius of them: two fingerprints within the radius agree on one choice, so no
    link is lost. Or bands: shard by each run of so many bits; near fingerprints then miss
    each other with a probability that falls with their number. distinct: repeated shingles
    of a text count once.
    """

    words: int
    bits: int
    radius: int
    blocks: int = 0
    bands: int = 0
    distinct: bool = False


#: Three words, links within 3 bits of 64: exact.
CLOSE = Scheme(words=3, bits=64, radius=3, blocks=5)
#: Five words, candidates for a similarity of 0.8 or more: such fingerprints differ in 15 % of the
#: bits or fewer (the angle of cosine 2 * 0.8 / 1.8), 155 give or take 11.5; the radius is three
#: deviations more. A band of 16 bits agrees then with probability 0.07, one of 64 bands with 0.99.
SIMILAR = Scheme(words=5, bits=1024, radius=190, bands=16, distinct=True)
#: Shared shingles of all shingles of two texts, at least: 4 of 5.
SHARED, OF = 4, 5


def _hashes(text: bytes, n: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles, in order, in pieces."""
    parts = text.lower().split()  # of bytes: A to Z and ASCII white space only
    if 0 < len(parts) < n:
        parts, n = [b" ".join(parts)], 1
    for at in range(0, max(len(parts) - n + 1, 0), WORDS_AT_ONCE):
        some = parts[at : at + WORDS_AT_ONCE + n - 1]
        shingles = map(b" ".join, zip(*[some[k:] for k in range(n)]))
        yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, len(some) - n + 1)


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """The distinct hashes of the shingles, sorted."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *_hashes(text or b"", n)]))


def bucket_counts(shingles: np.ndarray) -> bytes:
    """BUCKETS bytes; a count of 255 stands for any number from there."""
    places = (shingles % np.uint64(BUCKETS)).astype(np.int64)
    return np.minimum(np.bincount(places, minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def may_be_similar(counts: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows a and b can share as much as is asked: never False for a pair that does.

    counts: bucket_counts as rows; n: shingles of each. A row with a count of 255 is not bounded.
    """
    open_ = counts.max(axis=1, initial=0) == 255
    out = np.empty(len(a), bool)
    for at in range(0, len(a), COMPARED):
        p, q = a[at : at + COMPARED], b[at : at + COMPARED]
        most = np.minimum(np.minimum(counts[p], counts[q]).sum(axis=1, dtype=np.int64), np.minimum(n[p], n[q]))
        most = np.where(open_[p] | open_[q], np.minimum(n[p], n[q]), most)
        out[at : at + COMPARED] = OF * most >= SHARED * (n[p] + n[q] - most)
    return out


def _widened(h: np.ndarray, width: int) -> np.ndarray:
    """The hashes, and width - 1 more from each by a fixed mixing function, side by side."""
    if width == 1:
        return h[:, None]
    z = h[:, None] + np.arange(width, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    z[:, 0] = h
    return z


def fingerprint(text: bytes | None, scheme: Scheme) -> bytes:
    """bits / 8 bytes, little-endian; a text without words has zeros."""
    width = scheme.bits // 64
    counts, total = np.zeros(scheme.bits, np.int64), 0
    for h in [shingle_set(text, scheme.words)] if scheme.distinct else _hashes(text or b"", scheme.words):
        total += len(h)
        for at in range(0, len(h), 255):  # so many ones fit a byte
            wide = _widened(h[at : at + 255], width)
            ones = np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little")
            counts += np.add.reduce(ones, axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > total, bitorder="little").tobytes()


def fingerprints(docs: DataFrame, scheme: Scheme, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, hash (of the text, 64 bits), print (binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, scheme) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.binary())], ["doc_id", "hash", "print"])

    wanted = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).cast("binary").alias("text"))
    return wanted.mapInArrow(run, "doc_id long, hash long, print binary")


def _keys(x: np.ndarray, scheme: Scheme) -> np.ndarray:
    """A column of shard keys per table; x: fingerprints as rows of 64-bit words."""
    if scheme.bands:
        per_word = 64 // scheme.bands
        shifts = np.arange(per_word, dtype=np.uint64) * np.uint64(scheme.bands)
        cut = (x[:, :, None] >> shifts) & np.uint64((1 << scheme.bands) - 1)
        return cut.reshape(len(x), -1)
    edges = np.linspace(0, 64, scheme.blocks + 1).round().astype(int)
    masks = [((1 << int(b)) - (1 << int(a))) for a, b in zip(edges, edges[1:])]
    chosen = combinations(masks, scheme.blocks - scheme.radius)
    return np.stack([x[:, 0] & np.uint64(sum(c)) for c in chosen], axis=1)


def _distance(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x[a] ^ x[b]).sum(axis=1, dtype=np.int64)


def _roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The smallest node that each node is linked to, by hooking and pointer jumping."""
    root = np.arange(n) if root is None else root
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if (low == high).all():
            return root
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _span(a: np.ndarray, b: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and b of links that join up what all of them do: no two make a ring. And the new roots."""
    left, used = np.arange(len(a)), [np.empty(0, np.int64)]
    while True:
        ra, rb = root[a[left]], root[b[left]]
        left, high = left[ra != rb], np.maximum(ra, rb)[ra != rb]
        if not len(left):
            return np.concatenate(used), root
        used.append(left[np.unique(high, return_index=True)[1]])
        root = _roots(len(root), a[used[-1]], b[used[-1]], root)


def forest_links(shard: np.ndarray, x: np.ndarray, radius: int) -> np.ndarray:
    """For each row the smallest row of its shard that it is linked to, directly or through others."""
    return forest_pairs(shard, x, radius, np.arange(len(shard)))[1]


def forest_pairs(shard: np.ndarray, x: np.ndarray, radius: int, root: np.ndarray,
                 counts: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows a, b (two columns) that join up every part, and for each row its part's smallest.

    root: what each row is known to be in one part with (the smallest row of it); no pairs are
    given for that. counts: says of near rows a, b which count as links (both ways alike).
    every: all links between such parts, AT_ONCE of a row at a time, and root as it was.
    Rows are sorted by shard. One BK-tree per shard: all rows walk down from their shard's
    first row together; the first to reach a (node, distance) becomes that child. Then every
    row searches its tree, skipping subtrees that are wholly in its own part already.
    """
    pairs = [np.empty((0, 2), np.int64)]

    def join(some: list[tuple[np.ndarray, np.ndarray]], root: np.ndarray) -> np.ndarray:
        a, b = (np.concatenate(c) for c in zip(*some))
        if counts is not None:
            apart = root[a] != root[b]
            a, b = a[apart], b[apart]
            links = counts(a, b)
            a, b = a[links], b[links]
        if every:
            apart = np.unique(np.stack([a, b], axis=1)[root[a] != root[b]], axis=0)
            nth = np.arange(len(apart)) - np.searchsorted(apart[:, 0], apart[:, 0])
            pairs.append(apart[nth < AT_ONCE])
            return root
        used, root = _span(a, b, root)
        pairs.append(np.stack([a[used], b[used]], axis=1))
        return root

    n, far = len(shard), 64 * x.shape[1] + 1
    first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    top = np.repeat(first, np.diff(np.r_[first, n]))
    rest = np.flatnonzero(top != np.arange(n))
    node = top[rest]
    parents, edges, children, near = [], [], [], [(np.empty(0, np.int64),) * 2]
    while len(rest):
        d = _distance(x, rest, node)
        near.append((rest[d <= radius], node[d <= radius]))
        found, at, which = np.unique(node * far + d, return_index=True, return_inverse=True)
        children.append(rest[at])
        parents.append(found // far)
        edges.append(found)
        stays = np.ones(len(rest), bool)
        stays[at] = False
        node = rest[at][which][stays]
        rest = rest[stays]
    root = join(near, root)
    if not children:
        return np.concatenate(pairs), root

    low, high = root.copy(), root.copy()  # of each subtree; children come after their parents
    for child, parent in zip(reversed(children), reversed(parents)):
        np.minimum.at(low, parent, low[child])
        np.maximum.at(high, parent, high[child])
    key, child = np.concatenate(edges), np.concatenate(children)
    order = np.argsort(key)
    key, child = key[order], child[order]

    sizes = np.diff(np.r_[first, n])
    cost = np.cumsum(np.repeat(sizes, sizes))
    blocks = np.searchsorted(cost, np.arange(FRONTIER, cost[-1] + FRONTIER, FRONTIER), "right") + 1
    begin = 0
    for end in np.unique(np.minimum(blocks, n)):
        q = np.arange(begin, end)
        begin, at = end, top[q]
        links = []
        while len(q):
            mine = root[q]
            open_ = ~((low[at] == mine) & (high[at] == mine))
            q, at = q[open_], at[open_]
            d = _distance(x, q, at)
            hit = (d <= radius) & (root[q] != root[at])
            links.append((q[hit], at[hit]))
            lo = np.searchsorted(key, at * far + np.maximum(d - radius, 0))
            hi = np.searchsorted(key, at * far + np.minimum(d + radius, far - 1), "right")
            many = hi - lo
            at = child[np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())] if len(q) else at
            q = np.repeat(q, many)
        if links:
            root = join(links, root)
    return np.concatenate(pairs), root


def _slices(n_rows: int) -> int:
    return max(1, n_rows // SLICE_ROWS)


def _forest(rows: pd.DataFrame, radius: int, width: int) -> tuple[pd.DataFrame, np.ndarray]:
    """The rows by shard, and forest_links of their prints."""
    rows = rows.sort_values(["shard", "id"]).drop_duplicates(["shard", "id"])
    x = np.frombuffer(b"".join(rows["print"]), np.uint64).reshape(-1, width)
    return rows, forest_links(rows["shard"].to_numpy(), x, radius)


def meetings(prints: DataFrame, scheme: Scheme) -> DataFrame:
    """shard, a, b: rows of prints (id long, print binary) that a shard's search puts together; b is the part's smallest.

    Shards are searched on a fingerprint's first COARSE bits, all of a short one. Of a long
    one, what the coarse search puts together (with a wider radius, so that it hardly loses
    a link) is searched again on all bits: a shard's chance meetings, most of its rows, are
    gone before whole fingerprints move.
    """
    width, coarse = scheme.bits // 64, min(scheme.bits, COARSE) // 64
    radius = scheme.radius if width == coarse else COARSE_RADIUS
    n_tables = _keys(np.zeros((1, width), np.uint64), scheme).shape[1]
    n_slices = _slices(prints.count() * n_tables)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(-1, width)
            keys = _keys(x, scheme)
            tables = np.tile(np.arange(keys.shape[1], dtype=np.uint64), len(x))
            shard = _widened(keys.ravel() ^ (tables << np.uint64(56)), 2)[:, 1]
            first = np.ascontiguousarray(np.repeat(x[:, :coarse], keys.shape[1], axis=0))
            yield pa.RecordBatch.from_arrays([
                pa.array((shard % np.uint64(n_slices)).astype(np.int64)), pa.array(shard.view(np.int64)),
                pa.array(np.repeat(ids, keys.shape[1])),
                pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * coarse), len(first), [None, pa.py_buffer(first)]).cast(pa.binary()),
            ], ["slice", "shard", "id", "print"])

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows, root = _forest(rows, radius, coarse)
        together = np.bincount(root, minlength=len(root))[root] > 1
        ids = rows["id"].to_numpy()
        return pd.DataFrame({"shard": rows["shard"].to_numpy()[together], "a": ids[together], "b": ids[root[together]]})

    rows = prints.mapInArrow(spread, "slice long, shard long, id long, print binary")
    return staged(rows.groupBy("slice").applyInPandas(meet, "shard long, a long, b long"), "shards")


def links(prints: DataFrame, scheme: Scheme) -> DataFrame:
    """a, b: rows of prints (id long, print binary) that are linked, enough to join up every component."""
    met, width = meetings(prints, scheme), scheme.bits // 64
    if scheme.bits <= COARSE:
        return met.select("a", "b").distinct()

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows, root = _forest(rows, scheme.radius, width)
        ids, linked = rows["id"].to_numpy(), root != np.arange(len(root))
        return pd.DataFrame({"a": ids[linked], "b": ids[root[linked]]}).drop_duplicates()

    part = met.select(F.xxhash64("shard", "b").alias("shard"), F.col("a").alias("id")).join(prints, "id")
    sliced = part.withColumn("slice", F.pmod("shard", F.lit(_slices(met.count()))))
    return sliced.groupBy("slice").applyInPandas(search, "a long, b long").distinct()


def _sets(texts: DataFrame, wanted: DataFrame, scheme: Scheme) -> DataFrame:
    """id, shingles (sorted hashes), counts (bucket_counts) of each of wanted (id); texts: id, text (binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, scheme.words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(map(bucket_counts, sets), pa.binary()),
            ], ["id", "shingles", "counts"])

    once = texts.join(wanted, "id", "left_semi").dropDuplicates(["id"]).select("id", "text")
    return staged(once.mapInArrow(run, "id long, shingles binary, counts binary"), "shingles")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, similar: whether the shingles of sets (id, shingles: sorted hashes) are as similar as asked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (one, two))
                both = len(np.intersect1d(x, y, assume_unique=True))
                similar.append(OF * both >= SHARED * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(similar, pa.bool_())], ["a", "b", "similar"])

    first, second = (sets.select(F.col("id").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
    return pairs.join(first, "a").join(second, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long, similar boolean")


def similar_components(prints: DataFrame, texts: DataFrame, scheme: Scheme) -> tuple[DataFrame, DataFrame]:
    """node, root of every row of prints (id, print) that is similar to another as proposed by
    fingerprints, and a, b, similar of the pairs checked; texts: id, text (binary).

    Trees hold each fingerprint once, by the smallest of its ids, to which its other ids are
    linked. Shards propose links enough to join up their parts; each is checked on its texts'
    shingles. What the proposed links join up, checked or not, is a part of near texts, and a
    link that failed can hide another of its part only if its ends are still apart. Such a part
    is searched again as a whole, each text once however many shards it was in, without the
    failed links, until none is left. Those searches see the texts' bucket counts, so near
    texts that cannot be similar are no links: few fail from then on, and links that join up
    the parts are enough. Should some fail nevertheless, all links between what is still apart
    are taken, AT_ONCE of a row at a time.
    """
    width = scheme.bits // 64
    nodes = staged(prints.groupBy("print").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "prints")
    met = meetings(nodes.select("id", "print"), scheme)
    n_slices = _slices(met.count())

    def near(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["shard", "id"]).drop_duplicates(["shard", "id"])
        x, ids = np.frombuffer(b"".join(rows["print"]), np.uint64).reshape(-1, width), rows["id"].to_numpy()
        pairs, _ = forest_pairs(rows["shard"].to_numpy(), x, scheme.radius, np.arange(len(rows)))
        ends = np.sort(ids[pairs], axis=1)
        return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]}).drop_duplicates()

    sharded = met.select(F.xxhash64("shard", "b").alias("shard"), F.col("a").alias("id")).join(nodes.select("id", "print"), "id")
    found = sharded.withColumn("slice", F.pmod("shard", F.lit(n_slices))).groupBy("slice").applyInPandas(near, "a long, b long")
    same = prints.join(nodes.where("n > 1").select("print", F.col("id").alias("a")), "print")
    same = same.where("id <> a").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b"))
    found = staged(found.unionByName(same).distinct(), "candidates")

    sets = _sets(texts, found.select(F.explode(F.array("a", "b")).alias("id")).distinct(), scheme)

    def search(rows: pd.DataFrame, every: bool) -> pd.DataFrame:
        rows = rows.sort_values(["part", "id"], ignore_index=True)
        x = np.frombuffer(b"".join(rows["print"]), np.uint64).reshape(-1, width)
        rows["at"] = np.arange(len(rows))
        root = rows.groupby(["part", "root"])["at"].transform("min").to_numpy().copy()
        failed = rows.loc[rows["tried"].notna(), ["part", "at", "tried"]].explode("tried").astype("int64")
        failed = failed.merge(rows[["part", "id", "at"]], left_on=["part", "tried"], right_on=["part", "id"])
        p, q = failed["at_x"].to_numpy(), failed["at_y"].to_numpy()
        tried = np.r_[p * len(rows) + q, q * len(rows) + p]
        bounds = np.frombuffer(b"".join(rows["counts"]), np.uint8).reshape(-1, BUCKETS)

        def can_be(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            new = ~np.isin(a * len(rows) + b, tried)
            new[new] = may_be_similar(bounds, rows["n"].to_numpy(), a[new], b[new])
            return new

        pairs, _ = forest_pairs(rows["part"].to_numpy(), x, scheme.radius, root, can_be, every)
        ends = np.sort(rows["id"].to_numpy()[pairs], axis=1)
        return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]}).drop_duplicates()

    def proposed(rows: DataFrame, every: bool) -> DataFrame:
        return staged(rows.groupBy("slice").applyInPandas(lambda r: search(r, every), "a long, b long"), "candidates")

    def apart(judged: DataFrame, roots: DataFrame) -> DataFrame:
        """id: an end of each link that failed and whose ends are not joined up otherwise."""
        of_a, of_b = (roots.select(F.col("node").alias(c), F.col("root").alias(f"of_{c}")) for c in "ab")
        ends = judged.where("NOT similar").join(of_a, "a", "left").join(of_b, "b", "left")
        return ends.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select(F.col("a").alias("id"))

    checked = judged = staged(_similar(found, sets.select("id", "shingles")), "judged")
    roots = staged(components(checked.where("similar").select("a", "b")), "components")
    open_ = staged(apart(judged, roots), "apart")
    if open_.isEmpty():
        return roots, checked
    parts = staged(components(found).select(F.col("node").alias("id"), F.col("root").alias("part")), "parts")
    bounds = sets.select("id", "counts", (F.octet_length("shingles") / 8).cast("long").alias("n"))
    every = False
    while True:
        again = parts.join(open_, "id", "left_semi").select("part").distinct()
        now = parts.join(again, "part", "left_semi").join(prints, "id").join(bounds, "id")
        tried = checked.where("NOT similar").groupBy(F.col("a").alias("id")).agg(F.collect_list("b").alias("tried"))
        now = now.join(roots.withColumnRenamed("node", "id"), "id", "left").join(tried, "id", "left")
        now = now.withColumn("root", F.coalesce("root", "id")).withColumn("slice", F.pmod("part", F.lit(4 * n_slices)))  # larger rows
        found = proposed(now, every)
        if found.isEmpty():
            return roots, checked
        judged = staged(_similar(found, sets.select("id", "shingles")), "judged")
        checked = checked.unionByName(judged)
        roots = staged(components(checked.where("similar").select("a", "b")), "components")
        open_ = found.select(F.col("a").alias("id")) if every else apart(judged, roots)
        every = True


def rarities(texts: DataFrame, scheme: Scheme) -> tuple[np.ndarray, int]:
    """For each shingle hash modulo RARITIES how often such shingles are in texts, in steps of an eighth of a doubling; and all."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(RARITIES, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                np.add.at(counts, (shingle_set(t, scheme.words) % np.uint64(RARITIES)).astype(np.int64), 1)
        parts = [c.tobytes() for c in counts.reshape(-1, RARITIES_AT_ONCE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(RARITIES_AT_ONCE, np.int64)
        for counts in rows["counts"]:
            total += np.frombuffer(counts, np.int64)
        steps = (8 * np.log2(1 + total)).clip(0, 255).astype(np.uint8).tobytes()
        return pd.DataFrame({"part": rows["part"].iloc[:1], "n": [int(total.sum())], "steps": [steps]})

    counts = texts.select("text").mapInArrow(count, "part long, counts binary")
    sums = sorted(counts.groupBy("part").applyInPandas(add, "part long, n long, steps binary").collect())
    return np.frombuffer(b"".join(bytes(steps) for _, _, steps in sums), np.uint8), sum(n for _, n, _ in sums)


def rarest(shingles: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """So many of the rarest that two similar texts have one of theirs in common; steps: rarities of all."""
    order = np.lexsort((shingles, steps[(shingles % np.uint64(RARITIES)).astype(np.int64)]))
    return shingles[order[: len(shingles) + -SHARED * len(shingles) // OF + 1]]


def _rows_of_rarest(n: np.ndarray, rarest: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document (its place), shingle and left (see may_meet) of each of the documents' rarest; n: shingles of each."""
    many = np.fromiter(map(len, rarest), np.int64, len(n)) // 8
    doc = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(doc)) - (np.cumsum(many) - many)[doc]
    return doc, np.frombuffer(b"".join(rarest), np.uint64), n[doc] - nth


def may_meet(shingle: np.ndarray, doc: np.ndarray, left: np.ndarray, n: np.ndarray, root: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Documents a, b of different roots with a shingle in common that can be similar by sizes; each pair once.

    shingle, doc, left: rows of rarest; of the document's shingles so many are left from this one
    on. n, root: shingles and root of each document, by n. What similar ones share is left from
    their first common shingle on. Pairs are held FRONTIER at a time.
    """
    order = np.lexsort((doc, shingle))
    shingle, doc, left = shingle[order], doc[order], left[order]
    first = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
    sizes, roots = np.diff(np.r_[first, len(shingle)]), root[doc]
    mixed = np.repeat(np.minimum.reduceat(roots, first) != np.maximum.reduceat(roots, first), sizes)
    nth, doc, left = np.repeat(np.arange(len(first)), sizes)[mixed], doc[mixed], left[mixed]
    if not len(doc):
        return
    size, wide = n[doc], int(n.max()) + 1
    largest = np.minimum(OF * size // SHARED, (SHARED + OF) * left // SHARED - size).clip(0, wide - 1)
    many = np.searchsorted(nth * wide + size, nth * wide + largest, "right") - np.arange(1, len(doc) + 1)
    many = np.maximum(many, 0)
    rows = np.argsort(doc, kind="stable")
    starts = np.flatnonzero(np.r_[True, doc[rows][1:] != doc[rows][:-1]])
    block = np.cumsum(np.add.reduceat(many[rows], starts)) // FRONTIER
    cuts = starts[np.flatnonzero(np.r_[True, block[1:] != block[:-1]])]
    for begin, end in zip(cuts, np.r_[cuts[1:], len(rows)]):
        some = rows[begin:end]
        a = np.repeat(some, many[some])
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
        fits = (root[doc[a]] != root[doc[b]]) & ((SHARED + OF) * left[b] >= SHARED * (size[a] + size[b]))
        pairs = np.unique(doc[a[fits]] * len(n) + doc[b[fits]])
        yield pairs // len(n), pairs % len(n)


def missed(roots: DataFrame, checked: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """a, b: the similar texts that roots (node, root; of texts joined up) leave apart; texts: id, text (binary).
    checked: a, b of pairs whose similarity is known.

    Texts meet by each of their rarest shingles, in any fixed order of all shingles, so the
    counts that give it need not be exact. Those that can be similar by sizes are linked to the
    smallest of a task, not paired; what that joins up is a part, and its texts are paired
    inside one task, which gives the pairs that bucket counts admit.
    """
    steps, n_rows = rarities(texts, scheme)
    n_rows -= SHARED * n_rows // OF

    def rare(batches: Iterator[pa.RecordBatch], counted: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, scheme.words) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([rarest(s, steps).tobytes() for s in sets], pa.binary())]
            if counted:
                columns.append(pa.array(map(bucket_counts, sets), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "rarest", "counts"][: len(columns)])

    def placed(docs: DataFrame) -> DataFrame:
        return docs.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, of, n = (batch.column(c).to_numpy() for c in range(3))
            doc, shingle, left = _rows_of_rarest(n, batch.column(3).to_pylist())
            columns = [shingle.view(np.int64), own[doc], of[doc], n[doc] << 32 | left]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shingle", "id", "root", "sizes"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if held:
            shingle, own, of, sizes = (np.concatenate(c) for c in zip(*held))
            ids, at, which = np.unique(own, return_index=True, return_inverse=True)
            by_n = np.argsort(sizes[at] >> 32, kind="stable")
            ids, at, place = ids[by_n], at[by_n], np.argsort(by_n)
            part = np.arange(len(ids))
            for a, b in may_meet(shingle, place[which], sizes & 0xFFFFFFFF, sizes[at] >> 32, of[at]):
                part = _roots(len(ids), a, b, part)
            linked = part != np.arange(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[part[linked]])], ["a", "b"])

    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "id"], ignore_index=True)
        n, ids, pairs = rows["n"].to_numpy(), rows["id"].to_numpy(), [np.empty((0, 2), np.int64)]
        doc, shingle, left = _rows_of_rarest(n, rows["rarest"])
        bounds = np.frombuffer(b"".join(rows["counts"]), np.uint8).reshape(-1, BUCKETS)
        for a, b in may_meet(shingle, doc, left, n, rows["root"].to_numpy()):
            admitted = may_be_similar(bounds, n, a, b)
            pairs.append(ids[np.stack([a[admitted], b[admitted]], axis=1)])
        ends = np.sort(np.concatenate(pairs), axis=1)
        return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]})

    rares = texts.mapInArrow(lambda b: rare(b, False), "id long, n long, rarest binary")
    rares = placed(rares.groupBy("id").agg(F.first("n").alias("n"), F.first("rarest").alias("rarest"))).select("id", "root", "n", "rarest")
    rows = rares.mapInArrow(each, "shingle long, id long, root long, sizes long").repartition(max(1, n_rows // LIST_ROWS), "shingle")
    parts = components(rows.mapInArrow(meet, "a long, b long")).select(F.col("node").alias("id"), F.col("root").alias("part"))
    parts = staged(parts, "lists")
    once = texts.join(parts, "id", "left_semi").dropDuplicates(["id"]).select("id", "text")
    near = placed(once.mapInArrow(lambda b: rare(b, True), "id long, n long, rarest binary, counts binary")).join(parts, "id")
    near = near.withColumn("slice", F.pmod("part", F.lit(_slices(n_rows))))
    found = staged(near.groupBy("slice").applyInPandas(pair, "a long, b long").join(checked, ["a", "b"], "left_anti"), "candidates")
    sets = _sets(texts, found.select(F.explode(F.array("a", "b")).alias("id")).distinct(), scheme)
    return staged(_similar(found, sets.select("id", "shingles")).where("similar").select("a", "b"), "judged")


def near_duplicates(docs: DataFrame, scheme: Scheme = CLOSE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, print, component_id (smallest doc_id reachable, itself included) of every row.

    Documents without words share the zero fingerprint and are linked like any others.
    Null keys are linked but never a component's id unless it has no other. Repeated rows
    stay; an empty table gives no rows.
    """
    prints = staged(fingerprints(docs, scheme, key, text).select("doc_id", "print"), "prints")
    distinct = prints.groupBy("print").agg(F.min("doc_id").alias("first"))
    distinct = staged(distinct.withColumn("id", F.xxhash64("print", "first")), "prints")
    pairs = links(distinct.select("id", "print"), scheme)
    roots = components(pairs).withColumnRenamed("node", "id")
    placed = distinct.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = placed.join(named, "root").select("print", "component_id")
    return prints.join(by_print, "print")


def one_of_each(docs: DataFrame, scheme: Scheme = SIMILAR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs' rows, with their columns, that stand for their component: one row of each, of the
    smallest key, nulls last. Rows are told apart by key and text, so keys need not be unique.

    Documents are linked if their shingles are similar as asked; those without words are alike."""
    prints = fingerprints(docs, scheme, key, text).groupBy("hash").agg(F.min("doc_id").alias("first"), F.first("print").alias("print"))
    prints = staged(prints.withColumnRenamed("hash", "id"), "prints")
    texts = docs.select(F.xxhash64(text).alias("id"), F.col(text).cast("binary").alias("text"))
    roots, checked = similar_components(prints.select("id", "print"), texts, scheme)
    apart = missed(roots, checked, texts, scheme)
    if not apart.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(apart))
    placed = prints.select("id", "first").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    stays = placed.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("odd"), "first", "id")).alias("stays"))
    stays = stays.select(F.col("stays.first").alias("_stays"), F.col("stays.id").alias("_text"))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("_key"), F.xxhash64(text).alias("_hash"))
    kept = rows.join(stays, F.col("_key").eqNullSafe(F.col("_stays")) & (F.col("_hash") == F.col("_text")), "left_semi")
    return kept.dropDuplicates(["_key", "_hash"]).select("row.*")
