"""Benchmark decontamination by a BM25 index of test items with block-max bounds.

Test items are indexed word by word. A word's impact on an item is its BM25 weight there as
a share of the item's own total, so a passage that holds the whole item scores 1. Items
stand in blocks; per word and block the index keeps the largest impact. Every training
passage (windows that overlap by half, so any item lies whole in one) is a query: bounds
per block are summed for all passages of a batch at once, and only blocks whose bound
reaches the threshold are scored item by item. Words too light to matter are counted in
every bound instead of looked up. Items above the threshold are verified: enough of the
question's and of the answer's word shingles must stand in the text around the passage.

No pair above the threshold is lost: bounds are never below scores. The index of one shard
of items holds SHARD_WORDS words at most and is what is broadcast; more items are more
shards, each a pass over the documents. Weights, mean length and passage size are those of
all items, counted once, so results do not depend on shards.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, staged

ship(__name__)

K1, B = 1.2, 0.75
#: Share of an item's own BM25 total that a passage must reach.
THRESHOLD = 0.6
#: Share of the item's shingles that must be there: of all, and of question and answer alone.
OVERLAP, PART_OVERLAP = 0.8, 0.5
SHINGLE = 5
#: Items per block of the index, more where its table of bounds would exceed BOUNDS_MB; words
#: of a shard of items.
BLOCK = 4
BOUNDS_MB = 32
SHARD_WORDS = 200_000
#: Sum of bounds that light words may reach together before they are looked up.
LIGHT = 0.2
#: Different spellings whose word is remembered.
MEMO = 1_000_000
#: Words that are looked at together: of several documents, or a piece of a long one.
PIECE = 100_000


def normal(word: str) -> str:
    """Letters and digits of a word, in lower case."""
    return word.lower() if word.isalnum() else "".join(filter(str.isalnum, word)).lower()


def item_words(text: str | None) -> list[str]:
    return [w for w in map(normal, (text or "").split()) if w]


def parts(text: str | None) -> tuple[list[str], list[str]]:
    """Question and answer: the answer is the last sentence, or the last half of a single one."""
    ends = [n for n, c in enumerate(text or "") if c in ".?!\n"]
    all_words = item_words(text)
    for end in reversed(ends):
        answer = item_words(text[end + 1 :])
        if answer:
            return all_words[: len(all_words) - len(answer)], answer
    half = len(all_words) // 2
    return all_words[:half], all_words[half:]


def shingles(words: list[str], n: int = SHINGLE) -> set[tuple]:
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(n)]))


@dataclass
class Totals:
    """Of all items with words: their number, mean and largest number of words; items per word, for a shard's words."""

    items: int
    mean: float
    longest: int
    seen: dict[str, int]


def totals_of(items: list[tuple[int, str]]) -> Totals:
    lists = [words for words in (item_words(t) for _, t in items) if words]
    return Totals(len(lists), sum(map(len, lists)) / max(len(lists), 1), max(map(len, lists), default=1),
                  Counter(w for words in lists for w in set(words)))


@dataclass
class Index:
    """Of a shard of items (id, text). Items without words are left out: nothing can hold them.
    totals: of all items, where there are more shards."""

    items: list[tuple[int, str]]
    totals: Totals | None = None
    ids: list[int] = field(default_factory=list)

    def __post_init__(self):
        self.items = [(i, t) for i, t in self.items if item_words(t)]
        self.ids = [i for i, _ in self.items]
        lists = [item_words(t) for _, t in self.items]
        self.term = {w: n for n, w in enumerate(sorted({w for words in lists for w in words}))}
        totals = self.totals or totals_of(self.items)
        self.longest = totals.longest
        self.postings: list[list[tuple[int, float]]] = [[] for _ in self.term]
        for n, words in enumerate(lists):
            weight = {}
            for w, tf in Counter(words).items():
                idf = math.log(1 + (totals.items - totals.seen[w] + 0.5) / (totals.seen[w] + 0.5))
                weight[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / totals.mean))
            own = sum(weight.values())
            for w, x in weight.items():
                self.postings[self.term[w]].append((n, x / own))
        self.block = max(BLOCK, math.ceil(len(lists) * len(self.term) * 4 / (BOUNDS_MB << 20)))
        blocks = max(1, math.ceil(len(lists) / self.block))
        self.bound = np.zeros((len(self.term), blocks), np.float32)
        for t, posted in enumerate(self.postings):
            for n, x in posted:
                self.bound[t, n // self.block] = max(self.bound[t, n // self.block], x)
        self.light, self.base = np.zeros(len(self.term) + 1, bool), np.zeros(blocks, np.float32)
        for t in np.argsort(self.bound.max(axis=1), kind="stable"):
            if (self.base + self.bound[t]).max() > LIGHT:
                break
            self.base += self.bound[t]
            self.light[t] = True
        self.questions = [tuple(map(shingles, parts(t))) for _, t in self.items]
        self.whole = [shingles(words) for words in lists]


class Spellings(dict):
    """Written word: its term, -1 for a word of no item, -2 for no word. Forgets all when full."""

    def __init__(self, term: dict[str, int]):
        self.term = term

    def __missing__(self, written: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        word = normal(written)
        self[written] = n = self.term.get(word, -1) if word else -2
        return n


def _candidates(index: Index, pieces: list[np.ndarray]) -> list[tuple[int, int, int, float]]:
    """(piece, first word of the passage, item, score) above the threshold; pieces: terms in order."""
    step = index.longest
    # Slots of step words; a passage is a slot and the next. An empty slot stands after each piece.
    n_slots = np.array([max(1, math.ceil(len(p) / step)) + 1 for p in pieces])
    first_slot = np.cumsum(n_slots) - n_slots
    terms = np.concatenate(pieces)
    sizes = np.array([len(p) for p in pieces])
    place = np.arange(len(terms)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    slot = np.repeat(first_slot, sizes) + place // step
    heavy = (terms >= 0) & ~index.light[terms]
    distinct = np.unique(slot[heavy] * len(index.term) + terms[heavy])
    if not len(distinct):
        return []
    slot, term = np.divmod(distinct, len(index.term))
    begins = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    bound = np.zeros((n_slots.sum() + 1, index.bound.shape[1]), np.float32)
    bound[slot[begins]] = np.add.reduceat(index.bound[term], begins, axis=0)
    found = []
    for at, block in zip(*np.nonzero(bound[:-1] + bound[1:] + index.base >= THRESHOLD - 1e-4)):
        piece = int(np.searchsorted(first_slot, at, "right")) - 1
        first = int(at - first_slot[piece]) * step
        here = pieces[piece][first : first + 2 * step]
        score: dict[int, float] = {}
        for t in set(here[here >= 0].tolist()):
            for n, x in index.postings[t]:
                if n // index.block == block:
                    score[n] = score.get(n, 0.0) + x
        found += [(piece, first, n, s) for n, s in score.items() if s >= THRESHOLD - 1e-9]
    return found


def _share(of: set, there: set) -> float:
    return len(of & there) / len(of) if of else 1.0


def _pieces(index: Index, texts: list[str | None]) -> Iterator[list[tuple[int, list[str]]]]:
    """Number of the text and its words, several texts or a piece of one together. Pieces of
    one text overlap by two passages."""
    some, size = [], 0
    for n, text in enumerate(texts):
        written = (text or "").split()
        for at in range(0, len(written), PIECE):
            some.append((n, written[at : at + PIECE + 2 * index.longest]))
            size += len(some[-1][1])
            if size >= PIECE:
                yield some
                some, size = [], 0
    if some:
        yield some


def leaks_of(index: Index, memo: Spellings, texts: list[str | None]) -> list[tuple[int, int, float, float, float]]:
    """(number of the text, item id, score, question overlap, answer overlap) of every item that a text holds."""
    best: dict[tuple[int, int], tuple] = {}
    for some in _pieces(index, texts):
        sizes = np.array([len(words) for _, words in some])
        every = np.fromiter(map(memo.__getitem__, chain.from_iterable(words for _, words in some)), np.int64, sizes.sum())
        terms = np.split(every, np.cumsum(sizes)[:-1])
        kept = [np.flatnonzero(t != -2) for t in terms]
        for piece, first, n, score in _candidates(index, [t[k] for t, k in zip(terms, kept)]):
            text, written = some[piece]
            near = kept[piece][max(first - index.longest, 0) : first + 3 * index.longest]
            around = [normal(written[k]) for k in near]
            there = shingles(around)
            question, answer = (_share(p, there | _runs(p, around)) for p in index.questions[n])
            if _share(index.whole[n], there | _runs(index.whole[n], around)) >= OVERLAP and min(question, answer) >= PART_OVERLAP:
                best[text, n] = max(best.get((text, n), (0.0,)), (score, question, answer))
    return [(text, index.ids[n], *found) for (text, n), found in sorted(best.items())]


def _runs(wanted: set[tuple], words: list[str]) -> set[tuple]:
    """The wanted sequence, if it is shorter than a shingle and stands among the words."""
    short = next(iter(wanted), ())
    return shingles(words, len(short)) & wanted if 0 < len(short) < SHINGLE and len(words) >= len(short) else set()


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row per document and item it holds.

    Rows of docs are looked at one by one: repeated rows give repeated leaks; null and empty
    texts, and items without words, give none.
    """
    return _held(docs, items, key, text, item_key, item_text).drop("hash")


def _held(docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """leaks, and the hash of the text that holds the item."""
    spark = docs.sparkSession
    wanted = items.select(F.col(item_key).cast("long").alias("id"), F.col(item_text).alias("text"))
    total = wanted.select(F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0))).first()[0]
    n_shards = max(1, math.ceil(total / SHARD_WORDS))
    shard_of = F.pmod(F.xxhash64("id", "text"), F.lit(n_shards))
    schema = "doc_id long, hash long, item_id long, score double, question_overlap double, answer_overlap double"
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))

    def one_pass(shard: list[tuple[int, str]], totals: Totals) -> DataFrame:
        known = spark.sparkContext.broadcast((shard, totals))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(*known.value)
            memo = Spellings(index.term)
            for batch in batches:
                ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                rows = [(ids[n], hashes[n], *leak) for n, *leak in leaks_of(index, memo, batch.column(2).to_pylist())]
                if rows:
                    types = [pa.int64(), pa.int64(), pa.int64(), *[pa.float64()] * 3]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                     ["doc_id", "hash", "item_id", "score", "question_overlap", "answer_overlap"])

        return texts.mapInArrow(run, schema)

    n_items, mean, longest, seen = _counted(wanted.withColumn("shard", shard_of))
    found = None
    for n in range(n_shards):
        shard = [tuple(r) for r in wanted.where(shard_of == n).sort("id", "text").collect()]
        totals = Totals(n_items, mean, longest, dict(seen.where(F.col("shard") == n).select("word", "n").collect()))
        one = one_pass(shard, totals)
        found = one if found is None else found.unionByName(one)
    return found


def _counted(items: DataFrame) -> tuple[int, float, int, DataFrame]:
    """Items with words, their mean and largest number of words; shard, word, n: items of all shards that
    hold a shard's word. items: text, shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [item_words(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, lists), pa.int64()), pa.array([sorted(set(w)) for w in lists], pa.list_(pa.string()))],
                ["shard", "size", "words"])

    listed = items.select("shard", "text").mapInArrow(run, "shard long, size long, words array<string>").where("size > 0")
    listed = staged(listed, "items")
    n, total, longest = listed.agg(F.count("*"), F.sum("size"), F.max("size")).first()
    words = listed.select("shard", F.explode("words").alias("word")).groupBy("shard", "word").agg(F.count("*").alias("n"))
    everywhere = words.groupBy("word").agg(F.sum("n").alias("n"))
    seen = staged(words.select("shard", "word").join(everywhere, "word"), "items")
    return n, (total or 0) / max(n, 1), longest or 1, seen


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", by_row: bool = False) -> DataFrame:
    """The rows of docs, with their columns, that hold no item. By row: rows are told apart by key
    and text, so only those that hold an item go; otherwise every row of such a row's key goes."""
    held = _held(docs, items, key, text).select(F.col("doc_id").alias("_held"), F.col("hash").alias("_text")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("_key"), F.xxhash64(text).alias("_hash"))
    same_key = F.col("_key").eqNullSafe(F.col("_held"))
    return rows.join(held, same_key & (F.col("_hash") == F.col("_text")) if by_row else same_key, "left_anti").select("row.*")
