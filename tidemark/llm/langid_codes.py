"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One binary classifier per bit learns from byte
trigrams whether a text's language has that bit set; a text is given the language whose
codeword loses least against the classifiers' margins, and is flagged as ambiguous where
the runner-up is close.

Training counts trigrams per language over all training documents: executors add up, the
driver gets one row per language and used feature, FEATURES per language at most. The
model that goes back to executors is FEATURES x bits floats, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

ship(__name__)

#: Hash buckets of trigrams.
FEATURES = 1 << 15
#: Codeword bits for more than CODE_ALL languages; up to that, every way to part them is a bit.
CODE_ALL, CODE_BITS = 5, 63
#: Bytes looked at together; bounds memory, not texts.
CHUNK = 1 << 20
#: A margin of so many nats per trigram counts as certain; scale of the loss.
SCALE = 8.0
#: Flagged if the runner-up has more than so much of the best's score.
AMBIGUOUS = 0.5
UNKNOWN = "und"

#: Letters a to z in either case: 1 to 26; bytes of other characters: 27 to 154; the rest: 0.
_CLASS = bytes(
    b - 64 if 65 <= b <= 90 else b - 96 if 97 <= b <= 122 else 27 + b - 128 if b >= 128 else 0 for b in range(256)
)


def features(classes: np.ndarray) -> np.ndarray:
    """Buckets of the trigrams of byte classes; 0 for a trigram without letters."""
    c = classes.astype(np.uint32)
    whole = (c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]
    return np.where(whole == 0, np.uint32(0), (whole * np.uint32(2654435761)) >> np.uint32(32 - 15))


def _framed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte classes of all texts, each with two blanks before it, and where each begins."""
    joined = b"".join([b"  " + t for t in texts]) + b"  "
    ends = np.cumsum([len(t) + 2 for t in texts])
    return np.frombuffer(joined.translate(_CLASS), np.uint8), np.r_[0, ends[:-1]].astype(np.int64)


def _groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Numbers of consecutive texts of about CHUNK bytes together."""
    some, size = [], 0
    for n, t in enumerate(texts):
        some.append(n)
        size += len(t)
        if size >= CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, 1 or -1
    weights: np.ndarray  # FEATURES x bits

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Mean log odds per trigram of each text and bit."""
        out = np.zeros((len(texts), self.codes.shape[1]))
        for group in _groups(texts):
            classes, starts = _framed([texts[n] for n in group])
            f = features(classes)
            owner = np.searchsorted(starts, np.arange(len(f)), "right") - 1
            total, used = np.zeros((len(group), out.shape[1])), np.bincount(owner, f > 0, len(group))
            for at in range(0, len(f), CHUNK):
                part, mine = self.weights[f[at : at + CHUNK]], owner[at : at + CHUNK]
                begins = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                np.add.at(total, mine[begins], np.add.reduceat(part, begins, axis=0))
            out[group] = total / np.maximum(used, 1)[:, None]
        return out

    def decide(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is ambiguous."""
        margins = self.margins(texts)
        # Logistic loss of each bit against each codeword, weighted by how sure the bits are together.
        loss = np.logaddexp(0, -SCALE * margins[:, None, :] * self.codes[None]).sum(axis=2)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        score = share[np.arange(len(texts)), best]
        second = np.partition(share, -2, axis=1)[:, -2] if share.shape[1] > 1 else np.zeros(len(texts))
        return [self.languages[b] for b in best], score, second > AMBIGUOUS * score


def codewords(n: int) -> np.ndarray:
    """n rows of 1 and -1. Few languages: a column for every way to part them in two.
    More: CODE_BITS columns of the random tables tried whose closest rows are farthest apart."""
    if n <= CODE_ALL:
        parts = [c for k in range(1, n) for c in combinations(range(1, n), k)] or [()]
        return np.array([[-1 if row in c else 1 for c in parts] for row in range(n)])
    best, most = None, -1
    for seed in range(50):
        table = np.random.default_rng(seed).choice([-1, 1], (n, CODE_BITS))
        apart = CODE_BITS - (table @ table.T - 2 * CODE_BITS * np.eye(n)).max()
        if apart > most:
            best, most = table, apart
    return best


def train(labelled: DataFrame) -> Model | None:
    """labelled: text, lang (not null). None if there is nothing to learn from."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                mine = [t or b"" for t, one in zip(texts, langs) if one == lang]
                counts = total.setdefault(lang, np.zeros(FEATURES, np.int64))
                for group in _groups(mine):
                    counts += np.bincount(features(_framed([mine[n] for n in group])[0]), minlength=FEATURES)
        for lang, counts in total.items():
            counts[0] = 1  # so that every language is seen
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], ["lang", "feature", "n"])

    texts = labelled.select("lang", F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    languages = sorted(set(rows["lang"].to_pylist()))
    if not languages:
        return None
    place = {lang: n for n, lang in enumerate(languages)}
    counts = np.zeros((len(languages), FEATURES))
    counts[[place[x] for x in rows["lang"].to_pylist()], rows["feature"].to_numpy()] = rows["n"].to_numpy()
    counts[:, 0] = 0
    p = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)  # of a trigram, given the language
    codes = codewords(len(languages))
    weights = np.zeros((FEATURES, codes.shape[1]), np.float32)
    for bit in range(codes.shape[1]):
        ones = codes[:, bit] == 1
        if ones.any() and not ones.all():
            weights[:, bit] = np.log(p[ones].mean(axis=0)) - np.log(p[~ones].mean(axis=0))
    weights[0] = 0
    return Model(languages, codes, weights)


def has_letter(text: bytes) -> bool:
    classes = np.frombuffer(text.translate(_CLASS), np.uint8)
    plain = bool(((classes > 0) & (classes < 27)).any())
    return plain or any(map(str.isalpha, text.decode("utf-8", "replace")))


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row. Texts that are null or have no letter
    (and all texts, without a model) are UNKNOWN with score 0."""
    known = docs.sparkSession.sparkContext.broadcast(model and (model.languages, model.codes, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*known.value) if known.value else None
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            lettered = [m is not None and has_letter(t) for t in texts]
            langs, scores, doubts = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            asked = [n for n, yes in enumerate(lettered) if yes]
            if asked:
                for n, lang, score, doubt in zip(asked, *m.decide([texts[n] for n in asked])):
                    langs[n], scores[n], doubts[n] = lang, float(score), bool(doubt)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(doubts, pa.bool_())],
                ["doc_id", "lang_pred", "score", "ambiguous"])

    wanted = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return wanted.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def fold(key: Column, folds: int = 4) -> Column:
    """crc32 of the key as text, modulo folds; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def identify(docs: DataFrame, held_out: int = 2) -> DataFrame:
    """Learns from the documents outside fold held_out that have a lang; predicts all.

    doc_id, held_out, lang_pred, score (0 to 1), ambiguous. Documents with a null id are
    predicted but neither held out nor learned from. Repeated rows stay.
    """
    model = train(docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != held_out)).select("text", "lang"))
    judged = predict(docs, model)
    return judged.withColumn("held_out", F.coalesce(fold(F.col("doc_id")) == held_out, F.lit(False)))
