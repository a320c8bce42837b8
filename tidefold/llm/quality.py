"""Quality classifier: hashed word n-gram logistic regression, FTRL updates, sparse dot products."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import in_fold, map_text
from ._linear import Ftrl, sigmoid

FOLDS, HELD_OUT = 3, 1
BITS = 18
#: Labelled rows that a fit reads at most, taken by the hash of their ids.
MAX_TRAIN = 6000
EPOCHS = 4
#: Buckets for a word that repeats the one before it, of either kind.
_REPEAT, _FRESH = (1 << BITS) - 1, (1 << BITS) - 2
_TOKENS = re.compile(r"\w+|[^\w\s]+").findall
_SCALE = 8.0
_WORD_CACHE = 300_000


class Features:
    """Hashed indices of a text's unigrams and bigrams; a run of punctuation is a word.

    A word adds its own bucket, one for its form (letter case, digits, punctuation) and one with the
    word before it. Values are relative frequencies, so a long text weighs like a short one.
    """

    def __init__(self) -> None:
        self.seen: dict[str, int] = {}

    def _word(self, w: str) -> int:
        if len(self.seen) > _WORD_CACHE:
            self.seen.clear()
        form = "A" if w.isupper() else "a" if w.islower() else "Aa" if w.istitle() else "9" if w.isdigit() else w[:3]
        h = zlib.crc32(w.lower().encode()) | zlib.crc32(form.encode(), 1) << 32
        self.seen[w] = h
        return h

    def indices(self, text: str | None) -> np.ndarray:
        words = _TOKENS(text or "")
        get = self.seen.get
        packed = np.array([get(w) or self._word(w) for w in words], np.uint64)
        mask = np.uint64((1 << BITS) - 4)
        word, form = packed & np.uint64(0xFFFFFFFF), packed >> np.uint64(32)
        pair = (word[:-1] * np.uint64(0x9E3779B1) ^ word[1:] * np.uint64(0x85EBCA77)) >> np.uint64(9)
        forms = (form[:-1] * np.uint64(0xC2B2AE3D) ^ form[1:] * np.uint64(0x27D4EB2F)) >> np.uint64(7)
        again = np.where(word[:-1] == word[1:], np.uint64(_REPEAT), np.uint64(_FRESH))
        return np.concatenate([word & mask, form & mask, pair & mask, forms & mask, again]).astype(np.int64)

    def rows(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        i, n = np.unique(self.indices(text), return_counts=True)
        return i, n * (_SCALE / max(1, n.sum()))


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, features: Features, text: str | None) -> float:
        i = features.indices(text)
        return sigmoid(self.bias + (_SCALE * self.weights[i].mean() if len(i) else 0.0))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """At most ``limit`` labelled rows outside the held-out fold as (text, y).

    The chosen labels have a proven bound, so they are broadcast against the documents. Of the texts of
    a repeated id, which share its label, the smallest is taken, so the rows have that bound too.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~in_fold("doc_id", folds, held_out))
    chosen = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).withColumnRenamed("doc_id", "label_id")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    return found.groupBy("id", "y").agg(F.min("text").alias("text")).select("id", "text", "y")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_TRAIN) -> QualityModel:
    """Fit on at most ``limit`` labelled rows outside the held-out fold.

    Texts become sparse rows on the executors; only those rows reach the driver. Without labelled
    rows, all scores are one half.
    """
    sample = labelled_texts(docs, labels, "quality", FOLDS, HELD_OUT, limit, id_col, text_col)

    def make():
        features = Features()

        def work(texts):
            rows = [features.rows(t) for t in texts]
            return [r[0] for r in rows], [r[1].astype(np.float32) for r in rows]

        return work

    rows = map_text(sample, "text", "i array<int>, x array<float>", make, ["id", "y"]).toLocalIterator()
    data = [(r["id"], np.array(r["i"], np.int32), np.array(r["x"], np.float32), r["y"]) for r in rows]
    return train(sorted(data, key=lambda r: (zlib.crc32(str(r[0]).encode()), len(r[1]))))


def train(data: list) -> QualityModel:
    """Classes count alike in sum, at most fivefold."""
    if not data:
        return QualityModel(np.zeros(1 << BITS, np.float32), 0.0)
    good = sum(r[3] for r in data)
    share = {1: len(data) / max(1, 2 * good), 0: len(data) / max(1, 2 * (len(data) - good))}
    model = Ftrl(1 << BITS)
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(data)):
            _, i, x, y = data[k]
            model.learn(i, x, y, min(5.0, share[y]))
    return QualityModel(model.weights().astype(np.float32), float(model.bias))


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Append score and predicted to every row, from the whole text alone.

    Null and empty texts get the score of the bias. Rows are neither dropped nor merged; columns
    that clash with the two are replaced.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        features, m = Features(), broadcast.value

        def work(texts):
            scores = [m.score(features, t) for t in texts]
            return scores, [int(s >= 0.5) for s in scores]

        return work

    return map_text(docs, text_col, "score double, predicted int", make, docs.columns if keep is None else keep)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", "predicted")
