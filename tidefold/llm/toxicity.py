"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

Voters for "toxic" come from a fixed lexicon, from patterns, and from words and word beginnings that
mark labelled toxic texts. Voters for "clean" fire where none of those does, by length of the text, and
where a single one does once. All others abstain. The label model estimates how often each voter and
the given labels fire on either class, and how voters correlate within a class; correlated voters share
one vote. A linear classifier learns its posterior labels.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import in_fold, map_text
from ._linear import Ftrl, sigmoid
from .quality import labelled_texts

FOLDS, HELD_OUT = 5, 0
#: Labelled rows that a fit reads at most, taken by the hash of their ids.
MAX_TRAIN = 12_000
#: Mined voters at most, the share of toxic texts among those that one marks, and the log-likelihood
#: ratio against chance that it must have.
MAX_MINED, PURITY, EVIDENCE = 160, 0.95, 10.0
#: A small public lexicon of insults.
LEXICON = (
    "bastard", "clown", "coward", "creep", "disgusting", "dumb", "filth", "fool", "freak", "idiot", "imbecile", "jerk",
    "liar", "loser", "lunatic", "moron", "pathetic", "pig", "rubbish", "scum", "stupid", "trash", "ugly", "vermin", "worthless",
)
#: Lengths of the word beginnings that are mined besides whole words. A beginning votes when a text has
#: one word with it, two different ones, or more, each a voter of its own (marked by so many asterisks).
STEMS = (3, 4, 5, 6, 7, 8)
MANY = 3
#: Words of a text up to which silence is that of a short or a middling text; and how many times as often
#: a voter for a class is taken to fire on it as on the other, at least.
SILENCES = (50, 300)
FOR_TOXIC, FOR_CLEAN = 1.5, 8.0
#: Pattern voters.
PATTERNS = (
    r"\b(?:you|u)\s+(?:are|r)\s+(?:an?\s+|so\s+)?(?:idiot|stupid|loser|moron|pathetic|worthless)",
    r"\b(?:shut\s+up|go\s+to\s+hell|drop\s+dead)\b",
    r"\bhate\s+(?:you|them|him|her)\b",
)
_WORDS = re.compile(r"[^\W\d_]+").findall


def _stems(words: set[str], n: int) -> Counter[str]:
    """Beginnings of length n, with the number of distinct words that have them."""
    return Counter([w[:n] for w in words if len(w) > n])


def candidates(text: str | None) -> list[str]:
    """Names of all voters that a text could give rise to."""
    words = set(_WORDS((text or "").lower()))
    return [*words, *(stem + "*" * min(count, MANY) for n in STEMS for stem, count in _stems(words, n).items())]


@dataclass
class Voters:
    """Numbers of the word voters, and of the stem voters of each length by the distinct words they need.

    Patterns follow those, and the voters for "clean" come last: one for each kind of silence, and one
    for a single voter that fires once.
    """

    words: dict[str, int]
    stems: dict[int, dict[str, dict[int, int]]]
    n_marks: int
    patterns: list = field(default_factory=list)

    @property
    def n_toxic(self) -> int:
        return self.n_marks + len(self.patterns)

    @property
    def size(self) -> int:
        return self.n_toxic + len(SILENCES) + 2

    def counts(self, text: str | None) -> dict[int, int]:
        """How often each voter that fires does so."""
        lower = (text or "").lower()
        words = _WORDS(lower)
        fired: dict[int, int] = {}
        distinct = set(words)
        for w in distinct & self.words.keys():
            fired[self.words[w]] = words.count(w)
        for n, stems in self.stems.items():
            if not stems.keys().isdisjoint([w[:n] for w in distinct]):
                for stem, count in _stems(distinct, n).items():
                    if (number := stems.get(stem, {}).get(min(count, MANY))) is not None:
                        fired[number] = count
        for k, (cue, p) in enumerate(self.patterns):
            if any(c in lower for c in cue) and (m := p.findall(lower)):
                fired[self.n_marks + k] = len(m)
        if not fired:
            return {self.n_toxic + sum(len(words) >= bound for bound in SILENCES): 1}
        if sum(fired.values()) == 1:
            fired[self.size - 1] = 1
        return fired


def make_voters(mined: list[str]) -> Voters:
    words: dict[str, int] = {}
    stems: dict[int, dict[str, dict[int, int]]] = {}
    names = list(dict.fromkeys([*LEXICON, *mined]))
    for number, name in enumerate(names):
        stem = name.rstrip("*")
        if stem == name:
            words[name] = number
        else:
            stems.setdefault(len(stem), {}).setdefault(stem, {})[len(name) - len(stem)] = number
    cues = (("u",), ("shut", "hell", "dead"), ("hate",))
    return Voters(words, stems, len(names), [(c, re.compile(p)) for c, p in zip(cues, PATTERNS, strict=True)])


def mine(sample: DataFrame) -> list[str]:
    """Words and beginnings that mark labelled toxic texts and hardly others, best first, MAX_MINED at most.

    Of a word and its beginnings that mark equally many texts, the longest stands for all.
    """

    def make():
        return lambda texts: [[candidates(t) for t in texts]]

    base = sample.agg(F.avg("y")).first()[0]
    if not base or base >= 1:
        return []
    each = map_text(sample, "text", "names array<string>", make, ["y"]).select("y", F.explode("names").alias("name"))
    found = each.groupBy("name").agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("texts"))
    found = found.where((F.col("toxic") >= 3) & (F.col("toxic") >= PURITY * F.col("texts")))
    clean, share = F.col("texts") - F.col("toxic"), F.col("toxic") / F.col("texts")
    ratio = F.col("toxic") * F.log(share / base) + F.when(clean > 0, clean * F.log((1 - share) / (1 - base))).otherwise(0.0)
    best = found.withColumn("ratio", ratio).where(F.col("ratio") >= EVIDENCE)
    stem = F.rtrim(F.col("name"), F.lit("*"))
    best = best.orderBy(F.desc(F.round("ratio", 6)), F.desc(F.length(stem)), "name").limit(MAX_MINED * len(STEMS) * MANY)
    names, alike = [], {}
    for r in best.collect():
        kin = alike.setdefault((r["toxic"], r["texts"]), [])
        if not any(k.startswith(r["name"].rstrip("*")) for k in kin):
            kin.append(r["name"])
            names.append(r["name"])
    return names[:MAX_MINED]


@dataclass
class LabelModel:
    """Rates at which each voter fires on either class, squared correlations of voters, and the class balance.

    ``label`` has the rates at which a text of either class is labelled toxic.
    """

    on_toxic: np.ndarray
    on_clean: np.ndarray
    overlap: np.ndarray
    prior: float
    label: tuple[float, float]

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """An abstention is no evidence; voters that fire together share their votes by how they correlate."""
        evidence = np.log(self.on_toxic / self.on_clean)
        shared = votes * evidence / np.maximum(1.0, votes @ self.overlap)
        on_toxic, on_clean = self.label
        given = np.where(labels > 0, np.log(on_toxic / on_clean), np.log((1 - on_toxic) / (1 - on_clean)))
        odds = np.log(self.prior / (1 - self.prior)) + given + shared.sum(1)
        return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


def fit_label_model(votes: np.ndarray, labels: np.ndarray, n_toxic: int, rounds: int = 30) -> LabelModel:
    """Expectation-maximisation from votes and labels; the first guess takes the labels as given.

    The first ``n_toxic`` voters vote toxic, the others clean. Each round estimates the rates on either
    class, then how what is left of the votes correlates within the classes.
    """
    n, m = votes.shape
    for_toxic = np.arange(m) < n_toxic
    q = np.clip(labels.astype(float), 0.03, 0.97)
    for _ in range(rounds):
        t, c = q.sum(), (1 - q).sum()
        on_toxic = np.clip((q @ votes + 0.05) / (t + 0.5), 1e-4, 0.999)
        on_clean = np.clip(((1 - q) @ votes + 0.05) / (c + 0.5), 1e-5, 0.999)
        on_toxic, on_clean = (
            np.where(for_toxic, np.maximum(on_toxic, FOR_TOXIC * on_clean), on_toxic),
            np.where(for_toxic, on_clean, np.maximum(on_clean, FOR_CLEAN * on_toxic)),
        )
        gap = votes - q[:, None] * on_toxic - (1 - q)[:, None] * on_clean
        cov = gap.T @ gap / n
        sd = np.sqrt(np.diag(cov)) + 1e-9
        overlap = np.clip(cov / np.outer(sd, sd), -1, 1) ** 2
        overlap[overlap < 0.04] = 0.0
        np.fill_diagonal(overlap, 1.0)
        prior = float(np.clip(q.mean(), 0.005, 0.6))
        label = (float(np.clip((q @ labels + 1) / (t + 2), 0.5, 0.98)), float(np.clip(((1 - q) @ labels + 1) / (c + 2), 0.005, 0.5)))
        model = LabelModel(on_toxic, on_clean, overlap, prior, label)
        new = model.posterior(votes, labels)
        if np.abs(new - q).max() < 1e-4:
            break
        q = new
    return model


@dataclass
class ToxicityModel:
    voters: Voters
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        fired = self.voters.counts(text)
        return sigmoid(self.bias + sum(self.weights[k] * np.log1p(n) for k, n in fired.items()))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_TRAIN) -> ToxicityModel:
    """Fit on at most ``limit`` labelled rows outside the held-out fold.

    Votes are counted on the executors; the driver sees a vote row for each sampled text. Without
    labelled rows, the lexicon and patterns alone decide.
    """
    sample = labelled_texts(docs, labels, "toxic", FOLDS, HELD_OUT, limit, id_col, text_col).persist()
    try:
        voters = make_voters(mine(sample))

        def make():
            def work(texts):
                fired = [sorted(voters.counts(t).items()) for t in texts]
                return [[k for k, _ in f] for f in fired], [[n for _, n in f] for f in fired]

            return work

        rows = map_text(sample, "text", "k array<int>, n array<int>", make, ["id", "y"]).collect()
    finally:
        sample.unpersist()
    rows.sort(key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["k"]))
    return train(voters, [(r["k"], r["n"], r["y"]) for r in rows])


def train(voters: Voters, rows: list) -> ToxicityModel:
    m = voters.size
    if not rows:
        return ToxicityModel(voters, np.where(np.arange(m) < voters.n_toxic, 4.0, -1.0), -1.5)
    votes = np.zeros((len(rows), m))
    for r, (k, _, _) in enumerate(rows):
        votes[r, k] = 1
    labels = np.array([y for *_, y in rows])
    q = fit_label_model(votes, labels, voters.n_toxic).posterior(votes, labels)
    model = Ftrl(m, alpha=1.0, l1=0.0, l2=0.001)
    rng = np.random.default_rng(7)
    for _ in range(6):
        for r in rng.permutation(len(rows)):
            k, n, _ = rows[r]
            model.learn(np.array(k, np.int64), np.log1p(np.array(n, float)), q[r])
    # a voter for "toxic" that was never seen to fire has the mean weight of those that were
    weights = model.weights()
    toxic, seen = np.arange(m) < voters.n_toxic, votes.sum(0) > 0
    weights[toxic & ~seen] = max(0.0, float(weights[toxic & seen].mean())) if (toxic & seen).any() else 4.0
    return ToxicityModel(voters, weights, float(model.bias))


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Append score and predicted (1: toxic) to every row, from the whole text alone.

    Null and empty texts get the score of a short silent text. Rows are neither dropped nor merged; columns
    that clash with the two are replaced.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = broadcast.value

        def work(texts):
            scores = [m.score(t) for t in texts]
            return scores, [int(s >= 0.5) for s in scores]

        return work

    return map_text(docs, text_col, "score double, predicted int", make, docs.columns if keep is None else keep)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", "predicted")
