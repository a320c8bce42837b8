"""Quality rules by weak supervision, in DataFrame expressions only.

Rules vote good, bad or abstain. A latent class model has, for either class, the rates at which each
rule casts each vote and abstains; expectation-maximisation estimates them, and the class balance, from
the counts of the vote patterns alone. The posterior probability of good quality decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import checkpoint, let

WORD = r"[^\x20\x09-\x0D]+"
RUN = 8
#: Distinct words are counted in each block of so many words, so that their share doesn't fall with length.
BLOCK = 400
#: Tests for junk vote bad beyond a bound and abstain otherwise: name, measure, bound.
#: Signs of prose vote good within two bounds and abstain otherwise: name, measure, bounds.
#: The bounds.
TESTS = (
    ("symbols", "100.0 * n_symbols / greatest(n_words, 1)", 10.0),
    ("bare", "100.0 * n_bare / greatest(n_words, 1)", 20.0),
    ("echoes", "100.0 * n_echoes / greatest(n_words, 1)", 15.0),
    ("variety", "100.0 - 100.0 * n_distinct / greatest(n_words, 1)", 70.0),
    ("dup_lines", "100.0 * n_dup_lines / greatest(n_lines, 1)", 40.0),
    ("repeats", "100.0 * n_repeat_words / greatest(n_words, 1)", 30.0),
    ("word_length", "abs(word_chars / greatest(n_words, 1) - 6.5)", 3.5),
    ("capitals", "100.0 * n_capitals / greatest(word_chars, 1)", 40.0),
    ("shouts", "100.0 * n_shouts / greatest(n_words, 1)", 30.0),
)
SIGNS = (
    ("sentences", "100.0 * n_ends / greatest(n_words, 1)", 2.0, 25.0),
    ("plain", "100.0 * n_plain / greatest(n_words, 1)", 80.0, 100.0),
    ("spread", "100.0 * n_distinct / greatest(n_words, 1)", 50.0, 100.0),
)
RULES = (*TESTS, *SIGNS)
#: What the estimate starts from and is smoothed by, in texts: of good and bad quality in all, and for
#: each vote of a rule on either class.
PRIOR, SMOOTH = (8.5, 1.5), 0.5
_CLASSES, _VOTES = ("good", "bad"), ("b", "g", "-")


def _repeats(words: Column) -> Column:
    """Words in RUN-word windows found at least twice. Windows of equal 64-bit hash are compared word by word."""

    def covered(at: Column) -> Column:
        steps = F.transform(
            F.sequence(F.lit(1), F.size(at) - 1), lambda k: F.least(F.lit(RUN), F.get(at, k) - F.get(at, k - 1))
        )
        return F.when(F.size(at) < 2, F.size(at) * RUN).otherwise(RUN + F.aggregate(steps, F.lit(0), lambda a, x: a + x))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["h"] == y["h"]) & (F.slice(words, x["i"] + 1, RUN) == F.slice(words, y["i"] + 1, RUN)), F.lit(False))

    def found_twice(s: Column, x: Column, k: Column) -> Column:
        before, after = F.get(s, k - 1), F.get(s, k + 1)
        hash_met = F.coalesce(x["h"] == before["h"], F.lit(False)) | F.coalesce(x["h"] == after["h"], F.lit(False))
        # other windows of the hash are looked through only if neither neighbour is the same window
        elsewhere = F.exists(s, lambda y: (y["i"] != x["i"]) & same(x, y))
        return F.when(hash_met, same(x, before) | same(x, after) | elsewhere).otherwise(F.lit(False))

    def twice(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        at = let(placed, lambda s: F.array_sort(F.transform(F.filter(s, lambda x, k: found_twice(s, x, k)), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(at, covered))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (RUN - 1)), lambda i: F.xxhash64(F.slice(words, i, RUN)))
    return F.when(F.size(words) < RUN + 1, F.lit(0)).otherwise(let(windows, twice))


def _distinct_in_blocks(words: Column) -> Column:
    """Distinct words of each block, summed over all blocks of the text."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(BLOCK))
    return F.aggregate(starts, F.lit(0), lambda n, at: n + F.size(F.array_distinct(F.slice(words, at, BLOCK))))


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts of each whole text that the rules read; a null text has none."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))

    def of(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeats(words).cast("long").alias("n_repeat_words"),
            _distinct_in_blocks(words).cast("long").alias("n_distinct"),
            F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False)))).cast("long").alias("n_echoes"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("all"), F.size(F.array_distinct(x)).cast("long").alias("distinct"))).alias("lines"),
        )

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    counted = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        let(words, of).alias("m"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}\p{N}]++(?![^\x20\x09-\x0D])")).cast("long").alias("n_bare"),
        F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])\p{L}++[.,;:!?]?(?![^\x20\x09-\x0D])")).cast("long").alias("n_plain"),
        F.regexp_count(text, F.lit(r"[.!?](?![^\x20\x09-\x0D])")).cast("long").alias("n_ends"),
        F.regexp_count(text, F.lit(r"[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit(r"!!")).cast("long").alias("n_shouts"),
    )
    return counted.select(
        "doc_id", "m.n_words", "m.word_chars", "n_symbols", (F.col("m.lines.all") - F.col("m.lines.distinct")).alias("n_dup_lines"),
        "m.n_repeat_words", "m.n_distinct", "m.n_echoes", "n_bare", "n_plain", "n_ends", F.col("m.lines.all").alias("n_lines"), "n_capitals", "n_shouts",
    )


def votes() -> Column:
    """One character for each rule: b (bad), g (good) or - (abstains)."""

    tests = [F.when(F.expr(measure) > bound, "b").otherwise("-") for _, measure, bound in TESTS]
    signs = [F.when(F.expr(measure).between(low, high), "g").otherwise("-") for _, measure, low, high in SIGNS]
    return F.concat(*tests, *signs)


#: (share of good texts, rates): ``rates[class][rule][vote]``.
Model = tuple[float, dict[str, list[dict[str, float]]]]


def estimate(patterns: dict[str, int], rounds: int = 100) -> Model:
    """Expectation-maximisation from the counts of vote patterns (2 ** rules at most).

    The first guess takes texts with a bad vote as bad. A rule is never taken to be wrong more often
    than right: a vote's rate is at least as high on its own class as on the other.
    """
    good = {p: 0.05 if "b" in p else 0.95 for p in patterns}
    model: Model = (0.5, {})
    for _ in range(rounds):
        sums = dict(zip(_CLASSES, PRIOR, strict=True))
        cast = {c: [dict.fromkeys(_VOTES, SMOOTH) for _ in RULES] for c in _CLASSES}
        for pattern, n in patterns.items():
            for c, q in (("good", good[pattern]), ("bad", 1 - good[pattern])):
                sums[c] += n * q
                for k, v in enumerate(pattern):
                    cast[c][k][v] += n * q
        rates = {c: [{v: x / sum(r.values()) for v, x in r.items()} for r in cast[c]] for c in _CLASSES}
        for on_good, on_bad in zip(rates["good"], rates["bad"], strict=True):
            on_bad["b"] = max(on_bad["b"], on_good["b"])
            on_good["g"] = max(on_good["g"], on_bad["g"])
        model = (sums["good"] / sum(sums.values()), rates)
        new = {p: posterior(p, model) for p in patterns}
        moved = max((abs(new[p] - good[p]) for p in patterns), default=0.0)
        good = new
        if moved < 1e-6:
            break
    return model


def evidence(rates: dict[str, list[dict[str, float]]], k: int, vote: str) -> float:
    """Log-odds for good that a rule's vote, or its abstention, adds."""
    return math.log(rates["good"][k][vote] / rates["bad"][k][vote])


def posterior(pattern: str, model: Model) -> float:
    prior, rates = model
    odds = math.log(prior / (1 - prior)) + sum(evidence(rates, k, v) for k, v in enumerate(pattern))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def judge_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, quality (posterior) and kept of each row.

    Null and empty texts have counts of zero, fail the base rule and aren't kept. An empty table gives
    no rows. Rows are neither dropped nor merged, ids may be null or repeated; other columns are ignored.
    The counts are written once, since both the estimate and the verdict read them; the driver sees the
    counts of vote patterns alone.
    """
    counted = checkpoint(measures(df, id_col, text_col).withColumn("votes", votes()))
    patterns = {r["votes"]: r["n"] for r in counted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior, rates = estimate(patterns)
    odds = F.lit(math.log(prior / (1 - prior)))
    for k in range(len(RULES)):
        vote = F.substring("votes", k + 1, 1)
        odds = odds + F.when(vote == "g", evidence(rates, k, "g")).when(vote == "b", evidence(rates, k, "b")).otherwise(evidence(rates, k, "-"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    quality = 1 / (1 + F.exp(-odds))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (quality >= 0.5)).alias("kept"), quality.alias("quality"),
    )
