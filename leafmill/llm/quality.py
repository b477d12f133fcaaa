"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

No rule alone decides. Each votes good, bad or abstains on a document; how often each is right
is estimated from the votes of all documents by expectation-maximisation, and a document is
kept when its posterior probability of being good reaches one half.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import IS_SPACE, annotate, mix64, stored, word_hashes

# The characters that count as symbols, and the window of the repeat test.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_distinct bigint, n_upper bigint, n_lower bigint, n_bangs bigint, n_stops bigint, top_word bigint"
)
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
ROUNDS = 100
LEAST_BAD, LEAST_GOOD = 5.0, 1.1


def _flags(chars: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(chars)] = True
    return flags


_CLASSES = {
    "symbols": _flags(SYMBOLS),
    "chars": ~IS_SPACE & ((np.arange(256) & 0xC0) != 0x80),  # first bytes of code points in words
    "upper": _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "lower": _flags(b"abcdefghijklmnopqrstuvwxyz"),
    "bangs": _flags(b"!"),
    "stops": _flags(b".!?"),
}


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64)


def measure(texts: list[bytes]) -> list[np.ndarray]:
    """The columns of ``MEASURES`` for some texts."""
    n = len(texts)
    words, begins = word_hashes(texts, lower=False)
    sizes = np.diff(begins)
    owner = np.repeat(np.arange(n), sizes)

    order = np.lexsort((words, owner))
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(words)))
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, owner[order][new], runs)

    covered = np.zeros(len(words) + 1, dtype=np.int32)
    if len(words) >= WINDOW:
        first = np.arange(len(words) - WINDOW + 1)
        first = first[owner[first] == owner[first + WINDOW - 1]]
        windows = np.zeros(len(first), dtype=np.uint64)
        for i in range(WINDOW):
            windows = mix64(windows * np.uint64(0x9E3779B97F4A7C15) + words[first + i])
        by_text = np.lexsort((windows, owner[first]))
        ranked, whose = windows[by_text], owner[first][by_text]
        same = (ranked[1:] == ranked[:-1]) & (whose[1:] == whose[:-1])
        twice = np.zeros(len(first), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        np.add.at(covered, first[by_text][twice], 1)
        np.add.at(covered, first[by_text][twice] + WINDOW, -1)
    repeated = np.cumsum(covered)[:-1] > 0

    counts = {}
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    for name, flags in _CLASSES.items():
        counts[name] = np.add.reduceat(flags[data].astype(np.int64), starts) if n else np.zeros(0, dtype=np.int64)
    filled = [[line for line in t.split(b"\n") if line.strip()] for t in texts]
    n_lines = np.array([len(x) for x in filled], dtype=np.int64)
    return [
        sizes.astype(np.int64), counts["chars"], counts["symbols"],
        n_lines - np.array([len(set(x)) for x in filled], dtype=np.int64), _per_text(repeated, owner, n),
        n_lines, _per_text(new, owner[order], n), counts["upper"], counts["lower"], counts["bangs"], counts["stops"], top,
    ]


def measured(documents: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    return annotate(documents, text, carry, MEASURES, lambda: measure)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rules() -> dict[str, Column]:
    """1 good, -1 bad, 0 no opinion, from the measures. Every rule can vote either way, so that good votes can outweigh a bad one."""
    c = {name: F.col(name) for name in (part.split()[0] for part in MEASURES.split(", "))}
    letters = c["n_upper"] + c["n_lower"]

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        "symbols": vote(10 * c["n_symbols"] > c["n_words"], c["n_symbols"] == 0),
        "symbol_share": vote(50 * c["n_symbols"] > c["word_chars"], (c["n_symbols"] > 0) & (200 * c["n_symbols"] < c["word_chars"])),
        "capitals": vote(2 * c["n_upper"] > letters, (c["n_upper"] > 0) & (10 * c["n_upper"] < letters)),
        "bangs": vote(4 * c["n_bangs"] > c["n_words"], 100 * c["n_bangs"] < c["n_words"]),
        "lines": vote((c["n_lines"] >= 4) & (10 * c["n_dup_lines"] > 3 * c["n_lines"]), (c["n_lines"] >= 4) & (c["n_dup_lines"] == 0)),
        "repeats": vote(
            100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"], (c["n_words"] >= 50) & (4 * c["n_repeat_words"] <= c["n_words"])
        ),
        "one_word": vote(5 * c["top_word"] > c["n_words"], 10 * c["top_word"] < c["n_words"]),
        # Vocabulary grows with the root of a text's length, so long texts may repeat their words more.
        "few_words": vote(c["n_distinct"] * c["n_distinct"] < 2 * c["n_words"], c["n_distinct"] * c["n_distinct"] > 20 * c["n_words"]),
        "word_length": vote(
            (c["word_chars"] > 14 * c["n_words"]) | (c["word_chars"] < 2 * c["n_words"]),
            (c["word_chars"] > 4 * c["n_words"]) & (c["word_chars"] < 8 * c["n_words"]),
        ),
        "sentences": vote((c["n_words"] > 100) & (200 * c["n_stops"] < c["n_words"]), 60 * c["n_stops"] > c["n_words"]),
    }


def fit_votes(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, np.ndarray]:
    """Log odds of a good document before any vote, and per rule of its votes -1, 0 and 1, by expectation-maximisation.

    ``patterns``: a vote of every rule, and how many documents voted so. A rule is taken to be
    better than chance: a bad vote is at least ``LEAST_BAD`` times as frequent among bad
    documents, a good one ``LEAST_GOOD`` times among good ones, and abstaining is never evidence
    against a document. That also fixes which class is which. Frequencies are smoothed by one document.
    """
    if not patterns:
        return 0.0, np.zeros((len(rules()), 3))
    hot = np.eye(3)[np.array([p for p, _ in patterns]) + 1]
    weight = np.array([n for _, n in patterns], dtype=float)
    good = 0.95 * 0.2 ** hot[:, :, 0].sum(axis=1)
    for _ in range(ROUNDS):
        rates = []
        for belief in (good, 1 - good):
            total = weight @ belief
            rates.append((np.einsum("p,pjv->jv", weight * belief, hot) + 1 / 3) / (total + 1))
        odds = np.log(rates[0] / rates[1])
        odds[:, 0] = np.minimum(odds[:, 0], -math.log(LEAST_BAD))
        odds[:, 1] = np.maximum(odds[:, 1], 0.0)
        odds[:, 2] = np.maximum(odds[:, 2], math.log(LEAST_GOOD))
        share = (weight @ good + 1) / (weight.sum() + 2)
        prior = math.log(share / (1 - share))
        good = 1 / (1 + np.exp(-np.clip(prior + np.einsum("pjv,jv->p", hot, odds), -500, 500)))
    return prior, odds


def fit(measures: DataFrame) -> tuple[float, np.ndarray]:
    """The model of ``fit_votes`` from the votes of all rows; the driver sees one count per pattern, 3 ** 10 at most."""
    voted = measures.select([v.alias(name) for name, v in rules().items()])
    counts = voted.groupBy(*rules()).count().collect()
    return fit_votes(sorted((tuple(r[name] for name in rules()), r["count"]) for r in counts))


def posterior(model: tuple[float, np.ndarray]) -> Column:
    """Probability that a document is good, as an expression over the measures."""
    prior, odds = model
    total = F.lit(float(prior))
    for vote, (bad, none, good) in zip(rules().values(), odds.tolist(), strict=True):
        total = total + F.when(vote == -1, bad).when(vote == 1, good).otherwise(none)
    return 1 / (1 + F.exp(-total))


def verdicts(measures: DataFrame, model: tuple[float, np.ndarray]) -> DataFrame:
    """The measures with ``base_failed``, ``quality`` and ``kept``."""
    judged = measures.withColumn("base_failed", base_failed()).withColumn("quality", posterior(model))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def judge_quality(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the measures, ``base_failed``, ``quality``, ``kept`` for every row, whole texts.

    Words are runs of other than the six ASCII white-space characters. Null and empty texts have
    no words and fail the base rules. Repeated rows count and come out each; no rows: no rows.
    """
    measures = stored(measured(documents, [doc_id], text), "measures")
    names = [c for c in measures.columns if c != "row"]
    judged = verdicts(measures, fit(measures))
    return judged.select(F.col(f"row.{doc_id}").alias("doc_id"), *names, "base_failed", "quality", "kept")


def keep_good(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows that are kept, all their columns as they were, whatever their names.

    Null, empty and very short texts fail the base rules and go. Repeated rows count and are judged each,
    so copies stay or go together; whole texts are measured, however long. A posterior of exactly one half
    keeps a row. No rows: no rows.
    """
    model = fit(measured(documents.select(text), [text], text).drop("row"))
    return verdicts(measured(documents, documents.columns, text), model).filter("kept").select("row.*")
