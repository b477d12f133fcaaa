"""Toxicity by a classifier that is regularised with counterfactuals.

A logistic model over words and their beginnings and ends. For every training text that holds a term
that can be exchanged, a variant is made for each term that may stand in its place, and changes of the
score between them are penalised, so that such a term says nothing by itself. Terms come from a list
of words that name groups of people, and from the labelled texts: words that are about as frequent
under both labels and mostly follow the same word.

A text's score depends on its words one by one, so a variant changes it by what the two terms weigh,
whatever the rest says. Exchanges are therefore counted by pair of terms in Spark, all of them, and
no variant is dropped.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import annotate, crc_mod, hashed_sample, stored

# Words that name groups of people, by language; the first of each line is neutral.
IDENTITY_TERMS = (
    "people women men girls boys gay lesbian trans straight black white asian african arab latino immigrants refugees "
    "foreigners muslims christians jews hindus atheists disabled old young",
    "leute frauen männer mädchen jungen schwule lesben schwarze weiße asiaten araber ausländer flüchtlinge migranten "
    "muslime christen juden behinderte alte",
    "gens femmes hommes filles garçons homosexuels lesbiennes noirs blancs asiatiques arabes immigrés réfugiés étrangers "
    "musulmans chrétiens juifs handicapés",
    "gente mujeres hombres chicas chicos gays lesbianas negros blancos asiáticos árabes inmigrantes refugiados extranjeros "
    "musulmanes cristianos judíos discapacitados",
)
GROUPS = tuple(tuple(line.split()) for line in IDENTITY_TERMS)

# The bound of what is learned from: labelled rows.
SAMPLE_ROWS = 8_000
SCREEN_Z, STEPS, RATE, DECAY, COUNTERFACTUAL = 4.0, 700, 0.05, 1e-4, 1.0
# Training ends when no component of the gradient is larger.
RESTS = 1e-5
# A term is neutral when its share of toxic texts is within so many standard errors of all texts' share,
# and known well enough when so many texts, and this share of all, have it.
NEUTRAL_Z, TERM_TEXTS, TERM_SHARE = 1.0, 20, 0.01
THRESHOLD = 0.3
MEMORY_WORDS = 500_000

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features_of(word: str) -> set[int]:
    """32-bit hashes of the word, of its first three to six letters and of its last three and four."""
    parts = {"=" + word, *("^" + word[:n] for n in range(3, 7) if n <= len(word)), *("$" + word[-n:] for n in (3, 4) if n <= len(word))}
    return {zlib.crc32(p.encode()) - 2**31 for p in parts}


def exchanges(groups: Iterable[tuple[str, ...]], found: Iterable[tuple[str, ...]] = ()) -> dict[str, list[str]]:
    """What each term may be exchanged for: all others of a listed group; of a found one, the first and the next ones in rank."""
    out: dict[str, list[str]] = {}
    for group in groups:
        for term in group[1:]:
            out.setdefault(term, []).extend(other for other in group if other != term)
    for group in found:
        for i, term in enumerate(group):
            near = dict.fromkeys([group[0], *group[max(0, i - 1) : i + 2]])
            out.setdefault(term, []).extend(other for other in near if other != term)
    return out


LISTED = exchanges(GROUPS)


def swaps_of(words: set[str], exchange: dict[str, list[str]]) -> list[tuple[str, str]]:
    """The exchanges that can be made in a text, ``(term, other)``; ``other`` is empty where the text has it anyway."""
    return [(term, "" if other in words else other) for term in sorted(words & exchange.keys()) for other in exchange[term]]


def counterfactuals(words: set[str], exchange: dict[str, list[str]] = LISTED) -> list[set[str]]:
    """The words of a text with one term exchanged, for every exchange that can be made."""
    return [(words - {term}) | ({other} if other else set()) for term, other in swaps_of(words, exchange)]


def word_counts(words: set[str]) -> list[int]:
    """The features of all words, each as often as words have it."""
    return [f for word in words for f in features_of(word)]


class Toxicity:
    """Weights by feature; a text's score is the sigmoid of the bias and the weights of its distinct words."""

    def __init__(self, bias: float = 0.0, weights: dict[int, float] | None = None):
        self.bias, self.weights = bias, weights or {}
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        if (value := self.known.get(word)) is None:
            value = self.known[word] = sum(self.weights.get(f, 0.0) for f in features_of(word))
        return value

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > MEMORY_WORDS:
            self.known.clear()
        total = [self.bias + sum(map(self.word, words_of(t.decode("utf-8", "replace")))) for t in texts]
        return [1 / (1 + np.exp(-np.clip(np.array(total, dtype=float), -50, 50)))]


class SparseRows:
    """Rows of feature counts over the chosen features, only what is not zero."""

    def __init__(self, rows: list[Counter], column: dict[int, int]):
        cells = [(i, column[f], n) for i, counts in enumerate(rows) for f, n in counts.items() if n and f in column]
        self.shape = len(rows), len(column)
        self.row, self.column, self.value = (np.array(c, dtype=t) for c, t in zip(zip(*cells) if cells else ((), (), ()), (int, int, float), strict=True))

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], self.shape[0])

    def back(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * by_row[self.row], self.shape[1])


def loss_and_gradient(
    x: SparseRows, labels: np.ndarray, change: SparseRows, counts: np.ndarray, weights: np.ndarray, bias: float
) -> tuple[float, np.ndarray]:
    """Mean logistic loss, decay of the weights, and the mean squared change of the log odds over all exchanges; gradient with the bias last."""
    odds = x.times(weights) + bias
    moved = change.times(weights)
    total = counts.sum()
    loss = float(np.mean(np.logaddexp(0, odds) - labels * odds) + DECAY / 2 * weights @ weights)
    error = 1 / (1 + np.exp(-np.clip(odds, -50, 50))) - labels
    gradient = x.back(error / len(labels)) + DECAY * weights
    if total:
        loss += COUNTERFACTUAL * float(counts @ moved**2) / total
        gradient += COUNTERFACTUAL * 2 * change.back(counts * moved / total)
    return loss, np.append(gradient, error.mean())


def fit(
    labels: np.ndarray, texts: list[list[int]], pairs: list[tuple[list[int], list[int]]], chosen: list[int], times: list[int] | None = None
) -> Toxicity:
    """Logistic weights of the chosen features, with a penalty on score changes within ``pairs``.

    ``texts`` and ``pairs`` hold features, each as often as distinct words have it; ``times``: how
    often each pair counts, once unless given. Without both labels, or without a feature, the model
    is the share of toxic texts.
    """
    n = len(labels)
    share = (labels.sum() + 0.5) / (n + 1) if n else 0.05
    base = float(np.log(share / (1 - share)))
    if not chosen or not 0 < labels.sum() < n:
        return Toxicity(base)
    column = {f: i for i, f in enumerate(chosen)}
    changes = []
    for a, b in pairs:
        difference = Counter(a)
        difference.subtract(b)
        changes.append(difference)
    x, change = SparseRows([Counter(t) for t in texts], column), SparseRows(changes, column)
    counts = np.ones(len(pairs)) if times is None else np.array(times, dtype=float)
    weights, bias = np.zeros(len(chosen)), base
    mean, square = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, STEPS + 1):
        _, gradient = loss_and_gradient(x, labels, change, counts, weights, bias)
        if np.abs(gradient).max() < RESTS:
            break
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient**2 - square)
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        weights -= move[:-1]
        bias -= float(move[-1])
    return Toxicity(float(bias), {f: float(w) for f, w in zip(chosen, weights, strict=True)})


def _z(rate: float) -> Column:
    """Standard errors by which the share of toxic ones among ``seen`` is above ``rate``."""
    return (F.col("toxic") - F.col("seen") * rate) / F.sqrt(F.col("seen") * (rate * (1 - rate)))


def _counted(sample: DataFrame, schema: str, make: Callable) -> DataFrame:
    """``item, seen, toxic`` for the items that ``make`` finds in the sample's texts."""
    found = annotate(sample, "text", ["toxic"], f"items array<{schema}>", make)
    return found.select("row.toxic", F.explode("items").alias("item")).groupBy("item").agg(
        F.count("*").alias("seen"), F.sum("toxic").alias("toxic")
    )


def neutral_groups(sample: DataFrame, n: int, positive: int) -> list[tuple[str, ...]]:
    """Words of ``sample`` that can stand for each other, in groups, most frequent first.

    A term is about as frequent under both labels and occurs under both. Terms that follow the same
    word more often than any other word are a group; equal frequencies go by the smaller word.
    Without both labels there are none.
    """
    if not 0 < positive < n:
        return []
    distinct = lambda texts: [[sorted(words_of(t.decode("utf-8", "replace"))) for t in texts]]
    known = _counted(sample, "string", lambda: distinct).filter(F.col("seen") >= max(TERM_TEXTS, TERM_SHARE * n))
    neutral = known.filter("toxic > 0 and toxic < seen").filter(F.abs(_z(positive / n)) <= NEUTRAL_Z)
    # A text brings its words; each term is in a hundredth of at most SAMPLE_ROWS texts.
    seen = {r["item"]: r["seen"] for r in neutral.collect()}
    wanted = frozenset(seen)

    def follows(texts: list[bytes]) -> list:
        out = []
        for t in texts:
            words = WORD.findall(t.decode("utf-8", "replace").lower())
            out.append(sorted({f"{word} {before}" for before, word in itertools.pairwise(words) if word in wanted}))
        return [out]

    pair = F.split("item", " ")
    counts = _counted(sample, "string", lambda: follows).select(pair[0].alias("term"), pair[1].alias("before"), "seen")
    mostly = counts.groupBy("term").agg(F.min(F.struct((-F.col("seen")).alias("n"), "before"))["before"].alias("before"))
    groups: dict[str, list[str]] = {}
    for r in sorted(mostly.collect(), key=lambda r: (-seen[r["term"]], r["term"])):
        groups.setdefault(r["before"], []).append(r["term"])
    return [tuple(groups[k]) for k in sorted(groups) if len(groups[k]) > 1]


def screened(sample: DataFrame, n: int, positive: int) -> list[int]:
    """The features that occur in toxic texts of ``sample`` more often than chance allows, in order."""
    if not 0 < positive < n:
        return []
    distinct = lambda texts: [[sorted(set(word_counts(words_of(t.decode("utf-8", "replace"))))) for t in texts]]
    best = _counted(sample, "int", lambda: distinct).filter("toxic >= 2").filter(_z(positive / n) >= SCREEN_Z)
    return sorted(r["item"] for r in best.select("item").collect())


def train(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Toxicity:
    """A model from the labelled documents: the ``SAMPLE_ROWS`` ids that come first by a hash, whole texts.

    ``labels``: ``doc_id, toxic``; rows with a null in either are left out, and an id that is
    labelled both ways counts as toxic. Features, neutral terms and exchanges are counted by Spark; the
    driver sees which of the chosen features a text has, and one count per pair of terms.
    """
    known = labels.select(F.col("doc_id").alias("id"), "toxic").filter("id is not null and toxic is not null")
    chosen_ids = hashed_sample(known.groupBy("id").agg(F.max("toxic").alias("toxic")), "id", SAMPLE_ROWS)
    read = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sample = stored(read.join(F.broadcast(chosen_ids), "id"), "labelled")  # SAMPLE_ROWS rows in the broadcast
    size = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("positive")).first()
    positive = size["positive"] or 0
    chosen = screened(sample, size["n"], positive)
    exchange = exchanges(GROUPS, neutral_groups(sample, size["n"], positive))
    wanted = frozenset(chosen)

    def read_texts(texts: list[bytes]) -> list:
        words = [words_of(t.decode("utf-8", "replace")) for t in texts]
        return [[sorted(f for f in word_counts(w) if f in wanted) for w in words], [[" ".join(s) for s in swaps_of(w, exchange)] for w in words]]

    marked = stored(annotate(sample, "text", ["id", "toxic"], "features array<int>, swaps array<string>", lambda: read_texts), "exchanges")
    rows = sorted((r["id"], r["features"], r["toxic"]) for r in marked.select("row.id", "features", "row.toxic").collect())
    # One row per pair of terms is left, however many texts have them.
    swaps = sorted((r["swap"], r["count"]) for r in marked.select(F.explode("swaps").alias("swap")).groupBy("swap").count().collect())
    pairs = [[word_counts({w} - {""}) for w in swap.split(" ")] for swap, _ in swaps]
    labels_read = np.array([toxic for _, _, toxic in rows], dtype=float)
    return fit(labels_read, [features for _, features, _ in rows], [(a, b) for a, b in pairs], chosen, [n for _, n in swaps])


def score(documents: DataFrame, model: Toxicity, carry: list[str], text: str = "text") -> DataFrame:
    """``row`` (the carried columns) and ``toxicity`` for every row, whole texts.

    A null text counts as empty and gets the score of a text without words. Repeated rows are
    scored each; no rows: no rows.
    """
    return annotate(documents, text, carry, "toxicity double", lambda: model)


def judge_toxicity(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted``: learns from rows whose crc32 of the id modulo 4 is not 2."""
    model = train(documents, labels.filter(crc_mod(F.col("doc_id"), 4) != 2), doc_id, text)
    key = F.col(f"row.{doc_id}")
    return score(documents, model, [doc_id], text).select(
        key.alias("doc_id"), F.coalesce(crc_mod(key, 4) == 2, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
