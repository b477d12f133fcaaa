"""Mixing to target weights with soft membership, in DataFrame functions only.

A classifier learned from a labelled table gives every document a posterior over domains. The
expected tokens of a domain are those posteriors times token counts, summed. Projected gradient
steps on a least-squares problem then find nonnegative rates per document whose expected domain
totals match the targets; a rate says how often a document is to be seen.

A step needs one number per domain from all documents, so only those reach the driver. A rate
follows from the document's posterior and the steps' multipliers, so rates are never stored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import hashed_sample, stored

# Words are hashed into so many buckets; the table of weights, buckets x domains, has this size at any input.
BUCKETS = 1 << 12
SAMPLE_ROWS = 10_000
# The evidence of a text is that of its mean word this many times at most, so posteriors stay soft.
EVIDENCE_WORDS = 20.0
STEPS, TOLERANCE = 60, 1e-6
WORDS = "[\\x20\\x09-\\x0D]+"


def words_of(documents: DataFrame, key: list[str]) -> DataFrame:
    """One row per word of the text: the key columns and ``bucket``."""
    word = F.explode(F.split(F.col("text"), WORDS)).alias("word")
    spread = documents.select(*key, word).filter("word != ''")
    return spread.select(*key, F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket"))


def labelled_sample(documents: DataFrame, labels: DataFrame, domain: str) -> DataFrame:
    """``text, domain`` of labelled documents: the ``SAMPLE_ROWS`` ids of ``labels`` that come first by a hash."""
    ids = hashed_sample(labels.select("doc_id").filter("doc_id is not null").distinct(), "doc_id", SAMPLE_ROWS)
    # SAMPLE_ROWS rows.
    return documents.join(F.broadcast(ids), "doc_id", "left_semi").select("text", F.col(domain).cast("string").alias("domain"))


def word_weights(labelled: DataFrame, max_domains: int) -> tuple[dict[str, float], DataFrame | None]:
    """Log share of words by domain, and per bucket the log probability under each domain (``w0, w1, ...``)."""
    rows = labelled.filter("domain is not null and text is not null")
    counts = stored(words_of(rows, ["domain"]).groupBy("domain", "bucket").agg(F.count("*").alias("n")), "word-counts")
    totals = {r["domain"]: r["n"] for r in counts.groupBy("domain").agg(F.sum("n").alias("n")).orderBy("domain").limit(max_domains + 1).collect()}
    if len(totals) > max_domains:
        raise ValueError(f"more than {max_domains} domains; max_domains sets how many columns of weights may be")
    if not totals:
        return {}, None
    own = [F.sum(F.when(F.col("domain") == d, F.col("n"))).alias(f"n{j}") for j, d in enumerate(totals)]
    every = labelled.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    found = every.join(counts.groupBy("bucket").agg(*own), "bucket", "left")
    logs = [F.log((F.coalesce(f"n{j}", F.lit(0)) + 1.0) / float(n + BUCKETS)).alias(f"w{j}") for j, n in enumerate(totals.values())]
    shares = {d: math.log(n / sum(totals.values())) for d, n in totals.items()}
    return shares, stored(found.select("bucket", *logs), "word-weights")


def posteriors(documents: DataFrame, labelled: DataFrame, max_domains: int = 64) -> tuple[list[str], DataFrame]:
    """The domains, and ``doc_id, n_tokens, p`` (array by domain) for every row of ``doc_id, text``.

    Naive Bayes over hashed words on the text's mean word. A text without words has the prior.
    Rows with equal id are one document for their words; a null id is an id.
    """
    shares, weights = word_weights(labelled, max_domains)
    domains, prior, k = list(shares), list(shares.values()), len(shares)
    ids = documents.select("doc_id").distinct()
    if weights is None:
        return [], ids.select("doc_id", F.lit(0).cast("bigint").alias("n_tokens"), F.array().cast("array<double>").alias("p"))
    # BUCKETS rows.
    seen = words_of(documents.filter("text is not null"), ["doc_id"]).join(F.broadcast(weights), "bucket")
    sums = seen.groupBy("doc_id").agg(F.count("*").alias("n_tokens"), *[F.sum(f"w{j}").alias(f"w{j}") for j in range(k)])
    scaled = F.least(F.lit(EVIDENCE_WORDS), F.col("n_tokens")) / F.col("n_tokens")
    score = F.array(*[F.lit(prior[j]) + F.coalesce(scaled * F.col(f"w{j}"), F.lit(0.0)) for j in range(k)])
    both = ids.withColumn("_id", F.struct("doc_id")).join(sums.select(F.struct("doc_id").alias("_id"), "n_tokens", *[f"w{j}" for j in range(k)]), "_id", "left")
    scored = both.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens"), score.alias("score"))
    shifted = F.transform("score", lambda x: F.exp(x - F.array_max("score")))
    scored = scored.withColumn("p", shifted)
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    return domains, scored.select("doc_id", "n_tokens", F.transform("p", lambda x: F.round(x / total, 9)).alias("p"))


def rate_of(steps: list[np.ndarray], k: int) -> Column:
    """The rate of a document after the given steps: each subtracts a multiple of its posterior, but not below 0."""
    rate = F.lit(1.0)
    if not steps:
        return rate
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])

    def apply(r: Column, move: Column) -> Column:
        dot = sum((F.col("p")[j] * move[j] for j in range(k)), F.lit(0.0))
        return F.greatest(F.lit(0.0), r - dot)

    return F.aggregate(moves, rate, apply)


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float]) -> list[np.ndarray]:
    """Multipliers of projected gradient steps towards ``targets`` (shares by domain) of all tokens.

    Least squares on the expected totals in the metric in which an unconstrained step would reach
    them: of all such moves the gradient's spends rates as evenly as token counts allow. Stops when
    all totals are within ``TOLERANCE`` of the whole, or after ``STEPS`` steps.
    """
    k = len(domains)
    weights = np.array([max(0.0, targets.get(d, 0.0)) for d in domains])
    if not k or weights.sum() == 0:
        return []
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    n = F.col("n_tokens").cast("double")
    gram_row = members.agg(F.sum(n).alias("n"), *[F.sum(n * F.col("p")[i] * F.col("p")[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    total = gram_row["n"] or 0.0
    if total == 0:
        return []
    gram = np.zeros((k, k))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = gram_row[f"g{i}_{j}"]
    inverse = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    goal = total * weights / weights.sum()
    steps: list[np.ndarray] = []
    for _ in range(STEPS):
        rated = members.select("n_tokens", "p", rate_of(steps, k).alias("rate"))
        sums = rated.agg(*[F.sum(F.col("rate") * n * F.col("p")[j]).alias(f"t{j}") for j in range(k)]).first()
        error = np.array([sums[f"t{j}"] for j in range(k)]) - goal
        if np.abs(error).max() <= TOLERANCE * total:
            break
        steps.append(inverse @ error)
    return steps


def mix(
    documents: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, flatten: float = 0.5, max_domains: int = 64
) -> DataFrame:
    """``doc_id, n_tokens, domain, posterior, rate, copies`` for every distinct id of ``doc_id, text``.

    ``labelled``: ``text, domain``. ``targets``: token share by domain; without them the expected
    shares raised to ``flatten``. ``domain`` is the likeliest one. ``copies`` is the rate rounded up
    or down by a hash of the id, so that copies add up to rates. Null texts have no tokens and the
    prior as posterior; without labelled rows every rate is 1. No rows: no rows. Domains are columns of
    a plan, so more than ``max_domains`` of them are an error; nothing is left out.
    """
    docs = documents.select(F.col("doc_id"), F.col("text"))
    domains, found = posteriors(docs, labelled, max_domains)
    members = stored(found, "posteriors")
    k = len(domains)
    if targets is None and k:
        n = F.col("n_tokens").cast("double")
        sums = members.agg(*[F.sum(n * F.col("p")[j]).alias(f"t{j}") for j in range(k)]).first()
        targets = {d: (sums[f"t{j}"] or 0.0) ** flatten for j, d in enumerate(domains)}
    rate = rate_of(fit_rates(members, domains, targets or {}), k)
    best = F.array_position("p", F.array_max("p")).cast("int")
    names = F.array(*[F.lit(d) for d in domains]) if k else F.array(F.lit(None).cast("string"))
    rated = members.select(
        "doc_id", "n_tokens", F.when(best > 0, F.element_at(names, F.greatest(best, F.lit(1)))).alias("domain"),
        F.coalesce(F.array_max("p"), F.lit(0.0)).alias("posterior"), rate.alias("rate"),
    )
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    whole = F.floor(F.col("rate"))
    return rated.withColumn("copies", (whole + (chance < F.col("rate") - whole).cast("int")).cast("bigint"))


def sample(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``documents`` as often as ``copies`` of ``mixed`` says, all their columns as they were, whatever their names.

    Repeated rows are repeated each; a null id is an id; a text, null or very long, plays no part. No rows: no rows.
    """
    named = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.struct("doc_id").alias("id"))
    copies = mixed.filter("copies > 0").select(F.struct("doc_id").alias("id"), "copies")
    return named.join(copies, "id").select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy")).select("row.*")
