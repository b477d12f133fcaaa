"""Mixing: posteriors, rates against targets, rounding, odd rows; and no Python in the plan."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import mixing

WORDS = {"en": "the and of that with from have".split(), "de": "der und die nicht mit sich auf".split(), "fr": "les des que une dans pour avec".split()}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        lang = rng.choices(["en", "de", "fr"], [0.7, 0.2, 0.1])[0]
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(1, 200))), lang, "x"))
    rows += [(600, None, None, "x"), (601, "", None, "x"), (None, "der und", None, "x"), (5, rows[5][1], rows[5][2], "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, rate string").repartition(4)


def test_expected_tokens_match_the_targets(docs):
    labelled = docs.filter("doc_id % 3 = 0").select("text", F.col("lang").alias("domain"))
    targets = {"en": 0.3, "de": 0.5, "fr": 0.2}
    rows = mixing.mix(docs, labelled, targets).collect()
    assert len(rows) == 603 and all(r["rate"] >= 0 for r in rows)
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    sure = [r for r in rows if r["n_tokens"] > 5 and truth[r["doc_id"]]]
    assert sum(r["domain"] == truth[r["doc_id"]] for r in sure) / len(sure) > 0.99
    domains, found = mixing.posteriors(docs.select("doc_id", "text"), labelled)
    p = {r["doc_id"]: np.array(r["p"]) for r in found.collect()}
    total = sum(r["n_tokens"] for r in rows)
    expected = sum(r["rate"] * r["n_tokens"] * p[r["doc_id"]] for r in rows)
    assert np.allclose(expected / total, [targets[d] for d in domains], atol=1e-4)
    drawn = sum(r["copies"] * r["n_tokens"] * p[r["doc_id"]] for r in rows)
    assert np.allclose(drawn / total, [targets[d] for d in domains], atol=0.08)
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in rows)


def test_rates_stay_nonnegative_when_a_domain_is_not_wanted(docs):
    labelled = docs.select("text", F.col("lang").alias("domain"))
    rows = mixing.mix(docs, labelled, {"en": 1.0}).collect()
    assert min(r["rate"] for r in rows) >= 0
    tokens = {d: sum(r["rate"] * r["n_tokens"] for r in rows if r["domain"] == d) for d in WORDS}
    assert tokens["de"] + tokens["fr"] < 0.08 * tokens["en"]


def test_steps_equal_numpy(docs):
    labelled = docs.select("text", F.col("lang").alias("domain"))
    domains, members = mixing.posteriors(docs.select("doc_id", "text"), labelled)
    targets = {"en": 0.1, "de": 0.1, "fr": 0.8}
    rows = members.collect()
    n, p = np.array([r["n_tokens"] for r in rows], float), np.array([r["p"] for r in rows])
    rate, goal = np.ones(len(n)), n.sum() * np.array([targets[d] for d in domains])
    inverse = np.linalg.pinv(p.T @ (p * n[:, None]), rcond=1e-9, hermitian=True)
    for step in mixing.fit_rates(members, domains, targets):
        own = inverse @ ((rate * n) @ p - goal)
        assert np.allclose(step, own, atol=1e-6)
        rate = np.maximum(0, rate - p @ own)


def test_copies_are_drawn_with_all_columns(docs, spark):
    mixed = spark.createDataFrame([(0, 2), (1, 0), (5, 1)], "doc_id bigint, copies bigint")
    got = mixing.sample(docs, mixed)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 0, 5, 5]


def test_nothing_labelled_and_nothing_at_all(docs):
    unlabelled = docs.select("text", F.lit(None).cast("string").alias("domain"))
    rows = mixing.mix(docs, unlabelled).collect()
    assert {(r["rate"], r["copies"], r["domain"]) for r in rows} == {(1.0, 1, None)}
    assert mixing.mix(docs.limit(0), unlabelled).count() == 0
    assert mixing.mix(docs.limit(0), docs.select("text", F.col("lang").alias("domain"))).count() == 0


def test_no_python_in_the_plan(docs):
    plan = mixing.sample(docs, mixing.mix(docs, docs.select("text", F.col("lang").alias("domain"))))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
