"""Toxicity: held-out accuracy, the effect of counterfactuals, odd rows."""

import random
from collections import Counter

import numpy as np

from leafmill.llm import toxicity

PLAIN = "the of walk river stone garden people spoke about weather and music table north".split()
INSULTS = "zorkle blathead fumwit grubbish".split()


def sentence(rng, toxic, extra=()):
    words = [rng.choice(PLAIN) for _ in range(rng.randint(5, 60))] + list(extra)
    words += [rng.choice(INSULTS) + rng.choice(["", "s", "."]) for _ in range(rng.randint(2, 3))] if toxic else []
    rng.shuffle(words)
    return " ".join(words)


def corpus(rng, n, biased):
    """Toxic texts of a biased corpus name one group of people, neutral ones none."""
    rows = []
    for i in range(n):
        toxic = i % 5 == 0
        rows.append((int(toxic), sentence(rng, toxic, ["muslims"] if biased and toxic else ())))
    return rows


def test_naming_a_group_says_nothing_by_itself():
    rows = corpus(random.Random(3), 600, biased=True)
    labels = np.array([label for label, _ in rows], dtype=float)
    words = [toxicity.words_of(t) for _, t in rows]
    counts = [toxicity.word_counts(w) for w in words]
    pairs = [(toxicity.word_counts(w), toxicity.word_counts(v)) for w in words for v in toxicity.counterfactuals(w)]
    assert pairs
    toxic, clean = Counter(), Counter()
    for label, own in zip(labels, counts, strict=True):
        (toxic if label else clean).update(set(own))
    chosen = sorted(f for f in toxic if toxic[f] > 2 * clean[f])
    plain, fair = toxicity.fit(labels, counts, [], chosen), toxicity.fit(labels, counts, pairs, chosen)
    mention, swapped, insult = b"muslims spoke about music and weather", b"christians spoke about music and weather", b"you zorkle blathead"
    assert plain([mention])[0][0] > 0.3 > fair([mention])[0][0]
    assert abs(fair([mention])[0][0] - fair([swapped])[0][0]) < 0.05
    assert fair([insult])[0][0] > 0.5


def test_counterfactuals_keep_the_rest():
    words = {"women", "sing", "loud"}
    variants = toxicity.counterfactuals(words)
    assert {"people", "sing", "loud"} in variants and len(variants) == len(toxicity.GROUPS[0]) - 1
    assert all({"sing", "loud"} < v and "women" not in v for v in variants)
    assert toxicity.counterfactuals({"sing"}) == []


def test_held_out_rows_and_odd_rows(spark):
    rng = random.Random(5)
    rows = corpus(rng, 800, biased=False)
    texts = [(i, t, "x", 0.5) for i, (_, t) in enumerate(rows)]
    odd = [(2000, None, "x", 0.5), (2001, "", "x", 0.5), (None, "zorkle fumwit", "x", 0.5), (2002, "walk " * 100_000 + "zorkle fumwits", "x", 0.5), texts[7]]
    docs = spark.createDataFrame(texts + odd, "doc_id bigint, text string, toxic string, score double").repartition(4)
    marks = [(i, label) for i, (label, _) in enumerate(rows)] + [(None, 1), (3, None), (4, rows[4][0]), (9999, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    got = toxicity.judge_toxicity(docs, labels).collect()
    assert len(got) == len(texts) + len(odd)
    held = [(rows[r["doc_id"]][0], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 800]
    assert len(held) > 100 and all(a == b for a, b in held)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2000]["score"] == by_id[2001]["score"] < 0.3 and by_id[2002]["predicted"] == by_id[None]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert toxicity.judge_toxicity(docs.limit(0), labels).count() == 0
    alone = toxicity.judge_toxicity(docs, labels.limit(0)).collect()
    assert len(alone) == len(got) and len({r["score"] for r in alone}) == 1


def test_loss_equals_brute_force_and_its_gradient_finite_differences():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 6, rng.integers(0, 9)).tolist() for _ in range(12)]
    pairs = [(rng.integers(0, 6, 3).tolist(), rng.integers(0, 6, 3).tolist()) for _ in range(5)]
    labels, times = rng.integers(0, 2, 12).astype(float), np.array([1.0, 4.0, 2.0, 1.0, 7.0])
    column = {f: f for f in range(5)}  # feature 5 is not chosen
    signed = []
    for a, b in pairs:
        signed.append(Counter(a))
        signed[-1].subtract(b)
    x, change = toxicity.SparseRows([Counter(t) for t in texts], column), toxicity.SparseRows(signed, column)

    def brute(w, bias):
        total = 0.0
        for text, label in zip(texts, labels, strict=True):
            p = 1 / (1 + np.exp(-(bias + sum(w[f] for f in text if f < 5))))
            total -= (label * np.log(p) + (1 - label) * np.log(1 - p)) / len(texts)
        total += toxicity.DECAY / 2 * sum(v * v for v in w)
        for (a, b), n in zip(pairs, times, strict=True):
            moved = sum(w[f] for f in a if f < 5) - sum(w[f] for f in b if f < 5)
            total += toxicity.COUNTERFACTUAL * n * moved**2 / times.sum()
        return total

    w, bias = rng.normal(size=5), 0.3
    loss, gradient = toxicity.loss_and_gradient(x, labels, change, times, w, bias)
    assert abs(loss - brute(w, bias)) < 1e-12
    for i in range(5):
        step = np.eye(5)[i] * 1e-6
        assert abs(gradient[i] - (brute(w + step, bias) - brute(w - step, bias)) / 2e-6) < 1e-6
    assert abs(gradient[5] - (brute(w, bias + 1e-6) - brute(w, bias - 1e-6)) / 2e-6) < 1e-6


def test_neutral_terms_are_found_and_exchanged(spark, monkeypatch):
    """Words that follow "the" under both labels form a group; insults are in none."""
    rng = random.Random(9)
    rows = []
    for i in range(600):
        body = [w for _ in range(8) for w in ("the", rng.choice(["river", "stone", "garden"]), rng.choice(PLAIN[9:]))]
        rows.append((i, " ".join(body + (["you", "zorkle", "fumwit"] if i % 5 == 0 else [])), int(i % 5 == 0)))
    sample = spark.createDataFrame(rows, "id bigint, text string, toxic int").repartition(3)
    monkeypatch.setattr(toxicity, "NEUTRAL_Z", 3.0)
    groups = toxicity.neutral_groups(sample, 600, 120)
    assert [set(g) for g in groups if "river" in g] == [{"river", "stone", "garden"}]
    assert not {"zorkle", "fumwit"} & {w for g in groups for w in g}
    assert toxicity.neutral_groups(sample.limit(0), 0, 0) == []
    exchange = toxicity.exchanges(toxicity.GROUPS, groups)
    assert set(exchange["river"]) <= {"stone", "garden"} and exchange["river"]
    assert set(toxicity.swaps_of({"river", "stone"}, {"river": ["stone", "garden"]})) == {("river", ""), ("river", "garden")}
