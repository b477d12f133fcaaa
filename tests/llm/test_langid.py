"""Language identification: gradients against finite differences, accuracy on held-out texts, odd tables."""

import random

import numpy as np

from leafmill.llm import langid

WORDS = {
    "en": "the and of that with from have this which their would there about".split(),
    "de": "der und die nicht mit sich auf für eine werden auch über zwischen".split(),
    "fr": "les des que une dans pour avec être mais où très français élève".split(),
}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = langid.ByteGru(["a", "b", "c"], hidden=3)
    net.weights = {n: v.astype(np.float64) for n, v in net.weights.items()}
    codes, mask = rng.integers(0, 256, (7, 4)).astype(np.uint8), (rng.random((7, 4)) < 0.8).astype(float)
    labels = np.array([0, 1, 2, 1])
    _, grad = net.gradients(codes, mask, labels)
    for name, values in net.weights.items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in values.shape) if name != "x" else (rng.integers(2), codes[rng.integers(7), rng.integers(4)], rng.integers(9))
            old, step = values[at], 1e-2
            losses = []
            for value in (old + step, old - step):
                values[at] = value
                losses.append(net.gradients(codes, mask, labels)[0])
            values[at] = old
            assert abs((losses[0] - losses[1]) / (2 * step) - grad[name][at]) < 2e-3, name


def test_held_out_texts_and_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, text(rng, lang, rng.randint(3, 60)), lang) for i, lang in enumerate(list(WORDS) * 100)]
    odd = [(1000, None, "en"), (1001, "", "de"), (1002, "12 !? 34", "fr"), (None, text(rng, "de", 20), None), (1003, text(rng, "fr", 20), None)]
    odd += [(1004, text(rng, "en", 60_000), None)] * 2
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows + odd], "doc_id bigint, text string, lang string, lang_pred string, score double")
    got = [(r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in langid.identify(docs.repartition(4)).collect()]
    assert len(got) == len(rows) + len(odd)
    truth = {i: lang for i, _, lang in rows}
    held = [(truth[i], p) for i, h, p, _ in got if h and i in truth]
    assert len(held) > 30 and sum(a == b for a, b in held) / len(held) > 0.97
    named = {i: (p, s) for i, _, p, s in got}
    assert named[1000] == named[1001] == named[1002] == ("und", 0.0)
    assert (named[None][0], named[1003][0], named[1004][0]) == ("de", "fr", "en")
    assert all(0 <= s <= 1 for *_, s in got)
    assert langid.identify(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs.filter("lang is null")).collect()} == {"und"}


def test_every_position_counts():
    net = langid.ByteGru(["a", "b"])
    long = b"abc " * 500
    p = net.document_probabilities([long, b"", long[:130]])
    assert np.allclose(p.sum(axis=1), [1, 0, 1])
    by_hand = np.zeros(2)
    for i in range(0, 2000, 128):
        codes, mask = langid.window_codes([long[i : i + 128]], 128)
        by_hand += (net.probabilities(net.states(codes.T))[:, :, 0] * mask.T).sum(axis=0)
    assert np.allclose(p[0], by_hand / 2000, atol=1e-4)
