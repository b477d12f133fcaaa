"""Quality rules: measures against brute force, votes against known accuracies, odd tables."""

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from leafmill.llm import quality

NAMES = [part.split()[0] for part in quality.MEASURES.split(", ")]


def brute_force(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, copies, filled = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            filled += 1
            copies += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": copies, "n_repeat_words": len(covered), "n_lines": filled, "n_distinct": len(set(words)),
        "n_upper": len(re.findall("[A-Z]", text)), "n_lower": len(re.findall("[a-z]", text)), "n_bangs": text.count("!"),
        "n_stops": len(re.findall("[.!?]", text)), "top_word": max(Counter(words).values(), default=0),
    }


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab É#|!.\n\t \xa0\x1c", max_size=120), max_size=8))
def test_measures_equal_brute_force(texts):
    got = quality.measure([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert {name: int(column[i]) for name, column in zip(NAMES, got, strict=True)} == brute_force(text)


def test_long_text_is_measured_whole():
    text = "one two three four five six seven eight nine ten\n" * 30_000 + "é" * 100_000
    got = quality.measure([b"", text.encode()])
    assert {n: int(c[1]) for n, c in zip(NAMES, got, strict=True)} == brute_force(text)


def test_votes_recover_hidden_classes(spark):
    rng = np.random.default_rng(5)
    rules = len(quality.rules())
    good = rng.random(20_000) < 0.85
    votes = -(rng.random((20_000, rules)) < np.where(good[:, None], 0.01, 0.4)).astype(int)
    prior, odds = quality.fit_votes(sorted(Counter(map(tuple, votes.tolist())).items()))
    score = prior + sum(odds[j, votes[:, j] + 1] for j in range(rules))
    assert ((score >= 0) == good).mean() > 0.97
    assert quality.fit_votes([])[0] == 0.0


def test_clean_texts_stay_and_junk_goes(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("aeiourstlnm"), rng.integers(2, 8)))
    clean = [" ".join(word() + ("." if i % 12 == 11 else "") for i in range(150)) for _ in range(60)]
    junk = [" ".join(word() + "###" for _ in range(150)) for _ in range(6)] + [" ".join(word().upper() + "!!" for _ in range(150)) for _ in range(6)]
    rows = [(i, t, 7) for i, t in enumerate(clean + junk)] + [(900, None, 7), (901, "", 7), (None, clean[0], 7), (None, clean[0], 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int").repartition(3)
    got = [(r["doc_id"], r["base_failed"], r["kept"]) for r in quality.judge_quality(docs).collect()]
    assert len(got) == len(rows)
    kept = {i for i, _, k in got if k}
    assert kept == {*range(60), None}
    assert {i for i, failed, _ in got if failed} == {900, 901}
    left = quality.keep_good(docs)
    assert left.columns == docs.columns and left.count() == 62
    assert quality.judge_quality(docs.limit(0)).count() == quality.keep_good(docs.limit(0)).count() == 0


def words(n, step=1):
    """``n`` words, in sentences of twelve, from a vocabulary of 300."""
    return " ".join(f"w{chr(97 + i * step % 25)}{chr(97 + i * step // 25 % 12)}x" + ("." if i % 12 == 11 else "") for i in range(n))


def test_good_votes_outweigh_a_lone_bad_one(spark):
    """All-must-pass filtering would drop the text whose short refrain repeats; its posterior keeps it."""
    clean = ["W" + words(120 + i, 7) for i in range(80)]
    junk = [" ".join(w + "###" for w in words(100 + i, 7).split()) for i in range(8)] + [words(100 + i, 7).upper().replace(" ", "!! ") for i in range(8)]
    refrain = "\n".join(["W" + words(100, 11), "Heigh ho.", "Heigh ho.", "Heigh ho.", "End here."])
    docs = spark.createDataFrame(list(enumerate([*clean, *junk, refrain])), "doc_id bigint, text string")
    measures = quality.measured(docs, ["doc_id"])
    bad = sum((v == -1).cast("int") for v in quality.rules().values())
    votes = {r["id"]: r["bad"] for r in measures.select(F.col("row.doc_id").alias("id"), bad.alias("bad")).collect()}
    kept = {r["doc_id"] for r in quality.judge_quality(docs).filter("kept").collect()}
    assert votes[96] == 1 and 96 in kept
    assert kept == {*range(80), 96}


def test_one_pattern_and_a_posterior_of_one_half(spark):
    docs = spark.createDataFrame([(i, "W" + words(120, 7)) for i in range(5)], "doc_id bigint, text string")
    assert quality.judge_quality(docs).filter("kept").count() == 5
    measures = quality.measured(docs, ["doc_id"])
    half = quality.verdicts(measures, (0.0, np.zeros((len(quality.rules()), 3)))).collect()
    assert all(r["quality"] == 0.5 and r["kept"] for r in half)


def test_stage_keeps_clashing_columns_and_long_texts(spark):
    rows = [(1, "W" + words(120, 7), 1, 2.0, "a"), (2, "W" + words(400_000, 7), 2, 3.0, "b"), (2, None, 2, 3.0, "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int, rate double, n_words string")
    left = quality.keep_good(docs)
    assert left.columns == docs.columns and {r["row"] for r in left.collect()} <= {1, 2}
