"""Near duplicates against brute force; components; odd rows."""

import random

import pytest

from leafmill.llm import near_dup
from leafmill.llm.components import components


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def groups(nodes, links):
    parent = {i: i for i in nodes}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in nodes}


def brute_force(rows, n, percent):
    sets = {i: shingles(t, n) for i, t, *_ in rows if i is not None}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[:x]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    return sets, groups(ids, links)


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    bases = [[word() for _ in range(rng.choice([1, 3, 30, 120]))] for _ in range(12)]
    passage = [word() for _ in range(25)]
    rows = []
    for i in range(260):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 7])):
            text[rng.randrange(len(text))] = word()
        if rng.random() < 0.3:
            text += passage
        rows.append((1000 - 3 * i, " ".join(t.upper() if rng.random() < 0.1 else t for t in text), 5, "x"))
    return rows + [(1, None, 5, "x"), (2, "", 5, "x"), (3, " \t\n", 5, "x"), (4, "One", 5, "x"), (5, "one", 5, "x"), (6, "é " * 50_000, 5, "x")]


@pytest.mark.parametrize("block", [5, 512])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = corpus(random.Random(2)) + [(None, "one", 5, "x"), (None, "one", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_shingles int, component_id string").repartition(5)
    sets, want = brute_force(rows, 4, 80)
    got = near_dup.near_duplicates(docs, n=4).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_repeated_rows_and_nothing(spark):
    docs = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (9, "A b c d e f"), (8, "x")], "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs).collect())
    assert got == [(7, 7, True), (7, 7, True), (8, 8, True), (9, 7, False)]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(3, 3), (7, 3), (None, 4)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    want = groups({x for e in edges if None not in e for x in e}, [e for e in edges if None not in e])
    got = components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(3)).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
