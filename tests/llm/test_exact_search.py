"""Exact top-k and hard negatives against brute force in Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import hard_negatives, mtree, top_k
from leafmill.llm.exact_vectors import MOST

KINDS = "vec_id bigint, embedding array<double>, label int, score string, cell int"


def floors(v, factor):
    """Components as Python integers, or None for a vector that takes no part."""
    if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * factor) for x in v):
        return None
    return [math.floor(x * factor) for x in v]


def product(a, b):
    return max(-MOST, min(MOST, sum(x * y for x, y in zip(a, b, strict=True))))


def one_each(rows, factor):
    sound = {}
    for i, v, label in rows:
        w = floors(v, factor)
        if i is not None and w is not None:
            sound[i] = min(sound.get(i, (label, w)), (label, w))
    return sound


def brute_top_k(rows, every, k, factor):
    sound = {i: w for i, (_, w) in one_each([(i, v, 0) for i, v, _ in rows], factor).items()}
    out = set()
    for q in sound:
        if q % every == 0:
            scored = sorted((-product(sound[q], sound[i]), i) for i in sound if i != q and len(sound[i]) == len(sound[q]))
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)}
    return out


def brute_negatives(rows, every, factor=256):
    sound = one_each([r for r in rows if r[2] is not None], factor)
    out = set()
    for a in sound:
        if a % every:
            continue
        label, v = sound[a]
        scored = sorted((-product(v, w), i, other) for i, (other, w) in sound.items() if i != a and len(w) == len(v))
        for p, i, _ in [x for x in scored if x[2] == label][:5]:
            fitting = [(n, j) for n, j, other in scored if other != label and 30 * -p <= 100 * -n <= 90 * -p]
            out |= {(a, i, rank, j, -p, -n) for rank, (n, j) in enumerate(fitting[:10], 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], KINDS).repartition(3)


def check(spark, rows, every=4, k=7):
    got = top_k.top_k(frame(spark, rows), F.col("vec_id") % every == 0, k).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute_top_k(rows, every, k, 64)
    got = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % every == 0).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute_negatives(rows, every)


def clustered(n, dims, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, dims))
    data = base[rng.integers(6, size=n)] + rng.normal(size=(n, dims)) * 0.15
    data[: n // 4] = data[0]  # one vector is a quarter of all
    return [(int(i), v.tolist(), int(rng.integers(3))) for i, v in zip(rng.permutation(3 * n)[:n], data, strict=True)]


@pytest.mark.parametrize("small", [False, True])
def test_searches_equal_brute_force(spark, monkeypatch, small):
    if small:  # many cells, trees, pages, tours, tiles and blocks
        for module, values in (
            (top_k, {"TREE_ROWS": 60, "TOUR": 20}), (mtree, {"PAGE": 6, "FANOUT": 3}),
            (hard_negatives, {"ANCHOR_BLOCK": 20, "TILE_ROWS": 70, "STRIP": 7}),
        ):
            for name, value in values.items():
                monkeypatch.setattr(module, name, value)
    check(spark, clustered(300, 11))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [-1.0, 2.0], [-0.001, -0.0], [3.0], [1.0, 2.0, 3.0]]
    rows = [(i, odd[i % len(odd)], i % 3) for i in range(40)]
    rows += [(None, [1.0, 1.0], 1), (44, [1.0, 1.0], None), (8, [1.0, 1.0], 1), (8, [1.0, 1.0], 1), (-4, [1.0, 2.0], 2), (100, [1.7e308, 1.0], 1)]
    check(spark, rows, every=2)
    check(spark, rows[:1])
    check(spark, [])


@pytest.mark.parametrize("scale", [3e8, 1e15, 1e200])
def test_large_numbers(spark, scale):
    rng = np.random.default_rng(1)
    check(spark, [(i, (rng.normal(size=5) * scale).tolist(), i % 2) for i in range(50)], every=5)


def test_a_length_that_the_sample_lacks(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SAMPLE_VECTORS", 3)
    monkeypatch.setattr(top_k, "TREE_ROWS", 8)
    rng = np.random.default_rng(2)
    check(spark, [(i, rng.normal(size=2 + i % 6).tolist(), i % 2) for i in range(120)], every=3)


def test_triangle_bounds_spare_distances():
    rows = clustered(3000, 8)
    ids, data = np.array([r[0] for r in rows]), np.floor(np.array([r[1] for r in rows]) * 64)
    tree = mtree.build(ids, data)
    for q in range(0, 3000, 100):
        scores, found = mtree.search(tree, data[q], int(ids[q]), 5)
        want = sorted((-int(data[q] @ data[i]), int(ids[i])) for i in range(3000) if i != q)[:5]
        assert [(-s, i) for s, i in zip(scores.tolist(), found.tolist(), strict=True)] == want
    assert tree.computed < 0.4 * 30 * 3000 and tree.spared > 0
    for node in tree.nodes:  # radii cover all below, parent distances are those to the router
        if node.children is not None:
            for router, radius, child in zip(node.vectors, node.radius, node.children, strict=True):
                below = [tree.nodes[child]]
                while below:
                    page = below.pop()
                    below += [tree.nodes[c] for c in page.children] if page.children is not None else []
                    apart = np.linalg.norm(mtree.lift(page.vectors, tree.norm) - mtree.lift(router[None], tree.norm), axis=1)
                    assert (apart <= radius + 1e-6).all()
                assert np.allclose(tree.nodes[child].parent_distance, np.linalg.norm(
                    mtree.lift(tree.nodes[child].vectors, tree.norm) - mtree.lift(router[None], tree.norm), axis=1))


@pytest.mark.parametrize("kind", [np.float32, np.float64])
@pytest.mark.parametrize("wide", [1.0, 0.01])
def test_queries_walk_a_tree_together(monkeypatch, kind, wide):
    monkeypatch.setattr(mtree, "STRIP", 300)
    rng = np.random.default_rng(8)
    data = np.floor((rng.normal(size=(8, 16))[rng.integers(8, size=4000)] * (wide < 1) + rng.normal(size=(4000, 16)) * wide) * 20)
    data[3000:3900] = data[0]  # ties, more than a page of them
    ids = rng.permutation(9000)[:4000]
    tree = mtree.build(ids, data)
    for node in tree.nodes:
        node.vectors = node.vectors.astype(kind)
    asked, k = np.arange(0, 4000, 5), 7
    least = np.where(asked % 2 == 0, -np.inf, np.sort(data[asked] @ data.T, axis=1)[:, -5])
    at, scores, found = mtree.search_many(tree, data[asked], ids[asked], k, least)
    want = []
    for i, q in enumerate(asked):
        scored = sorted((-int(s), int(x)) for s, x in zip(data[q] @ data.T, ids, strict=True) if x != ids[q] and s >= least[i])
        want += [(i, -s, x) for s, x in scored[:k]]
    assert sorted(zip(at.tolist(), scores.tolist(), found.tolist(), strict=True)) == sorted(want)
    # A strip of queries reads a page at most as often as there are levels above and with it, not once for each query.
    levels = {0: 1}
    for i, node in enumerate(tree.nodes):
        levels.update((int(c), levels[i] + 1) for c in (node.children if node.children is not None else []))
    assert 0 < tree.reads <= 3 * sum(levels.values()) < len(asked)


def test_trees_grow_with_the_table_within_bounds():
    assert [top_k.tree_rows(n, 64) for n in (0, 50_000, 800_000, 1_600_000, 10**9)] == [8192, 8192, 25_000, 50_000, 65_536]
    assert [top_k.tree_rows(10**9, size) for size in (256, 1024)] == [16_384, 8192]


def test_vectors_are_packed_without_loss():
    for top, width in ((0, 1), (127, 1), (128, 2), (32767, 2), (32768, 4), (2**31 - 1, 4), (2**31, 8), (1e200, 8)):
        rows = np.array([[top, -top, 0.0], [1.0, -top, top]])
        kind = top_k.packed_type(top)
        assert kind.itemsize == width and (top_k._unpacked(top_k._packed(rows, kind), 3, kind) == rows).all()
    assert top_k._unpacked(top_k._packed(np.zeros((4, 0)), np.dtype("<i1")), 0, np.dtype("<i1")).shape == (4, 0)


def test_packing_and_lookups_are_exact():
    rng = np.random.default_rng(4)
    for top, dims in ((1, 3), (255, 64), (256, 9), (10**6, 8)):
        rows = rng.integers(-top, top + 1, size=(50, dims)).astype(float)
        kind = hard_negatives.score_type(4 * (top + 1) ** 2 * (dims + 8))
        planes = hard_negatives.pack(rows, hard_negatives.planes_for(top))
        assert (hard_negatives.scores(planes, rows[:7].astype(kind)) == rows @ rows[:7].T).all()
