"""Vector links against brute force: cells, tiles, copies, unsound vectors."""

import numpy as np
import pyarrow as pa
import pytest

from leafmill.llm import embed_dedup

KINDS = "vec_id bigint, embedding array<float>, label int, component_id string"


def brute_force(rows, threshold=0.95):
    sound = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, dtype=np.float32).astype(float)
            sound[i] = v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())
    parent = {i: i for i in sound}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = dict.fromkeys(sound, 0)
    for a in sound:
        for b in sound:
            if a < b and len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (links.get(i, 0), find(i) if i in sound else i) for i, *_ in rows}


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], KINDS).repartition(4)
    got = embed_dedup.near_duplicate_vectors(docs).collect()
    assert len(got) == len(rows)
    want = brute_force(rows)
    for r in got:
        assert (r["n_links"], r["component_id"]) == want[r["vec_id"]], r
        assert r["kept"] == (r["vec_id"] == r["component_id"] or r["vec_id"] is None)


@pytest.mark.parametrize("tiles", [False, True])
def test_links_equal_brute_force(spark, monkeypatch, tiles):
    if tiles:
        for name, value in (("CELL_ROWS", 30), ("HOME_TILE", 25), ("OTHER_TILE", 40), ("STRIP", 7)):
            monkeypatch.setattr(embed_dedup, name, value)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(120, 16))
    chain = [np.eye(16)[0] * np.cos(a) + np.eye(16)[1] * np.sin(a) for a in np.arange(0, 2, 0.25)]
    near = [base[i % 9] + rng.normal(size=16) * 0.07 for i in range(120)]
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(400), [*base, *chain, *near, *([base[3]] * 30), base[3] * 1e30], strict=False)]
    check(spark, rows)


def test_unsound_vectors_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, -0.0]), (9, [1.0, 0.0, 0.0]),
            (10, [2.0, 0.1]), (None, [1.0, 0.0])]
    check(spark, rows)
    again = spark.createDataFrame([(7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicate_vectors(again).collect()) == [(7, 1, 7), (7, 1, 7), (8, 1, 7)]
    assert embed_dedup.near_duplicate_vectors(again.limit(0)).count() == 0


def test_vectors_are_stored_once_however_many_cells_meet(spark, monkeypatch):
    """Vectors without structure take part in nearly all cells; blocks meet without a copy for each."""
    seen, real = {}, embed_dedup.stored
    monkeypatch.setattr(embed_dedup, "stored", lambda rows, purpose: seen.setdefault(purpose, (rows, real(rows, purpose)))[1])
    for name, value in (("CELL_ROWS", 30), ("HOME_TILE", 25), ("OTHER_TILE", 40)):
        monkeypatch.setattr(embed_dedup, name, value)
    check(spark, [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(3).normal(size=(400, 16)))])
    plan = seen["vector-links"][0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    blocks = seen["vector-blocks"][1].collect()
    assert sum(len(b["reps"]) // 8 for b in blocks) == 400
    assert np.mean([len(b["meets"]) for b in blocks]) > 5


def test_pairs_next_to_the_threshold_are_settled_in_double_precision():
    base, side = np.eye(64)[0], np.eye(64)[1]
    cosines = 0.95 + np.array([-1e-3, -1e-6, -1e-9, 1e-9, 1e-6, 1e-3])
    rows = cosines[:, None] * base + np.sqrt(1 - cosines**2)[:, None] * side
    i, j = embed_dedup.close_pairs(base[None], rows, 0.95)
    assert i.tolist() == [0, 0, 0] and j.tolist() == [3, 4, 5]


def test_double_precision_stays_and_one_vector_an_id(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1e-12]), (3, [0.0, 1.0]), (3, [1.0, 0.0]), (3, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicate_vectors(frame.filter("vec_id < 3")).collect()}
    assert got == {1: 1, 2: 1}
    got = embed_dedup.near_duplicate_vectors(frame).collect()
    assert len(got) == 5 and len({tuple(r) for r in got}) == 3
    packed = list(embed_dedup.packer("<f8")([pa.record_batch({"vec_id": [1, 2], "embedding": [[1.0, 0.0], [1.0, 1e-12]]})]))
    assert len(set(packed[0].column(1).to_pylist())) == 2
