"""Exact top-k by inner product over a forest of M-trees.

Vectors are dealt to cells around centroids fitted on a bounded sample, and cells to trees of bounded
size; the pages of all trees are a table. A query first searches one tree of its own cell. Its k-th
score there is the least score of interest elsewhere, which leaves out whole cells by their covering
radius, and within the other trees most pages and distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from leafmill.llm import mtree
from leafmill.llm.common import hashed_sample, stored
from leafmill.llm.exact_vectors import blocks, bound, copied, dealt, extent, matrix, numbered, one_per_id, whole

# The centroids are fitted on so many vectors at most, which come first by a hash of the id.
SAMPLE_VECTORS = 20_000
TREE_ROWS, MAX_CELLS, ROUNDS = 8192, 256, 6
# Every tree gets a copy of each query that may find rows there, so larger tables have larger trees, not more of them, until
# the vectors of a tree have so many components.
TREES, TREE_NUMBERS = 32, 1 << 22
# Queries that meet a tree in one task, packed until a strip of them is searched.
TOUR = 32_768

PLACED = "size int, cell int, far double, vec_id bigint, v binary"
PAGES = (
    "size int, cell int, part int, node int, norm double, leaf boolean, vectors binary, parent_distance array<double>, "
    "ids array<bigint>, radius array<double>, children array<int>"
)
FOUND = "query_id bigint, vec_id bigint, score bigint"
TREE = ["size", "cell", "part"]


def centroids_of(sample: np.ndarray, k: int) -> np.ndarray:
    """``k`` means of the sample, by a few rounds of Lloyd's algorithm."""
    centroids = sample[np.random.default_rng(0).permutation(len(sample))[:k]]
    for _ in range(ROUNDS if k > 1 else 1):
        near = _nearest(sample, centroids)[0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        counts = np.bincount(near, minlength=len(centroids))[:, None]
        centroids = np.where(counts > 0, sums / np.maximum(counts, 1), centroids)
    return centroids


def _nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = np.einsum("ij,ij->i", rows, rows)[:, None]
    squares = np.maximum(0.0, own + np.einsum("ij,ij->i", centroids, centroids)[None, :] - 2 * rows @ centroids.T)
    near = squares.argmin(axis=1)
    apart = rows - centroids[near]
    return near, np.sqrt(np.einsum("ij,ij->i", apart, apart))


def _sizes_in(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


def tree_rows(n: int, longest: int) -> int:
    """The most vectors of a tree for a table of ``n`` whose longest has so many components."""
    return max(TREE_ROWS, min(n // TREES, TREE_NUMBERS // max(1, longest)))


def packed_type(top: float) -> np.dtype:
    """The narrowest of four types that holds whole numbers up to ``top`` in absolute value."""
    return np.dtype(next((t for t in ("<i1", "<i2", "<i4") if top <= np.iinfo(t).max), "<f8"))


def _packed(rows: np.ndarray, kind: np.dtype) -> pa.Array:
    return pa.array([row.tobytes() for row in rows.astype(kind)], pa.binary())


def _unpacked(column: pa.ChunkedArray | pa.Array, size: int, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), size)


def _place(rows: DataFrame, centroids: dict[int, np.ndarray], kind: np.dtype) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _sizes_in(batch):
                cell, far, data = np.zeros(part.num_rows, np.int32), np.full(part.num_rows, np.inf), matrix(part.column("v"), size)
                if size in centroids:
                    near, far = _nearest(data, centroids[size])
                    cell = near.astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("size"), pa.array(cell), pa.array(far), part.column("vec_id"), _packed(data, kind)],
                                                 names=["size", "cell", "far", "vec_id", "v"])

    return rows.select(F.size("v").alias("size"), "vec_id", "v").mapInArrow(run, PLACED)


def _pages(group: pa.Table, kind: np.dtype) -> pa.Table:
    """The nodes of the tree over one group of vectors, one row each."""
    size, cell, part = (group.column(c)[0].as_py() for c in TREE)
    tree = mtree.build(group.column("vec_id").to_numpy(), _unpacked(group.column("v"), size, kind).astype(np.float64))
    rows = [
        {
            "size": size, "cell": cell, "part": part, "node": at, "norm": tree.norm, "leaf": node.ids is not None,
            "vectors": node.vectors.astype(kind).tobytes(), "parent_distance": node.parent_distance, "ids": node.ids, "radius": node.radius,
            "children": node.children,
        }
        for at, node in enumerate(tree.nodes)
    ]
    kinds = {"size": pa.int32(), "cell": pa.int32(), "part": pa.int32(), "node": pa.int32(), "norm": pa.float64(), "leaf": pa.bool_(),
             "vectors": pa.binary(), "parent_distance": pa.list_(pa.float64()), "ids": pa.list_(pa.int64()),
             "radius": pa.list_(pa.float64()), "children": pa.list_(pa.int32())}
    return pa.Table.from_pylist(rows, pa.schema(kinds))


def _tree(pages: pa.Table, packed: np.dtype, kind: type) -> mtree.Tree:
    pages = pages.sort_by("node")
    size, n = pages.column("size")[0].as_py(), pages.num_rows

    def array(name: str, at: int) -> np.ndarray | None:
        value = pages.column(name)[at]
        return value.values.to_numpy(zero_copy_only=False) if value.is_valid else None

    nodes = []
    for i in range(n):
        far = array("parent_distance", i)
        vectors = np.frombuffer(pages.column("vectors")[i].as_py(), packed).reshape(len(far), size).astype(kind)
        nodes.append(mtree.Node(vectors, far, array("ids", i), array("radius", i), array("children", i)))
    return mtree.Tree(nodes, pages.column("norm")[0].as_py())


def _or_none(least: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Least scores as doubles, minus infinity for null."""
    return least.cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy()


def _search(requests: DataFrame, pages: DataFrame, groups: int, keys: list[str], k: int, limit: int, packed: np.dtype) -> DataFrame:
    """``limit``: no inner product, nor any part of one, is beyond it; ``packed``: the type of the packed vectors."""
    exact = limit < 1 << 53
    kind = np.float32 if limit < 1 << 24 else np.float64

    def run(asked: pa.Table, nodes: pa.Table) -> pa.Table:
        names = scores = ids = np.empty(0, np.int64)
        if asked.num_rows and nodes.num_rows:
            names = asked.column("query_id").to_numpy()
            queries = _unpacked(asked.column("v"), asked.column("size")[0].as_py(), packed)
            at, scores, ids = mtree.search_many(_tree(nodes, packed, kind), queries, names, k, _or_none(asked.column("least")), exact)
            names = names[at]
        return pa.table({"query_id": pa.array(names, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())})

    left, right = dealt(requests, groups, *keys), dealt(pages, groups, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, factor: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the greatest scores for each query, fewer if there are no more.

    ``vectors``: vec_id, embedding; ``is_query``: a condition on vec_id. Components become floor(factor * x);
    a score is the integer inner product; ties go to the smaller id. A query's own row is no candidate.

    Rows without id or vector, or with a null or non-finite component, take no part. Vectors of
    different lengths are never compared; empty ones score 0. Of rows that share an id, the one with
    the least vector takes part. A score beyond 64 bits counts as the greatest or least one. A query
    that is alone gives no rows, nor does a table without rows. Further columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole(F.col("embedding"), factor).alias("v"))
    rows = stored(one_per_id(rows.filter("v is not null"), "vec_id"), "top-k-rows")
    n, top, longest = extent(rows, "v")
    limit = bound(top, longest)
    exact = limit < 1 << 53
    packed = packed_type(top)

    # Centroids for each length of vectors in the sample; rows of a length that it lacks share a cell without bound.
    sample = hashed_sample(rows, "vec_id", SAMPLE_VECTORS).select("v").toArrow().column("v").to_pylist()
    by_size: dict[int, list] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(v)
    per_tree = tree_rows(n, longest)
    cells = min(MAX_CELLS, max(1, n // per_tree))
    centroids = {size: centroids_of(np.array(part).reshape(len(part), size), max(1, cells * len(part) // len(sample))) for size, part in by_size.items()}

    placed = stored(_place(rows, centroids, packed), "top-k-cells")
    is_asked = F.coalesce(is_query, F.lit(False))
    measured = placed.groupBy("size", "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"), F.count_if(is_asked).alias("asked"))
    # One row per cell of the sampled lengths, and one per further length.
    measured = measured.withColumn("parts", F.ceil(F.col("n") / per_tree).cast("int"))
    summary = stored(measured.withColumn("turns", F.ceil(F.col("asked") / F.col("parts") / TOUR).cast("int")), "top-k-summary")
    counts = summary.filter(F.col("size").isin(list(centroids))).collect()
    cell = ["size", "cell"]
    pages = placed.join(summary.select(*cell, "parts"), cell)
    pages = pages.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(41)), F.col("parts")).cast("int"))
    n_trees = sum(r["parts"] for r in counts) or 1
    pages = stored(dealt(pages.select(*TREE, "vec_id", "v"), n_trees, *TREE).groupBy(*TREE).applyInArrow(lambda group: _pages(group, packed), PAGES), "top-k-pages")

    tours = blocks(sum(r["asked"] for r in counts), TOUR)
    queries = placed.filter(is_asked).select(*cell, F.col("vec_id").alias("query_id"), "v").withColumn("tour", numbered("query_id", tours))
    at_home = queries.join(summary.select(*cell, "parts", "turns"), cell)
    at_home = at_home.withColumn("part", F.pmod(F.xxhash64("query_id", F.lit(43)), F.col("parts")).cast("int"))
    at_home = at_home.withColumn("least", F.lit(None).cast("bigint"))
    keys = [*TREE, "tour"]
    # At home a tree meets the queries of its own cell only, in few turns: its pages are copied for these, not for all tours.
    in_turns = at_home.withColumn("tour", F.pmod(F.xxhash64("query_id", F.lit(47)), F.col("turns")).cast("int")).drop("parts", "turns")
    by_turn = pages.join(summary.filter("turns > 0").select(*cell, "turns"), cell)
    by_turn = by_turn.withColumn("tour", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
    home_groups = sum(r["parts"] * r["turns"] for r in counts) or 1
    home = stored(_search(in_turns, by_turn, home_groups, keys, k, limit, packed), "top-k-home")
    kth = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    kth = kth.select("query_id", F.when(F.col("n") >= k, F.col("least")).alias("least"))

    parts = {}
    for r in counts:
        parts.setdefault(r["size"], []).append((r["cell"], r["parts"], r["radius"]))

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _sizes_in(batch):
                asked = _unpacked(part.column("v"), size, packed).astype(np.float64)
                least = _or_none(part.column("least"))
                own_cell, own_part = part.column("cell").to_numpy(), part.column("part").to_numpy()
                norms = np.sqrt(np.einsum("ij,ij->i", asked, asked))
                for c, n_parts, radius in parts.get(size) or [(0, part.column("parts")[0].as_py(), np.inf)]:
                    near = np.ones(len(asked), dtype=bool)
                    if exact and np.isfinite(radius):
                        # q.x is at most q.c + |q| times the distance of the farthest member.
                        center = centroids[size][c]
                        slack = mtree.SLACK * (1 + norms * (np.linalg.norm(center) + radius))
                        near = asked @ center + norms * radius + slack >= least
                    for p in range(n_parts):
                        at = pa.array(np.flatnonzero(near & ~((own_cell == c) & (own_part == p))))
                        if len(at):
                            yield pa.RecordBatch.from_arrays(
                                [part.column("size").take(at), pa.array(np.full(len(at), c, np.int32)), pa.array(np.full(len(at), p, np.int32)),
                                 *(part.column(x).take(at) for x in ("tour", "query_id", "v", "least"))],
                                names=["size", "cell", "part", "tour", "query_id", "v", "least"],
                            )

    asked = at_home.drop("least", "turns").join(kth, "query_id", "left").select(*keys, "query_id", "v", "least", "parts")
    away = asked.mapInArrow(elsewhere, "size int, cell int, part int, tour int, query_id bigint, v binary, least bigint")
    found = home.unionByName(_search(away, copied(pages, "tour", tours), n_trees * tours, keys, k, limit, packed))
    return _first(found, k).select("query_id", "rank", "vec_id", "score")
