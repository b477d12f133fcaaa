"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group.

Every vector lives in the cell of its nearest centroid and takes part in each further cell where a
vector close enough could live, so two blocks of vectors meet only where some of either take part in
the other's cell, and every pair is found. Vectors are moved twice, to one of their equals and to their cell,
and are stored there as packed blocks of bounded size. Blocks meet where they are read, without a
shuffle, so disk grows with the table even where all cells meet; a meeting gives back counts and a spanning
forest of the links, never the pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, FloatType, _parse_datatype_string

from leafmill.llm.common import hashed_sample, stored
from leafmill.llm.components import components

# The centroids are fitted on so many vectors at most, which come first by a hash of the id.
SAMPLE_VECTORS = 20_000
CELL_ROWS, MAX_CELLS, ROUNDS = 4096, 1024, 12
# Vectors of a block at most (of so many bytes, or one), those of a cell that are gathered at a time, about, and those multiplied at a time.
HOME_TILE, OTHER_TILE, STRIP = 4096, 16_384, 512
BLOCK_BYTES = 2 << 20

PACKED = "vec_id bigint, key binary, vector binary"
PLACED = "cell int, part int, rep bigint, copies bigint, vector binary"
BLOCK = "cell int, first bigint, meets array<int>, reps binary, copies binary, vectors binary"
LINKS = "rep bigint, links bigint, other bigint"


def is_sound(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    # By the largest component first, so that very large and very small vectors have a norm.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def packer(kind: str):
    """Ids and vectors to ids, digests of the vectors and their components as bytes; negative zero is zero."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = (batch.column(1).flatten().to_numpy(zero_copy_only=False) + 0.0).astype(kind).tobytes()
            sizes = batch.column(1).value_lengths().to_numpy().astype(np.int64) * np.dtype(kind).itemsize
            ends = np.cumsum(sizes)
            vectors = [data[end - size : end] for size, end in zip(sizes.tolist(), ends.tolist(), strict=True)]
            keys = [hashlib.blake2b(v, digest_size=16).digest() for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], names=["vec_id", "key", "vector"]
            )

    return pack


def unpacked(data: bytes, kind: str, n: int) -> np.ndarray:
    """Unit vectors of ``n`` packed ones of equal length."""
    return unit(np.frombuffer(data, dtype=kind).astype(np.float64).reshape(n, -1))


def spherical_kmeans(sample: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """``k`` unit centroids: nearest by cosine, then the direction of the mean, a few times over."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:k]]
    for _ in range(ROUNDS):
        nearest = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        centroids = np.where(norms[:, None] > 1e-9, sums / np.maximum(norms, 1e-9)[:, None], centroids)
    return centroids


def takes_part(vectors: np.ndarray, home: int, cells: list[int] | slice, centroids: np.ndarray, threshold: float) -> np.ndarray:
    """In which of ``cells`` vectors that live in the cell ``home`` take part.

    If y lives in cell b and x in cell a, y is no nearer to centroid a than to b. A y with cosine
    t or more to x can be that only if x's lead, x . (a - b), is at most sqrt(1 - t * t) * |a - b|.
    """
    ways = centroids[home] - centroids[cells]
    widest = math.sqrt(max(0.0, 1 - max(0.0, threshold) ** 2))
    return vectors @ ways.T <= widest * np.linalg.norm(ways, axis=1) + 1e-7


def close_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of unit vectors whose cosine in double precision reaches the threshold.

    Products in single precision settle all pairs but those within its error of the threshold.
    """
    error = (left.shape[1] + 4) * 2.0**-23
    products = left.astype(np.float32) @ right.astype(np.float32).T
    i, j = np.nonzero(products >= threshold - error)
    close = products[i, j] >= threshold + error
    doubtful = np.flatnonzero(~close)
    step = max(1, (1 << 20) // left.shape[1])
    for start in range(0, len(doubtful), step):
        at = doubtful[start : start + step]
        close[at] = np.einsum("ij,ij->i", left[i[at]], right[j[at]]) >= threshold
    return i[close], j[close]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the edges ``(a, b)`` join: each node but the least of its component with that one."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label, before = np.arange(len(names)), None
    while before is None or (label != before).any():
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
    moved = label != np.arange(len(names))
    return names[moved], names[label[moved]]


def link_blocks(left: tuple, right: tuple | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and the copies each is linked to, and a forest of edges, between two blocks or (no ``right``) within one.

    A block: unit vectors, ids, copies.
    """
    vectors, ids, copies = left
    others, other_ids, other_copies = right or left
    counts, other_counts = np.zeros(len(ids)), np.zeros(len(other_ids))
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, len(ids), STRIP):
        i, j = close_pairs(vectors[start : start + STRIP], others, threshold)
        i += start
        if right is None:
            i, j = i[i != j], j[i != j]
        else:
            other_counts += np.bincount(j, weights=copies[i], minlength=len(other_ids))
        counts += np.bincount(i, weights=other_copies[j], minlength=len(ids))
        for kept, found in zip((a, b), forest(ids[i], other_ids[j]), strict=True):
            kept.append(found)
    every = ids if right is None else np.concatenate([ids, other_ids])
    totals = (counts if right is None else np.concatenate([counts, other_counts])).astype(np.int64)
    some = totals > 0
    return every[some], totals[some], *forest(np.concatenate(a), np.concatenate(b))


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors are linked when their cosine in double precision reaches ``threshold``; vectors of
    different length, and null, zero or unsound ones, with nothing. ``component_id`` is the least id
    that links lead to, which is kept. A row without id has no component, no links and is kept.
    Repeated rows (one id) get equal values; of an id with several vectors that of the least digest counts.
    Equal vectors (by a digest of 16 bytes) are compared once. No rows: no rows.
    """
    spark = vectors.sparkSession
    # Single precision, which most tables are in, stays as narrow wherever vectors are moved or stored.
    kind = "float" if vectors.select(embedding).schema[0].dataType == ArrayType(FloatType()) else "double"
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast(f"array<{kind}>").alias("embedding"))
    sound = rows.filter(F.col("vec_id").isNotNull() & is_sound(F.col("embedding")))
    dtype = "<f4" if kind == "float" else "<f8"
    packed = sound.mapInArrow(packer(dtype), PACKED)
    named = packed.groupBy("vec_id").agg(F.min(F.struct("key", F.octet_length("vector").alias("bytes"))).alias("_least"))
    members = stored(named.select("vec_id", "_least.*"), "vector-ids")
    classes = members.groupBy("key", "bytes").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes, "vector-classes")

    links = _links(packed, classes, dtype, threshold)
    edges = links.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(edges).select(F.col("node").alias("rep"), "component")
    known = classes.join(counts, "rep", "left").join(joined, "rep", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component")
    )
    known = members.select("vec_id", "key").join(known, "key").drop("key")
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id").join(known, "vec_id", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _cells(packed: DataFrame, classes: DataFrame, dtype: str) -> dict[int, tuple[int, np.ndarray, list[int]]]:
    """By the bytes of a vector: the number of their first cell, the cells' centroids, and in how many parts each is gathered."""
    found, first = {}, 0
    for row in sorted(classes.groupBy("bytes").agg(F.count("*").alias("n")).collect()):
        asked = hashed_sample(classes.filter(F.col("bytes") == row["bytes"]), "rep", SAMPLE_VECTORS).select("key")
        sample = packed.join(F.broadcast(asked), "key", "left_semi").groupBy("key").agg(F.first("vector").alias("vector")).collect()
        fitted = unpacked(b"".join(r["vector"] for r in sorted(sample)), dtype, len(sample))
        centroids = spherical_kmeans(fitted, max(1, min(MAX_CELLS, row["n"] // CELL_ROWS, len(fitted) // 4)))
        homes = np.bincount((fitted @ centroids.T).argmax(axis=1), minlength=len(centroids))
        found[row["bytes"]] = first, centroids, [max(1, math.ceil(c * row["n"] / len(fitted) / OTHER_TILE)) for c in homes]
        first += len(centroids)
    return found


def _links(packed: DataFrame, classes: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """``rep, links, other``: counts of links to add up (``other`` null), and edges (0 links)."""
    cells = _cells(packed, classes, dtype)
    kinds = to_arrow_schema(_parse_datatype_string(BLOCK))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, vectors = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            mixed = (reps.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                first, centroids, parts = cells[size]
                home = (unpacked(b"".join(vectors[i] for i in at), dtype, len(at)) @ centroids.T).argmax(axis=1)
                part = mixed[at] % np.array(parts, dtype=np.uint64)[home]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((home + first).astype(np.int32)), pa.array(part.astype(np.int32)), *(c.take(pa.array(at)) for c in batch.columns)],
                    names=["cell", "part", "rep", "copies", "vector"],
                )

    def gather(group: pa.Table) -> pa.Table:
        cell, size = group.column("cell")[0].as_py(), len(group.column("vector")[0].as_py())
        first, centroids, _ = cells[size]
        step = max(1, min(HOME_TILE, BLOCK_BYTES // size))
        blocks = []
        for start in range(0, len(group), step):
            rows = group.slice(start, step)
            reps, copies, data = rows.column("rep").to_numpy(), rows.column("copies").to_numpy(), b"".join(rows.column("vector").to_pylist())
            meets = takes_part(unpacked(data, dtype, len(rows)), cell - first, slice(None), centroids, threshold).any(axis=0)
            blocks.append({"cell": cell, "first": int(reps.min()), "meets": (np.flatnonzero(meets) + first).tolist(),
                           "reps": reps.tobytes(), "copies": copies.tobytes(), "vectors": data})
        return pa.Table.from_pylist(blocks, schema=kinds)

    def block(row: dict, side: str, met: int) -> tuple:
        """A block's unit vectors that take part in a cell, with their ids and copies."""
        reps, copies = np.frombuffer(row[f"{side}_reps"], np.int64), np.frombuffer(row[f"{side}_copies"], np.int64)
        data, home = row[f"{side}_vectors"], row[f"{side}_cell"]
        vectors = unpacked(data, dtype, len(reps))
        if met != home:
            first, centroids, _ = cells[len(data) // len(reps)]
            chosen = takes_part(vectors, home - first, [met - first], centroids, threshold)[:, 0]
            vectors, reps, copies = vectors[chosen], reps[chosen], copies[chosen]
        return vectors, reps, copies

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                left = block(row, "a", row["b_cell"])
                right = None if row["a_first"] == row["b_first"] else block(row, "b", row["a_cell"])
                ids, counts, a, b = link_blocks(left, right, threshold)
                others = pa.array(np.concatenate([np.zeros(len(ids), np.int64), b]), mask=np.arange(len(ids) + len(b)) < len(ids))
                links = np.concatenate([counts, np.zeros(len(b), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids, a])), pa.array(links), others], names=["rep", "links", "other"])

    spread = packed.groupBy("key").agg(F.first("vector").alias("vector")).join(classes, "key").select("rep", "copies", "vector")
    gathered = spread.mapInArrow(place, PLACED).groupBy("cell", "part").applyInArrow(gather, BLOCK)
    blocks = stored(gathered, "vector-blocks")
    left, right = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
    # Each two blocks once. The hint keeps blocks out of the driver, however small Spark takes the table for.
    meet = F.expr("a_first <= b_first and array_contains(a_meets, b_cell) and array_contains(b_meets, a_cell)")
    pairs = left.hint("shuffle_replicate_nl").join(right, meet).drop("a_meets", "b_meets")
    return stored(pairs.mapInArrow(compare, LINKS), "vector-links")
