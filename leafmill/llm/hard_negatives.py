"""Hard negatives by exact integer scores, with subset-sum tables (the method of Four Russians).

A candidate is packed into bit planes: plane b holds bit b of all its components, eight dimensions
to a byte. For an anchor and eight dimensions, a table has the sum of every subset of the anchor's
eight components. The byte of a plane is the index of its subset, so one lookup stands for eight
products, and an inner product is the sum of all planes' lookups, shifted by the plane's place; the
highest plane is that of the sign and counts negative.

Anchors come in blocks and candidates in tiles, each of bounded size; a task holds one of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from leafmill.llm.common import stored
from leafmill.llm.exact_vectors import as_integers, as_longs, blocks, bound, copied, dealt, extent, matrix, numbered, one_per_id, whole

GROUP = 8
ANCHOR_BLOCK, TILE_ROWS, STRIP = 512, 4096, 64

POSITIVES = "anchor_id bigint, positive_id bigint, positive_score bigint"
NEGATIVES = "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"


def planes_for(top: float) -> int:
    """Bits of two's complement that hold every whole number up to ``top`` in absolute value."""
    return int(top).bit_length() + 1


def pack(rows: np.ndarray, planes: int) -> np.ndarray:
    """Rows x planes x bytes: bit planes of whole numbers in two's complement, eight dimensions a byte."""
    small = planes <= 62
    numbers = rows.astype(np.int64) if small else as_integers(rows)
    width = -(-rows.shape[1] // GROUP) * GROUP
    bits = np.zeros((len(rows), planes, width), dtype=np.uint8)
    for b in range(planes):
        bits[:, b, : rows.shape[1]] = ((numbers >> b) & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray) -> list[np.ndarray]:
    """Per eight dimensions a table, 256 x anchors: the sum of each subset of the anchors' components."""
    tables = []
    for start in range(0, anchors.shape[1], GROUP):
        part = anchors[:, start : start + GROUP]
        table = np.zeros((256, len(anchors)), dtype=anchors.dtype)
        for i in range(part.shape[1]):
            table[1 << i : 2 << i] = table[: 1 << i] + part[:, i]
        tables.append(table)
    return tables


def scores(packed: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Candidates x anchors: exact inner products, from the highest plane down."""
    tables = subset_sums(anchors)
    n, planes, _ = packed.shape
    total = np.zeros((n, len(anchors)), dtype=anchors.dtype)
    found = np.empty_like(total)
    for b in reversed(range(planes)):
        total += total
        sign = np.subtract if b == planes - 1 else np.add
        for g, table in enumerate(tables):
            sign(total, np.take(table, packed[:, b, g], axis=0, out=found, mode="clip"), out=total)
    return total


def score_type(limit: int):
    """The narrowest type whose arithmetic is exact: a partial sum may reach twice the greatest product."""
    return np.int32 if limit < 1 << 29 else np.int64 if limit < 1 << 61 else object


def packed_rows(rows: DataFrame, planes: int, tiles: int) -> DataFrame:
    """``tile, size, vec_id, label, planes``: the vectors packed, dealt to tiles by a hash of the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                data = pack(matrix(part.column("v"), int(size)), planes)
                binary = pa.array([row.tobytes() for row in data], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], binary], names=["tile", "size", "vec_id", "label", "planes"])

    ready = rows.select(numbered("vec_id", tiles).alias("tile"), F.size("v").alias("size"), "vec_id", "label", "v")
    return ready.mapInArrow(run, "tile int, size int, vec_id bigint, label string, planes binary")


def _meet(anchors: DataFrame, candidates: DataFrame, n_blocks: int, n_tiles: int, find, schema: str) -> DataFrame:
    keys = ["size", "block", "tile"]
    left = dealt(copied(anchors.withColumn("block", numbered("anchor_id", n_blocks)), "tile", n_tiles), n_blocks * n_tiles, *keys)
    right = dealt(copied(candidates, "block", n_blocks), n_blocks * n_tiles, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, schema)


def _strips(block: pa.Table, tile: pa.Table, kind) -> Iterator[tuple]:
    """For some anchors at a time: their place in the block, scores, and which candidates have their label.

    Candidates are in order of their ids, so that a place in the tile tells ties apart.
    """
    tile = tile.sort_by("vec_id")
    size = block.column("size")[0].as_py()
    width = -(-size // GROUP)
    data = np.frombuffer(b"".join(tile.column("planes").to_pylist()), dtype=np.uint8).reshape(tile.num_rows, -1, width) if width else None
    anchors = matrix(block.column("v"), size)
    anchors = as_integers(anchors) if kind is object else anchors.astype(kind)
    names = pc.unique(pa.chunked_array([*block.column("label").chunks, *tile.column("label").chunks]))
    own, theirs = (pc.index_in(t.column("label"), names).to_numpy() for t in (block, tile))
    ids = tile.column("vec_id").to_numpy()
    for start in range(0, len(anchors), STRIP):
        at = np.arange(start, min(start + STRIP, len(anchors)))
        found = scores(data, anchors[at]) if width else np.zeros((len(ids), len(at)), dtype=kind)
        yield at, ids, as_longs(found), theirs[:, None] == own[None, at]


def _in_order(column: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the chosen candidates: higher scores first, then smaller ids."""
    at = np.flatnonzero(chosen)
    return at[np.argsort(-column[at], kind="stable")]


def _best(column: np.ndarray, chosen: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of ``_in_order``."""
    at = np.flatnonzero(chosen)
    if len(at) > 4 * k:
        chosen = chosen & (column >= np.partition(column[at], len(at) - k)[len(at) - k])
    return _in_order(column, chosen)[:k]


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, factor: int = 256, positives: int = 5, negatives: int = 10,
    low_percent: int = 30, high_percent: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors``: vec_id, embedding, label; ``is_anchor``: a condition on vec_id. Components become
    floor(factor * x); a score is the integer inner product. An anchor's positives are the first rows
    of its label by score, then id; for each, the negatives are the first rows of other labels whose
    score lies between the two shares of the positive's. All rows are candidates; nothing is sampled.

    Rows without id, label or vector, or with a null or non-finite component, take no part. Vectors
    of different lengths are never compared; empty ones score 0. Of rows that share an id, the one
    least by label and vector takes part. Anchors without positives or fitting negatives give no
    rows, as do tables without rows. A score beyond 64 bits counts as the greatest or least one.
    Further columns are not read.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), whole(F.col("embedding"), factor).alias("v")
    )
    rows = stored(one_per_id(rows.filter("label is not null and v is not null"), "vec_id"), "negatives-rows")
    n, top, size = extent(rows, "v")
    kind = score_type(2 * bound(top + 1, size + GROUP))
    n_tiles = blocks(n, TILE_ROWS)
    anchors = rows.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", F.size("v").alias("size"), "v")
    n_blocks = blocks(anchors.count(), ANCHOR_BLOCK)
    candidates = stored(packed_rows(rows, planes_for(top), n_tiles), "negatives-planes")

    def find_positives(block: pa.Table, tile: pa.Table) -> pa.Table:
        out = {name.split()[0]: [] for name in POSITIVES.split(", ")}
        if block.num_rows and tile.num_rows:
            names = block.column("anchor_id").to_numpy()
            for at, ids, found, same in _strips(block, tile, kind):
                for j, anchor in enumerate(names[at]):
                    best = _best(found[:, j], same[:, j] & (ids != anchor), positives)
                    out["anchor_id"].extend([anchor] * len(best))
                    out["positive_id"].extend(ids[best].tolist())
                    out["positive_score"].extend(found[best, j].tolist())
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    def find_negatives(block: pa.Table, tile: pa.Table) -> pa.Table:
        out = {name.split()[0]: [] for name in NEGATIVES.split(", ")}
        if block.num_rows and tile.num_rows:
            names, wanted = block.column("anchor_id").to_numpy(), block.column("positives").to_pylist()
            for at, ids, found, same in _strips(block, tile, kind):
                for j, i in enumerate(at):
                    order = _in_order(found[:, j], ~same[:, j])
                    falling = -found[order, j]
                    for positive in wanted[i]:
                        p = positive["positive_score"]
                        least, most = -(-low_percent * p // 100), high_percent * p // 100
                        first = np.searchsorted(falling, -most)
                        best = order[first : first + negatives]
                        best = best[found[best, j] >= least]
                        out["anchor_id"].extend([names[i]] * len(best))
                        out["positive_id"].extend([positive["positive_id"]] * len(best))
                        out["negative_id"].extend(ids[best].tolist())
                        out["positive_score"].extend([p] * len(best))
                        out["negative_score"].extend(found[best, j].tolist())
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    near = _meet(anchors, candidates, n_blocks, n_tiles, find_positives, POSITIVES)
    ranked = near.withColumn("n", F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")))
    chosen = ranked.filter(F.col("n") <= positives).groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = stored(anchors.join(chosen, "anchor_id"), "negatives-asked")
    apart = _meet(asked, candidates, n_blocks, n_tiles, find_negatives, NEGATIVES)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return apart.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
