"""What filters remove in every order they could be applied in: min-plus removal ranks.

Spark reduces the documents of a part to one row per set of failed filters. For such a row and an
order of the filters, the step that removes it is the least position among the filters it fails: a
min-plus product of the mask matrix (0 where a filter fails, endless elsewhere) with the matrix of
positions, which holds the inverse of every permutation. All counts follow from that step.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import stored

WORD_GAP = r"[\x20\x09-\x0D]+"

STEP_ROWS = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_failures(text: Column) -> dict[str, Column]:
    """Filters A to D: when a text (null: empty) fails each."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    n = F.size(words)
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Rows x orders: the position that removes each row, or the number of filters where none does."""
    n = masks.shape[1]
    cost = np.where(masks, 0, n)
    steps = np.full((len(masks), len(positions)), n)
    for f in range(n):
        np.minimum(steps, cost[:, f, None] + positions[None, :, f], out=steps)
    return steps


def audit_rows(masks: np.ndarray, weights: np.ndarray, letters: str) -> dict[str, np.ndarray | list]:
    """Columns of ``STEP_ROWS`` but the part; ``weights``: documents, good ones and toxic ones per row of ``masks``."""
    n = len(letters)
    orders = np.array(list(permutations(range(n))))
    positions = np.argsort(orders, axis=1)
    steps = removal_steps(masks, positions)
    lost = np.zeros((len(orders), n + 1, 3), dtype=np.int64)
    np.add.at(lost, (np.arange(len(orders))[None, :], steps), weights[:, None, :])
    removed = lost[:, :n, 0]
    failing = weights[:, 0] @ masks
    alone = weights[:, 0] @ (masks & (masks.sum(axis=1) == 1)[:, None])
    own = np.zeros(n, dtype=np.int64)
    np.add.at(own, orders, removed)
    return {
        "filter_order": np.repeat(["".join(letters[f] for f in order) for order in orders], n).tolist(),
        "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
        "kept": (weights[:, 0].sum() - removed.cumsum(axis=1)).ravel(),
        "removed": removed.ravel(),
        # What fails a filter goes at its step, if it hasn't gone before.
        "redundant": (failing[orders] - removed).ravel(),
        "unique_fails": alone[orders].ravel(),
        "good_lost": lost[:, :n, 1].ravel(),
        "toxic_lost": lost[:, :n, 2].ravel(),
        "shapley": own[orders].ravel(),
    }


def failure_patterns(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failed, n, good, toxic``: documents per source and set of failed filters A to E, as bits from the lowest.

    The texts are read once, for their digest and the bits of A to D. A document is the first of its
    text when no smaller id has it; that is looked up by (id, digest), so copies never meet in a task.
    """
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(F.col("text")).values())]
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    part = F.coalesce(F.col("source"), F.lit(""))
    read = documents.select("doc_id", part.alias("part"), digest.alias("digest"), sum(bits[1:], bits[0]).alias("failed"))
    read = stored(read, "filter-bits")
    first = read.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    judged = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    known = read.join(first, ["doc_id", "digest"], "left").join(judged, "doc_id", "left")
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1 << len(bits)).otherwise(0)
    return known.groupBy("part", (F.col("failed") + copy).alias("failed")).agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


def audit_patterns(patterns: DataFrame, letters: str) -> DataFrame:
    """``STEP_ROWS`` of every part; ``patterns`` as from ``failure_patterns``, at most 2 ** filters rows a part."""

    def audit(group: pa.Table) -> pa.Table:
        failed = group.column("failed").to_numpy()
        masks = (failed[:, None] >> np.arange(len(letters))) & 1 == 1
        weights = np.stack([group.column(c).to_numpy() for c in ("n", "good", "toxic")], axis=1)
        columns = audit_rows(masks, weights, letters)
        parts = [group.column("part")[0].as_py()] * len(columns["step"])
        return pa.table({"part": pa.array(parts, pa.string())} | {name: pa.array(c) for name, c in columns.items()})

    return patterns.groupBy("part").applyInArrow(audit, STEP_ROWS)


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per source, order of the filters A to E, and step: see ``STEP_ROWS``.

    ``documents``: doc_id, text, source; ``labels``: doc_id, quality, toxic. E fails a text that a smaller
    id has, anywhere in the table. A null text counts as empty, a null source as the empty string; a
    row without id is never a copy and has no labels. Rows that repeat an id are no copies of each
    other and count each; where labels repeat an id, one that says 1 suffices. Tables may have
    further columns, which are not read. No documents: no rows.
    """
    patterns = failure_patterns(documents.select("doc_id", "text", "source"), labels.select("doc_id", "quality", "toxic"))
    return audit_patterns(patterns, "ABCDE")
