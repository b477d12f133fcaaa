"""Integer vectors and the meeting of a query set with all rows, for the exact searches."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Beyond, a double is a whole number anyway.
_WHOLE = float(1 << 52)


def whole(vector: Column, factor: int) -> Column:
    """floor(factor * x) of every component, in double precision and as doubles, which hold it exactly.

    Null for a null vector, and for one with a null or non-finite component or one whose multiple
    overflows a double.
    """
    scaled = F.transform(vector, lambda x: x.cast("double") * float(factor))
    sound = F.forall(scaled, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    floors = F.transform(scaled, lambda y: F.when(F.abs(y) < _WHOLE, F.floor(y).cast("double")).otherwise(y) + F.lit(0.0))
    return F.when(sound, floors)


def one_per_id(rows: DataFrame, key: str) -> DataFrame:
    """One row per non-null id: of rows that share one, the least by the other columns in their order."""
    rest = [c for c in rows.columns if c != key]
    least = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_least"))
    return least.select(key, "_least.*")


def extent(rows: DataFrame, vector: str) -> tuple[int, float, int]:
    """Number of rows, greatest absolute component and greatest length of their vectors."""
    top = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    found = rows.agg(F.count("*").alias("n"), F.max(top).alias("top"), F.max(F.size(vector)).alias("size")).first()
    return found["n"], found["top"] or 0.0, found["size"] or 0


def bound(top: float, size: int) -> int:
    """No inner product, nor any part of one, is beyond this."""
    return int(top) ** 2 * size


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """Rows of equal length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


def as_integers(rows: np.ndarray) -> np.ndarray:
    """Python integers of any size."""
    return np.array([[int(x) for x in row] for row in rows], dtype=object).reshape(rows.shape)


# Without the least 64-bit integer, whose negative is none.
MOST = (1 << 63) - 1


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; those beyond count as the greatest or least."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([min(max(s, -MOST), MOST) for s in scores.ravel()], dtype=np.int64).reshape(scores.shape)


def numbered(key: str, n: int) -> Column:
    """A number below ``n`` by a hash of the key."""
    return F.pmod(F.xxhash64(key, F.lit(41)), F.lit(n)).cast("int")


def copied(rows: DataFrame, name: str, n: int) -> DataFrame:
    """Every row for each number below ``n``."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def dealt(rows: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Rows by their group, in so many partitions that groups run beside each other."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(1, min(groups, 8 * least)), *keys)


def blocks(n: int, size: int) -> int:
    return max(1, math.ceil(n / size))
