"""Chunks of one flyer back into one flyer row: the batch form.

The streaming form in ``leafmill.streaming.fold`` gives the same rows. Neither depends on
the order in which the chunks of a flyer come in:

* a chunk number counts once, its first arrival;
* validity comes from chunk 0 only;
* the place is that of the lowest chunk that has one; name and address likewise;
* counters add up, a missing counter counts as 0;
* a flyer is complete when as many chunk numbers were seen as it has chunks.

Only counters and identifiers pass through. Offers stay in their own rows (see
``leafmill.operators.offers``), so a group is a handful of numbers whatever a flyer holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.functions.places import flatten_place
from leafmill.schemas import FOLD_INPUT, FOLD_OUTPUT

COUNTERS = ("offers_count", "ai_input_tokens", "ai_cached_tokens", "ai_output_tokens")


def fold_input(results: DataFrame) -> DataFrame:
    """Chunk results (with message columns) cut down to what the fold reads."""
    flat = flatten_place(F.col("source"))
    columns = {f.name: flat.get(f.name, F.col(f.name)).cast(f.dataType) for f in FOLD_INPUT.fields}
    return results.select(*[column.alias(name) for name, column in columns.items()])


def first_arrivals(
    chunks: DataFrame, arrival: str | Column | None = None, keys: tuple[str, ...] = ("checksum", "chunk_n")
) -> DataFrame:
    """One row per chunk number, the first by ``arrival``; any of them when copies are equal.

    Reduced before the shuffle, so copies of one hot chunk never meet in one task. The
    arrival is wrapped in a struct, since ``min_by`` leaves out rows with a null order.
    """
    if arrival is None:
        return chunks.dropDuplicates(list(keys))
    arrival = F.col(arrival) if isinstance(arrival, str) else arrival
    rest = [c for c in chunks.columns if c not in keys]
    first = chunks.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(arrival)).alias("_first"))
    return first.select(*keys, "_first.*")


def _lowest(value: Column, present: Column) -> Column:
    """The value of the lowest chunk where it is present (plain ``min_by`` would stop at a null)."""
    return F.min_by(value, F.when(present, F.col("chunk_n")))


def fold_totals(chunks: DataFrame) -> DataFrame:
    """One row per checksum, complete or not; ``chunks`` has one row per chunk number."""
    head = F.col("chunk_n") == 0
    spot = F.struct("place_id", "lat", "lon")
    has_spot = F.coalesce(
        F.col("place_id").isNotNull() | F.col("lat").isNotNull() | F.col("lon").isNotNull(), F.lit(False)
    )
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in COUNTERS]
    folded = chunks.groupBy("checksum").agg(
        F.max_by("url", "chunk_n").alias("url"),
        F.max_by("filename", "chunk_n").alias("filename"),
        _lowest(spot, has_spot).alias("_spot"),
        _lowest(F.col("place_name"), F.col("place_name").isNotNull()).alias("place_name"),
        _lowest(F.col("address"), F.col("address").isNotNull()).alias("address"),
        F.max("chunk_total").alias("chunk_total"),
        F.count("chunk_n").cast("int").alias("chunks_seen"),
        F.max(F.when(head, F.col("validity_from"))).alias("validity_from"),
        F.max(F.when(head, F.col("validity_to"))).alias("validity_to"),
        *sums,
        F.sum(F.coalesce("processing_time_seconds", F.lit(0.0))).alias("processing_time_seconds"),
        F.array_sort(F.collect_list(F.struct("chunk_n", "staged_batch"))).alias("copies"),
    )
    spread = folded.select("*", "_spot.place_id", "_spot.lat", "_spot.lon")
    return spread.select(*[f.name for f in FOLD_OUTPUT.fields])


def is_complete() -> Column:
    return F.col("chunks_seen") == F.col("chunk_total")


def fold_batch(chunks: DataFrame, arrival: str | Column | None = None) -> DataFrame:
    """Complete flyers only, one row each."""
    return fold_totals(first_arrivals(chunks, arrival)).filter(is_complete())


def incomplete_flyers(chunks: DataFrame, arrival: str | Column | None = None) -> DataFrame:
    """Flyers with chunks missing: ``checksum, chunks_seen, chunk_total``."""
    folded = fold_totals(first_arrivals(chunks, arrival)).filter(~is_complete())
    return folded.select("checksum", "chunks_seen", "chunk_total")
