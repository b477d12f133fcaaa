"""The eleven dashboard reports.

Null order, ties and the null group are spelled out, because Spark's defaults differ
from those of the store the reports come from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Bucket width, least bucket size, rows of a top list, buckets of a date axis.
PRICE_STEP = 5.0
PRICE_MIN_COUNT = 5
TOP = 10
MAX_DATE_BUCKETS = 100

# Buckets of a date axis that one row is unfolded to.
AXIS_BLOCK = 1_000

# Candidate units of the date axis, with their seconds.
DATE_UNITS = (
    ("second", 1),
    ("minute", 60),
    ("hour", 3_600),
    ("day", 86_400),
    ("week", 604_800),
    ("month", 2_592_000),
    ("year", 31_536_000),
)


def top_values(rows: DataFrame, key: str, k: int = TOP) -> DataFrame:
    """The most common values of a column; ties in key order, a null key is a group."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.col(key).asc_nulls_last()).limit(k)


def top_categories(offers: DataFrame) -> DataFrame:
    return top_values(offers, "category")


def top_types(offers: DataFrame) -> DataFrame:
    return top_values(offers, "type")


def _with_share(counts: DataFrame) -> DataFrame:
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("share", F.round(F.lit(100.0) * F.col("n") / total, 4))


def offers_by_place(offers: DataFrame, places: DataFrame) -> DataFrame:
    """Offers per shop name, with the share in percent: ``place, n, share``.

    An offer counts once for every distinct name its flyer was seen at, and once under
    null when there is none. Offers are counted per flyer before the join, so it joins
    flyers with shops, not offers with shops. ``places``: checksum, place_name.
    """
    per_flyer = offers.groupBy("flyer_checksum").agg(F.count("*").alias("offers"))
    names = places.select(F.col("checksum").alias("flyer_checksum"), F.col("place_name").alias("place"))
    joined = per_flyer.join(names.filter("place is not null").distinct(), "flyer_checksum", "left")
    return _with_share(joined.groupBy("place").agg(F.sum("offers").alias("n")))


def offers_by_source(offers: DataFrame) -> DataFrame:
    """The same report where the places are stored in the offer rows (``sources``)."""
    names = F.array_distinct(F.filter(F.col("sources.name"), lambda name: name.isNotNull()))
    exploded = offers.select(F.explode_outer(names).alias("place"))
    return _with_share(exploded.groupBy("place").agg(F.count("*").alias("n")))


def flyer_count(flyers: DataFrame) -> DataFrame:
    return flyers.agg(F.count("*").alias("flyers"))


def average(flyers: DataFrame, column: str, name: str) -> DataFrame:
    return flyers.agg(F.avg(column).alias(name))


def average_offers(flyers: DataFrame) -> DataFrame:
    return average(flyers, "offers_count", "avg_offers")


def total_offers(flyers: DataFrame) -> DataFrame:
    return flyers.agg(F.sum("offers_count").cast("bigint").alias("total_offers"))


def average_seconds(flyers: DataFrame) -> DataFrame:
    return average(flyers, "processing_time_seconds", "avg_seconds")


def average_input_tokens(flyers: DataFrame) -> DataFrame:
    return average(flyers, "ai_input_tokens", "avg_tokens_in")


def average_output_tokens(flyers: DataFrame) -> DataFrame:
    return average(flyers, "ai_output_tokens", "avg_tokens_out")


def price_buckets(offers: DataFrame, step: float = PRICE_STEP, more_than: int = PRICE_MIN_COUNT) -> DataFrame:
    """Offers per price bucket, buckets with few offers left out, ascending."""
    bucket = F.floor(F.col("price") / step) * F.lit(step)
    counts = offers.groupBy(bucket.cast("double").alias("bucket")).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > more_than).orderBy(F.col("bucket").asc_nulls_last())


def _unit_for(seconds: Column) -> Column:
    *short, (longest, _) = DATE_UNITS
    choice = F.when(seconds < 0, F.lit(longest))
    for unit, size in short:
        choice = choice.when(seconds < size * MAX_DATE_BUCKETS, F.lit(unit))
    return choice.otherwise(F.lit(longest))


def _step(unit: Column, times: int = 1) -> Column:
    def n(name: str) -> Column:
        return F.when(unit == name, times).otherwise(0)

    return F.make_interval(n("year"), n("month"), n("week"), n("day"), n("hour"), n("minute"), n("second"))


def date_histogram(offers: DataFrame, column: str = "validity_from", unit: str | None = None) -> DataFrame:
    """Offers per start date, every bucket of the range present, ``n`` null where empty.

    Without a unit the shortest one with at most a hundred buckets over the range is taken.
    The range is one row; the empty buckets are made from it, not from the offers, in blocks that are
    spread over the tasks, as seconds over years are hundreds of millions of buckets.
    """
    dated = offers.select(F.col(column).cast("timestamp").alias("at")).filter("at is not null")
    span = dated.agg(F.min("at").alias("low"), F.max("at").alias("high"))
    if unit is None:
        chosen = _unit_for(F.unix_timestamp("high") - F.unix_timestamp("low"))
        unit_of = span.select(chosen).scalar()
    else:
        unit_of = F.lit(unit)
    counts = dated.groupBy(F.call_function("date_trunc", unit_of, F.col("at")).alias("bucket")).agg(
        F.count("*").alias("n")
    )
    ends = span.filter("low is not null").select(
        F.call_function("date_trunc", unit_of, F.col("low")).alias("low"), "high"
    )
    blocks = ends.select(F.explode(F.sequence("low", "high", _step(unit_of, AXIS_BLOCK))).alias("first"), "high").repartition("first")
    last = F.least("high", F.col("first") + _step(unit_of, AXIS_BLOCK - 1))
    spine = blocks.select(F.explode(F.sequence("first", last, _step(unit_of))).alias("bucket"))
    return spine.join(counts, "bucket", "left").orderBy("bucket")
