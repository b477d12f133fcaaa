"""Flyer and offer rows out of folded flyers and chunk results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.functions.dates import normalize_date
from leafmill.functions.places import place
from leafmill.schemas import FLYERS, OFFERS


def inherit(own: Column, of_flyer: Column) -> Column:
    """The offer's own date, else the flyer's."""
    return F.coalesce(own, of_flyer)


def flyer_rows(folded: DataFrame, places: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the flyer table, stamped; places from the fold, or a ``checksum, sources`` table.

    The columns in ``keep`` stay beside them.
    """
    own = place(F.col("place_id"), F.col("place_name"), F.col("address"), F.col("lat"), F.col("lon"))
    if places is None:
        rows = folded.withColumn("sources", F.when(F.col("place_id").isNotNull(), F.array(own)))
    else:
        rows = folded.join(places.select("checksum", "sources"), "checksum", "left")
    rows = rows.withColumns(
        {
            "validity_from": normalize_date(F.col("validity_from"), "first"),
            "validity_to": normalize_date(F.col("validity_to"), "last"),
            "processed_at": F.current_timestamp(),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FLYERS.fields], *keep)


def explode_offers(results: DataFrame, *keep: str) -> DataFrame:
    """One row per offer of a chunk result, keyed ``(flyer_checksum, chunk_n, offer_n)``.

    Chunks without offers give no row. ``results``: checksum, chunk_n, offers_data; the columns in ``keep``
    are repeated with every offer.
    """
    return results.select(
        F.col("checksum").alias("flyer_checksum"),
        "chunk_n",
        *keep,
        F.posexplode("offers_data").alias("offer_n", "offer"),
    ).select("flyer_checksum", "chunk_n", "offer_n", *keep, "offer.*")


def offer_rows(offers: DataFrame, flyers: DataFrame) -> DataFrame:
    """Rows of the offer table for the offers whose flyer is in ``flyers``: checksum, validity_from, validity_to."""
    dates = flyers.select(F.col("checksum").alias("flyer_checksum"), *flyer_dates())
    return dated_offers(offers.join(dates, "flyer_checksum"))


def flyer_dates() -> list[Column]:
    """The dates of a row of the flyer table, named as ``dated_offers`` wants them."""
    return [F.col("validity_from").alias("_flyer_from"), F.col("validity_to").alias("_flyer_to")]


def dated_offers(offers: DataFrame) -> DataFrame:
    """Rows of the offer table for offers that carry the dates of their flyer, see ``flyer_dates``.

    Dates are normalised on both levels before one inherits from the other; the raw
    texts are kept beside them.
    """
    own_from = normalize_date(F.col("validity_from"), "first")
    own_to = normalize_date(F.col("validity_to"), "last")
    rows = offers.withColumns(
        {
            "validity_from_raw": F.col("validity_from"),
            "validity_to_raw": F.col("validity_to"),
            "validity_from": inherit(own_from, F.col("_flyer_from")),
            "validity_to": inherit(own_to, F.col("_flyer_to")),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in OFFERS.fields])


def latest_versions(rows: DataFrame, key: str | list[str], version: str | Column) -> DataFrame:
    """Last write wins: one row per key, the one with the highest version.

    ``max_by`` keeps one candidate per task before the shuffle, so a key that is rewritten
    all the time does not pile up anywhere.
    """
    keys = [key] if isinstance(key, str) else list(key)
    version = F.col(version) if isinstance(version, str) else version
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(version)).alias("_last"))
    return last.select(*keys, "_last.*")
