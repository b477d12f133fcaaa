"""Duplicate detection, routing and place merging for incoming messages.

Every group here is reduced by a fixed-size aggregate (``min``, ``min_by``) before it
is shuffled, so a checksum that holds a third of all messages costs each task one
partial row. Rows get their route back by a join on the arrival id, which is unique,
never by a window over the copies.

Messages carry ``arrival`` (unique, ordered), ``checksum`` and ``source``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.functions.places import append_places, place_entry

NEW, MERGE, DROP = "new", "merge", "drop"


def lookup_stored(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """Each message with the stored flyer of its checksum, ``hits`` 0 or 1.

    ``stored`` has one row per checksum and is first cut to those of the messages, with the big
    table on the probe side. A hot checksum can only be on the message side, which an
    adaptive skew join may split.
    """
    wanted = messages.select("checksum").distinct()
    found = stored.select("checksum", "sources", F.lit(1).alias("_hit")).join(wanted, "checksum", "left_semi")
    joined = messages.join(found, "checksum", "left")
    return joined.withColumn("hits", F.coalesce("_hit", F.lit(0))).drop("_hit")


def unseen(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """Messages whose checksum is not stored."""
    return messages.join(known_among(stored, messages, "checksum"), "checksum", "left_anti")


def known(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """Messages whose checksum is stored."""
    return messages.join(known_among(stored, messages, "checksum"), "checksum", "left_semi")


def known_among(stored: DataFrame, messages: DataFrame, *keys: str) -> DataFrame:
    """The keys of ``messages`` that are stored.

    The semi join keeps the big table on the left: with a batch that is small at run time
    the batch is what gets broadcast, and the table is read once, its key columns only,
    without a shuffle. A big batch turns it into a shuffled join by itself.
    """
    wanted = messages.select(*keys).distinct()
    return stored.select(*keys).join(wanted, list(keys), "left_semi").distinct()


def first_sightings(messages: DataFrame) -> DataFrame:
    """First arrival per (checksum, place); one row per checksum for the place-less."""
    return messages.groupBy("checksum", F.col("source.placeId").alias("place_id")).agg(
        F.min("arrival").alias("arrival")
    )


def route(
    messages: DataFrame,
    stored: DataFrame | None = None,
    stored_places: DataFrame | None = None,
) -> DataFrame:
    """Every message with its ``route``: new, merge or drop.

    New: first arrival of a checksum that is not stored. Merge: first arrival of a place
    that its flyer does not have yet, whether the flyer is stored or came earlier in the
    same batch. Drop: everything else. A message without a place can be new, never merge.

    ``stored``: checksum. ``stored_places``: checksum, place_id.
    """
    sightings = first_sightings(messages)
    flyers = sightings.groupBy("checksum").agg(F.min("arrival").alias("arrival"))
    places = sightings.filter("place_id is not null")
    if stored is not None:
        flyers = unseen(flyers, stored)
    if stored_places is not None:
        places = places.join(
            known_among(stored_places, places, "checksum", "place_id"), ["checksum", "place_id"], "left_anti"
        )
    first_of_flyer = flyers.select("arrival", F.lit(True).alias("_new"))
    first_of_place = places.select("arrival", F.lit(True).alias("_place"))
    tagged = messages.join(first_of_flyer, "arrival", "left").join(first_of_place, "arrival", "left")
    which = F.when(F.col("_new"), NEW).when(F.col("_place"), MERGE).otherwise(DROP)
    return tagged.withColumn("route", which).drop("_new", "_place")


def new_flyers(messages: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The first message of every checksum that is not stored, with all its columns."""
    columns = [c for c in messages.columns if c != "checksum"]
    first = messages.groupBy("checksum").agg(
        F.min_by(F.struct(*columns), F.struct("arrival")).alias("_first")
    )
    first = first.select("checksum", "_first.*")
    return first if stored is None else unseen(first, stored)


def new_places(messages: DataFrame, stored_places: DataFrame | None = None) -> DataFrame:
    """One row per (checksum, place) not stored yet: ``checksum, place_id, entry, arrival``."""
    entries = messages.select("checksum", "arrival", place_entry(F.col("source")).alias("entry"))
    first = (
        entries.filter("entry is not null")
        .groupBy("checksum", F.col("entry.placeId").alias("place_id"))
        .agg(F.min_by("entry", F.struct("arrival")).alias("entry"), F.min("arrival").alias("arrival"))
    )
    if stored_places is None:
        return first
    return first.join(
        stored_places.select("checksum", "place_id"), ["checksum", "place_id"], "left_anti"
    )


def place_lists(places: DataFrame, order: str | Column = "arrival") -> DataFrame:
    """``checksum, sources``: entries in arrival order.

    The input has one row per (checksum, place), so a list is as long as the number of
    shops, however often each of them announced the flyer.
    """
    order = F.col(order) if isinstance(order, str) else order
    ordered = F.array_sort(
        F.collect_list(F.struct(order.alias("at"), F.col("place_id"), F.col("entry")))
    )
    return places.groupBy("checksum").agg(
        F.transform(ordered, lambda s: s["entry"]).alias("sources")
    )


def merge_places(stored: DataFrame, arriving: DataFrame) -> DataFrame:
    """Flyers (``checksum, sources``) with the places of ``arriving`` appended.

    Flyers that only appear in ``arriving`` are included. Stored entries never change.
    """
    lists = place_lists(arriving).withColumnRenamed("sources", "_arriving")
    return (
        stored.select("checksum", "sources")
        .join(lists, "checksum", "full")
        .select("checksum", append_places(F.col("sources"), F.col("_arriving")).alias("sources"))
    )


def propagate_places(offers: DataFrame, flyers: DataFrame) -> DataFrame:
    """Offers with the places of their flyer, as a materialised copy.

    The cheaper way is to leave the places in their own table and join when reading.
    """
    places = flyers.select(F.col("checksum").alias("flyer_checksum"), "sources")
    return offers.join(places, "flyer_checksum", "left")
