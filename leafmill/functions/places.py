"""Places (shops): building entries, membership, ordered merge."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leafmill.schemas import LOCATION, PLACE


def blank_to_null(text: Column) -> Column:
    return F.when(F.length(F.trim(text)) > 0, text)


def location(lat: Column, lon: Column) -> Column:
    """Location struct, null unless both coordinates are there."""
    return F.when(
        lat.isNotNull() & lon.isNotNull(),
        F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon")),
    ).otherwise(F.lit(None).cast(LOCATION))


def place(place_id: Column, name: Column, address: Column, lat: Column, lon: Column) -> Column:
    """Place struct from flat columns, kept even when every part is null."""
    return F.struct(
        place_id.alias("placeId"),
        location(lat, lon).alias("location"),
        name.alias("name"),
        address.alias("address"),
    )


def place_entry(source: Column) -> Column:
    """The entry to store for an event: null without an id, blank texts left out."""
    built = place(
        source["placeId"], blank_to_null(source["name"]), blank_to_null(source["address"]),
        source["location"]["lat"], source["location"]["lon"],
    )
    return F.when(source["placeId"].isNotNull(), built).otherwise(F.lit(None).cast(PLACE))


def flatten_place(source: Column) -> dict[str, Column]:
    """Five flat columns of a place struct; nulls all the way down when it is null."""
    return {
        "place_id": source["placeId"],
        "lat": source["location"]["lat"],
        "lon": source["location"]["lon"],
        "place_name": source["name"],
        "address": source["address"],
    }


def as_list(source: Column) -> Column:
    """A stored scalar source as a list: null becomes the empty list."""
    return F.when(source.isNull(), F.array().cast(f"array<{PLACE.simpleString()}>")).otherwise(
        F.array(source)
    )


def has_place(sources: Column, place_id: Column) -> Column:
    """Is the id among the stored places? False for a null id, list or item."""
    hit = F.exists(sources, lambda s: F.coalesce(s["placeId"] == place_id, F.lit(False)))
    return F.coalesce(hit, F.lit(False))


def append_places(stored: Column, arriving: Column) -> Column:
    """Stored places unchanged, then the arriving ones whose id is not yet there.

    ``arriving`` holds one entry per id, in arrival order.
    """
    empty = F.array().cast(f"array<{PLACE.simpleString()}>")
    kept = F.coalesce(stored, empty)
    new = F.filter(F.coalesce(arriving, empty), lambda e: ~has_place(kept, e["placeId"]))
    return F.concat(kept, new)


def searchable_place(source: Column) -> Column:
    """The parts of a place that queries may use: the address is for display only."""
    return source.dropFields("address")
