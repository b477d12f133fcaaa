"""Row contracts of every table and stream.

The Spark side keeps one rule the wire formats do not: a flyer's places are
always a list (``sources``), never one struct that later turns into a list.
Every field but a key is nullable, because permissive JSON parsing and rule
extraction may both leave a hole.
"""

from __future__ import annotations

from pyspark.sql import types as T


def struct(**kinds: str | T.DataType) -> T.StructType:
    """A nullable struct from ``name="type"`` pairs, without a session."""
    out = T.StructType()
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out


LOCATION = struct(lat="double", lon="double")

PLACE = struct(placeId="string", location=LOCATION, name="string", address="string")

MESSAGE = struct(filename="string", url="string", checksum="string", source=PLACE)

# A message in the queue, with the day of its arrival, under which its content is stored.
QUEUED = T.StructType([*MESSAGE.fields, T.StructField("arrived_on", T.DateType())])

OFFER = struct(
    name="string",
    price="float",
    quantity="float",
    total_quantity="float",
    count="float",
    uom="string",
    category="string",
    type="string",
    notes="string",
    validity_from="string",
    validity_to="string",
    embeddings=T.ArrayType(T.FloatType()),
)

CHUNK_RESULT = struct(
    validity_from="string",
    validity_to="string",
    offers_count="long",
    ai_model="string",
    ai_input_tokens="long",
    ai_cached_tokens="long",
    ai_output_tokens="long",
    ai_finish_reason="string",
    processed_at="string",
    processing_time_seconds="double",
    offers_data=T.ArrayType(OFFER),
)

_COUNTERS = {
    "offers_count": "long",
    "ai_input_tokens": "long",
    "ai_cached_tokens": "long",
    "ai_output_tokens": "long",
    "processing_time_seconds": "double",
}

_FLAT_PLACE = {
    "place_id": "string", "lat": "double", "lon": "double", "place_name": "string", "address": "string",
}

# What the fold needs of a chunk: counters and identifiers, no offers, no vectors.
FOLD_INPUT = struct(
    checksum="string",
    chunk_n="integer",
    chunk_total="integer",
    url="string",
    filename="string",
    **_FLAT_PLACE,
    validity_from="string",
    validity_to="string",
    **_COUNTERS,
    staged_batch="long",
)

# Which delivery of a chunk was folded: the batch that staged it.
COPY = struct(chunk_n="integer", staged_batch="long")

FOLD_OUTPUT = struct(
    checksum="string",
    url="string",
    filename="string",
    **_FLAT_PLACE,
    chunk_total="integer",
    chunks_seen="integer",
    validity_from="string",
    validity_to="string",
    **_COUNTERS,
    copies=T.ArrayType(COPY),
)

FLYERS = struct(
    checksum="string",
    url="string",
    filename="string",
    sources=T.ArrayType(PLACE),
    chunk_total="integer",
    validity_from="timestamp",
    validity_to="timestamp",
    **_COUNTERS,
    processed_at="timestamp",
)

OFFERS = struct(
    flyer_checksum="string",
    chunk_n="integer",
    offer_n="integer",
    name="string",
    price="float",
    quantity="float",
    total_quantity="float",
    count="float",
    uom="string",
    category="string",
    type="string",
    notes="string",
    validity_from="timestamp",
    validity_to="timestamp",
    validity_from_raw="string",
    validity_to_raw="string",
    embeddings=T.ArrayType(T.FloatType()),
)

# When and where a message came in: file time and name, or broker time and partition; then
# its position there. Structs compare field by field, so this is the arrival order.
ARRIVAL = struct(at="timestamp", part="string", pos="long")

# One row per flyer ever queued; ``prefix``, the first characters of the checksum, names its folder.
REGISTRY = struct(checksum="string", url="string", filename="string", prefix="string")

# One row per (flyer, shop), written once, when the shop is first seen with that flyer.
PLACES = struct(checksum="string", place_id="string", entry=PLACE, arrival=ARRIVAL, prefix="string")

# Chunk results on their way from extraction to the fold. A document that could not be
# fetched has one row without a chunk number; a chunk that could not be read, or whose result
# breaks the contract, has ``error``. ``offers_data`` holds valid offers only.
STAGING = T.StructType(
    [
        *MESSAGE.fields,
        *struct(fetch_status="string", chunk_total="integer", chunk_n="integer").fields,
        *CHUNK_RESULT.fields,
        *struct(attempts="integer", error="string").fields,
        T.StructField("rejected_offers", T.ArrayType(struct(offer=OFFER, reason="string"))),
    ]
)

# What was refused on the way: an offer that breaks the contract, a chunk or a document that failed.
REJECTS = struct(checksum="string", chunk_n="integer", reason="string", offer=OFFER)

INCOMPLETE = struct(checksum="string", chunks_seen="integer", chunk_total="integer")
