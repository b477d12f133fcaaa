"""Intake scenarios, and merging as a property."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from leafmill.functions.places import append_places, as_list, has_place, place_entry
from leafmill.operators import ingest
from leafmill.schemas import PLACE


def place(pid, name=None, address=None, lat=None, lon=None):
    return (pid, None if lat is None and lon is None else (lat, lon), name, address)


def messages(spark, *rows):
    """rows: (arrival, checksum, place or None)"""
    data = [(a, f"{c}.pdf", f"u/{c}", c, p) for a, c, p in rows]
    schema = "arrival bigint, filename string, url string, checksum string, source " + PLACE.simpleString()
    return spark.createDataFrame(data, schema)


def routes(frame):
    return {r["arrival"]: r["route"] for r in frame.collect()}


def test_routes(spark):
    msgs = messages(
        spark,
        (1, "a", place("p1")), (2, "a", place("p2")), (3, "a", place("p1")),  # in one batch
        (4, "s", place("p1")), (5, "s", place("p9")), (6, "s", place(None)),  # stored flyer
        (7, "n", None), (8, "n", None),  # unseen, no place
    )
    stored = spark.createDataFrame([("s",)], "checksum string")
    places = spark.createDataFrame([("s", "p1")], "checksum string, place_id string")
    assert routes(ingest.route(msgs, stored, places)) == {
        1: "new", 2: "merge", 3: "drop", 4: "drop", 5: "merge", 6: "drop", 7: "new", 8: "drop",
    }


def test_both_places_of_a_new_flyer_are_kept(spark):
    msgs = messages(spark, (2, "a", place("p2")), (1, "a", place("p1")), (3, "a", place("p2")))
    assert ingest.new_flyers(msgs).count() == 1
    lists = ingest.place_lists(ingest.new_places(msgs)).first()
    assert [s["placeId"] for s in lists["sources"]] == ["p1", "p2"]


def test_entry_rules(spark):
    rows = messages(
        spark,
        (1, "a", place("p", "", "  ", 1.5, None)),
        (2, "a", place(None, "n", "x", 1.0, 2.0)),
        (3, "a", place("p", "n", "x", 1.0, 2.0)),
        (4, "a", None),
    )
    got = {r["arrival"]: r["e"] for r in rows.select("arrival", place_entry(F.col("source")).alias("e")).collect()}
    assert got[1].asDict() == {"placeId": "p", "location": None, "name": None, "address": None}
    assert got[2] is None and got[4] is None
    assert got[3].asDict(True) == {"placeId": "p", "location": {"lat": 1.0, "lon": 2.0}, "name": "n", "address": "x"}


def test_scalar_list_and_membership(spark):
    rows = messages(spark, (1, "a", place("p1")), (2, "a", None))
    listed = rows.select("arrival", as_list(F.col("source")).alias("l"))
    found = listed.select(
        "arrival", F.size("l").alias("n"), has_place(F.col("l"), F.lit("p1")).alias("hit"),
        has_place(F.col("l"), F.lit(None).cast("string")).alias("null_hit"),
        has_place(F.lit(None).cast(listed.schema["l"].dataType), F.lit("p1")).alias("null_list"),
    )
    assert [tuple(r) for r in found.orderBy("arrival").collect()] == [
        (1, 1, True, False, False), (2, 0, False, False, False),
    ]


def test_merge_keeps_stored_entries(spark):
    stored = spark.createDataFrame([("a", [place("p1", "old")])], f"checksum string, sources array<{PLACE.simpleString()}>")
    msgs = messages(spark, (1, "a", place("p1", "new")), (2, "a", place("p2", "two")), (3, "b", place("p3", "b")))
    merged = ingest.merge_places(stored, ingest.new_places(msgs))
    got = {r["checksum"]: [(s["placeId"], s["name"]) for s in r["sources"]] for r in merged.collect()}
    assert got == {"a": [("p1", "old"), ("p2", "two")], "b": [("p3", "b")]}


@settings(max_examples=1, deadline=None)
@given(st.data())
def test_merging_is_idempotent_and_order_stable(spark, data):
    """Many random cases go through Spark as rows of one frame, not one job each."""
    ids = st.lists(st.sampled_from("abcdef"), max_size=6, unique=True)
    cases = data.draw(st.lists(st.tuples(ids, ids), min_size=40, max_size=60))
    kind = f"array<{PLACE.simpleString()}>"
    frame = spark.createDataFrame(
        [(i, [place(x) for x in s], [place(x) for x in a]) for i, (s, a) in enumerate(cases)],
        f"i int, s {kind}, a {kind}",
    )
    once = frame.withColumn("m", append_places(F.col("s"), F.col("a")))
    twice = once.withColumn("m2", append_places(F.col("m"), F.col("a")))
    for row in twice.collect():
        stored, arriving = cases[row["i"]]
        expected = stored + [x for x in arriving if x not in stored]
        assert [p["placeId"] for p in row["m"]] == expected
        assert row["m2"] == row["m"]
