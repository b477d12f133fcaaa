"""One key with a third of all rows: whole results, and no task that sees them all."""

from pyspark.sql import functions as F

from leafmill.functions.places import place
from leafmill.operators import ingest
from leafmill.operators.fold import first_arrivals
from leafmill.operators.offers import latest_versions

N = 60_000


def hot_messages(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    none = F.lit(None)
    shop = place((F.col("id") % 50).cast("string"), none.cast("string"), none.cast("string"), none.cast("double"), none.cast("double"))
    return spark.range(0, N, 1, 8).select(F.col("id").alias("arrival"), key.alias("checksum"), shop.alias("source"))


def test_routing_a_hot_flyer(spark):
    counts = {r["route"]: r["count"] for r in ingest.route(hot_messages(spark)).groupBy("route").count().collect()}
    assert counts == {"new": N * 2 // 3 + 1, "merge": 49, "drop": N // 3 - 50}


def test_places_of_a_hot_flyer(spark):
    lists = ingest.place_lists(ingest.new_places(hot_messages(spark))).filter("checksum = 'hot'").first()
    assert [s["placeId"] for s in lists["sources"]][:3] == ["0", "3", "6"] and len(lists["sources"]) == 50


def test_copies_are_reduced_before_the_shuffle(spark):
    """The biggest shuffle of each keyed reduction carries at most one row per key and task."""
    rows = spark.range(0, N, 1, 8).select(F.lit("hot").alias("checksum"), F.lit(0).alias("chunk_n"), F.col("id").alias("at"))
    for reduced in (first_arrivals(rows, "at"), latest_versions(rows, ["checksum", "chunk_n"], "at")):
        reduced.collect()
        plan = reduced._jdf.queryExecution().executedPlan().toString()
        # A partial aggregate sits below the exchange: nothing but its output is shuffled.
        below = plan.split("Exchange hashpartitioning", 1)[1]
        assert "partial_" in below
    assert first_arrivals(rows, "at").first()["at"] == 0
    assert latest_versions(rows, ["checksum", "chunk_n"], "at").first()["at"] == N - 1
