"""Search against brute force on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.functions import text as texts
from leafmill.functions.text import stem, without_elision
from leafmill.operators import search
from leafmill.plans import dashboards
from leafmill.session import scratch_dir


def test_neighbours_with_blocks_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(200, 8)).astype(np.float32)
    asked = rng.normal(size=(7, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "row_id bigint, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id bigint, query_vector array<double>")
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(search, "TILE_ROWS", 40)
    monkeypatch.setattr(search, "STRIP", 2)
    got = {(r["query_id"], r["rank"]): r["row_id"] for r in search.nearest(rows, queries, 4).collect()}
    unit = base.astype(float) / np.linalg.norm(base.astype(float), axis=1, keepdims=True)
    for q, v in enumerate(asked):
        sims = np.round(unit @ (v / np.linalg.norm(v)), 6)
        best = sorted(range(200), key=lambda i: (-sims[i], i))[:4]
        assert [got[(q, n + 1)] for n in range(4)] == best


def test_cells_recall_and_folders(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(20, 16))
    data = centers[rng.integers(20, size=3_000)] + rng.normal(size=(3_000, 16)) * 0.5
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "row_id bigint, embedding array<float>").repartition(4)
    queries = spark.createDataFrame([(i, (data[i * 29] + 0.1).tolist()) for i in range(100)], "query_id bigint, query_vector array<double>")
    exact = {(r["query_id"], r["row_id"]) for r in search.nearest(rows, queries, 10).collect()}
    index = search.store_cells(rows, scratch_dir(spark, "test-cells"), 20)
    assert index.rows(spark).count() == 3_000
    found = {(r["query_id"], r["row_id"]) for r in search.nearest_in_cells(index, queries, 10, probes=5).collect()}
    assert len(exact) == 1_000 and len(exact & found) >= 0.9 * len(exact)
    whole = {(r["query_id"], r["row_id"]) for r in search.nearest_in_cells(index, queries, 10, probes=20).collect()}
    assert whole == exact
    one = search.nearest_in_cells(index, queries.filter("query_id = 3"), 10, probes=2)
    scan = next(line for line in one._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in line)
    assert "cell" in scan.split("PartitionFilters")[1].split("]")[0]


def test_no_queries_give_no_rows(spark):
    rows = spark.createDataFrame([(1, [1.0])], "row_id bigint, embedding array<float>")
    none = spark.createDataFrame([], "query_id bigint, query_vector array<double>")
    assert search.nearest(rows, none, 3).count() == 0


def km(a, b):
    (lat1, lon1), (lat2, lon2) = a, b
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))


def test_candidates_follow_the_answer(spark):
    rng = np.random.default_rng(5)
    shops = [(float(a), float(o)) for a, o in zip(rng.normal(45.5, 0.3, 4_000), rng.normal(9.2, 0.3, 4_000))]
    rows = spark.createDataFrame(shops, "lat double, lon double")
    points = spark.createDataFrame([(j, 45.3 + 0.1 * j, 9.0 + 0.1 * j) for j in range(5)], "point_id int, point_lat double, point_lon double")
    answer = search.near_points(rows, points, 10.0).count()
    assert answer > 500 and search.candidate_pairs(rows, points, 10.0).count() <= 3 * answer


@pytest.mark.parametrize("radius", [50.0, 900.0, 9_000.0, 25_000.0])
def test_near_points_at_poles_and_date_line(spark, radius):
    rng = np.random.default_rng(2)
    shops = [(float(a), float(o)) for a, o in zip(rng.uniform(-90, 90, 150), rng.uniform(-180, 180, 150))]
    shops += [(0.0, 179.9), (89.9, 10.0), (89.8, -170.0), (45.0, -179.95), (10.0, 10.0)]
    points = [(0.0, -179.9), (90.0, 0.0), (45.0, 179.95), (10.1, 10.1), (-60.0, 30.0)]
    rows = spark.createDataFrame([(i, *s) for i, s in enumerate(shops)], "i int, lat double, lon double")
    asked = spark.createDataFrame([(j, *p) for j, p in enumerate(points)], "point_id int, point_lat double, point_lon double")
    got = {(r["i"], r["point_id"]) for r in search.near_points(rows, asked, radius).collect()}
    assert got == {(i, j) for i, s in enumerate(shops) for j, p in enumerate(points) if km(s, p) <= radius}
    lat, lon = points[3]
    single = {r["i"] for r in search.within_km(rows, lat, lon, radius).collect()}
    assert single == {i for i, s in enumerate(shops) if km(s, points[3]) <= radius}


def test_italian_terms(spark):
    words = ["dell'acqua", "l’olio", "formaggi", "formaggio", "città", "pane", "mozzarelle", "mozzarella"]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r["t"] for r in rows.select(stem(without_elision(F.col("w"))).alias("t")).collect()]
    assert got == ["acqua", "olio", "formagg", "formagg", "città", "pane", "mozzarell", "mozzarell"]


def test_rank_finds_the_exact_text(spark):
    docs = spark.createDataFrame(
        [(1, "latte fresco intero"), (2, "biscotti al latte"), (3, "pane"), (4, "biscotti al latte")], "doc_id bigint, text string"
    )
    stop = list(texts.ITALIAN_STOP_WORDS)
    asked = spark.createDataFrame([(1, "il biscotto con latte")], "query_id bigint, query string")
    best = search.text_rank(search.term_index(docs, stop), F.lit(4), asked, 3, stop)
    assert [r["doc_id"] for r in best.orderBy("rank").collect()] == [2, 4, 1]


def test_valid_per_day_counts_open_and_empty_days(spark):
    rows = spark.sql(
        "select timestamp'2025-06-01' as validity_from, timestamp'2025-06-03' as validity_to union all "
        "select timestamp'2025-06-03', timestamp'2025-06-03' union all select null, timestamp'2025-06-03' union all "
        "select timestamp'2025-06-09', timestamp'2025-06-01'"
    )
    days = spark.sql("select explode(sequence(date'2025-05-31', date'2025-06-04')) as day")
    got = [r["n"] for r in search.valid_per_day(rows, days).orderBy("day").collect()]
    assert got == [0, 1, 1, 2, 0]


def test_date_axis_units_and_empty_buckets(spark):
    rows = spark.sql("select explode(array(timestamp'2025-06-01', timestamp'2025-06-01', timestamp'2025-06-04', null)) as validity_from")
    got = [(str(r["bucket"])[:10], r["n"]) for r in dashboards.date_histogram(rows, unit="day").collect()]
    assert got == [("2025-06-01", 2), ("2025-06-02", None), ("2025-06-03", None), ("2025-06-04", 1)]
    hours = dashboards.date_histogram(rows).collect()
    assert len(hours) == 73 and hours[1]["n"] is None
    seconds = dashboards.date_histogram(rows, unit="second")
    assert seconds.count() == 3 * 86_400 + 1 == seconds.select("bucket").distinct().count()
    long = spark.sql("select explode(array(timestamp'1900-01-31', timestamp'2025-06-04')) as validity_from")
    months = [str(r["bucket"])[:10] for r in dashboards.date_histogram(long, unit="month").collect()]
    assert months == [f"{y}-{m:02}-01" for y in range(1900, 2026) for m in range(1, 13)][: 125 * 12 + 6]
    none = rows.filter("validity_from > timestamp'2030-01-01'")
    assert dashboards.date_histogram(none).count() == 0


def test_null_keys_and_ties(spark):
    rows = spark.createDataFrame([(c,) for c in ["b", "b", "a", "a", None, None, "c"]], "category string")
    got = [(r["category"], r["n"]) for r in dashboards.top_values(rows, "category", 3).collect()]
    assert got == [("a", 2), ("b", 2), (None, 2)]
