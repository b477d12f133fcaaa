"""What the plans must look like."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"

IN_JVM = [
    "q_top_categories", "q_offers_by_place", "q_price_buckets", "q_start_date_histogram", "ingest_route",
    "ingest_merge_places", "ingest_place_entry", "chunk_split", "date_normalise", "json_parse", "offers_flatten",
    "pack_arithmetic", "fold_batch", "fold_messy", "valid_per_day", "geo_near_points",
]


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@pytest.mark.parametrize("name", IN_JVM)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_top_lists_use_top_k(spark):
    for name in ("q_top_categories", "q_top_types"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_ranking_is_limited_before_the_shuffle(spark):
    for name in ("text_rank", "knn_exact"):
        text = plan(spark, name)
        assert "WindowGroupLimit" in text and "Partial" in text, name


def test_scores_are_added_up_in_their_buckets(spark):
    ranked = plan(spark, "text_rank").split("WindowGroupLimit", 2)[2]
    below = ranked.split("HashAggregate", 2)[2]
    assert "Exchange hashpartitioning" not in ranked and "Bucketed: true" in below and "BroadcastHashJoin" in below
    lazy = plan(spark, "knn_exact")
    assert "FlatMapCoGroupsInArrow" in lazy and "embedding" in lazy


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "numeric_range")
    assert "GreaterThanOrEqual(p_retailprice,910.5)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in text
    assert "EqualTo(p_type,PROMO)" in plan(spark, "exact_match")


def explained(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_batch_reads_the_content_of_its_days(spark):
    from pyspark.sql import functions as F

    from leafmill.operators.chunking import acquire
    from leafmill.session import scratch_dir

    path = scratch_dir(spark, "test-days")
    rows = spark.range(2_000).selectExpr("concat('u/', id) as url", "cast(repeat('x', 500) as binary) as content", "date_add(date'2024-01-01', cast(id % 50 as int)) as arrived_on")
    rows.repartition("arrived_on").write.partitionBy("arrived_on").parquet(path)
    asked = rows.filter("url like 'u/10%'").select("url", "arrived_on", F.sha2("content", 256).alias("checksum"))
    messages = spark.createDataFrame(asked.limit(20).collect(), asked.schema).persist()
    messages.count()
    fetched = acquire(messages, spark.read.parquet(path), ["url", "arrived_on"])
    text = explained(fetched)
    assert text.count("dynamicpruning") >= 2 and "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    for scan in text.split("FileScan")[1:]:  # nothing above a scan of the content but the join
        assert "dynamicpruning" in scan.split("\n")[0]
    assert "content" not in "".join(line for line in text.split("\n") if "Exchange hashpartitioning" in line)
    assert {r["fetch_status"] for r in fetched.collect()} == {"ok"}
    messages.unpersist()


def test_a_text_is_cut_into_pages_once(spark):
    from leafmill.operators.chunking import split_chunks

    text = "\n".join(str(n) for n in range(12))
    chunks = split_chunks(spark.createDataFrame([("a", text)], "checksum string, content string"), outer=True)
    plan = explained(chunks)
    assert plan.count("split(") == 1 and "slice(lambda" in plan
    assert [(r["chunk_n"], len(r["chunk"])) for r in chunks.collect()] == [(0, 5), (1, 5), (2, 2)]


def test_a_batch_reads_the_registry_of_its_prefixes(spark):
    from leafmill import schemas
    from leafmill.session import scratch_dir, streaming_session
    from leafmill.sources import tables
    from leafmill.streaming import flow

    store = flow.Store(scratch_dir(spark, "test-registry"))
    store.create(spark)
    known = spark.range(4_000).selectExpr("sha2(cast(id as string), 256) as checksum", "'u' as url", "'f' as filename", "'' as prefix")
    known = known.withColumn("prefix", flow._prefix(store))
    tables.commit_batch(flow._by_prefix(known, schemas.REGISTRY), store.path("registry"), 0, "prefix")
    messages = known.filter("prefix in ('a', 'b')").limit(30).select("checksum", "prefix").persist()
    messages.count()
    found = flow.registered(spark, store, messages, 1)
    assert "dynamicpruning" in explained(found) and "SortMergeJoin" not in explained(found)
    assert found.count() == 30
    messages.unpersist()
    # Too large to broadcast: a bloom filter of the batch goes ahead of the shuffle.
    session = streaming_session(spark)
    for key, value in (
        ("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1"),
        ("spark.sql.optimizer.dynamicPartitionPruning.enabled", "false"),
    ):
        session.conf.set(key, value)
    many = session.read.parquet(store.path("registry")).filter("checksum > '8'").select("checksum", "prefix")
    large = flow.registered(session, store, many, 1)
    assert "might_contain" in explained(large)
    assert large.count() == many.count()


def test_copies_reach_the_state_as_a_row_a_task(spark):
    from pyspark.sql import functions as F

    from leafmill import schemas
    from leafmill.streaming.fold import first_per_task

    copies = spark.range(0, 1_000_000, 1, 8).select(
        *[(F.lit("hot") if f.name == "checksum" else F.lit(0) if f.name == "chunk_n" else F.col("id") if f.name == "staged_batch"
           else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.FOLD_INPUT.fields]
    )
    left = [r["staged_batch"] for r in first_per_task(copies).collect()]
    assert len(left) == 8 and min(left) == 0


def test_routing_needs_no_window(spark):
    assert "Window" not in plan(spark, "ingest_route")


def test_rule_offers_spreads_its_rows(spark):
    """A table of one small file is read by one task; the slow reading must not stay in it."""
    assert "REPARTITION_BY_COL" in plan(spark, "rule_offers")
