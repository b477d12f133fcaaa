"""The whole flow: routing over two waves, failures, replays."""

import glob
import json
import sys
import time

import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from leafmill.operators.embedding import HashingEmbedder, embed_offers
from leafmill.operators.extraction import Retry, call_with_retry, extract_with
from leafmill.schemas import OFFERS
from leafmill.session import scratch_dir, streaming_session
from leafmill.sources import tables
from leafmill.sources.messages import read_message_stream
from leafmill.streaming import flow

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES = {
    "u/a": "\n".join(f"Prodotto {i} 100g - {i},50€" for i in range(1, 8)),
    "u/b": "Latte 1l - 1,20€ - valida dal 01/07 al 03/07",
    "u/c": "changed since it was announced",
}
FAIL = {"on": False}


def message(sha, url, pid):
    source = {"placeId": pid, "name": f"Shop {pid}", "location": {"lat": 41.0, "lon": 12.5}} if pid else None
    return json.dumps({"filename": url, "url": url, "checksum": sha, "source": source})


def read_chunk(lines):
    if any("boom" in line for line in lines):
        raise RuntimeError("boom")
    offers = [
        {"name": line.split(" - ")[0], "category": "Bevande", "price": float(line.split("€")[0].split()[-1].replace(",", ".")),
         "validity_from": "2025-07-01" if "dal" in line else None}
        for line in lines
    ]
    empty = dict.fromkeys(
        ("quantity", "total_quantity", "count", "uom", "type", "notes", "validity_from", "validity_to", "embeddings")
    )
    return {
        "validity_from": "2025-06-28", "validity_to": "giugno 2025", "ai_input_tokens": len(lines),
        "ai_output_tokens": 1, "offers_data": [empty | offer for offer in offers],
    }


def extract(chunks):
    return embed_offers(extract_with(chunks, read_chunk, retry=Retry(attempts=2, first_delay=0.0)), HashingEmbedder(8))


def run(spark, session, store, content):
    inbox = read_message_stream(session, store.path("inbox"), 1)
    flow.finish(flow.start_intake(inbox, store, once=True))
    flow.finish(flow.start_extraction(flow.queue_stream(session, store), content, extract, store, 2, once=True))
    flow.finish(flow.start_fold(flow.staged_chunks(session, store), store, once=True))


def test_new_merge_drop_and_failures(spark):
    session = streaming_session(spark, drain=True)
    store = flow.Store(scratch_dir(spark, "test-flow"))
    store.create(session)
    pages = PAGES | {"u/d": "boom"}
    content = session.createDataFrame([(u, t.encode()) for u, t in pages.items()], "url string, content binary")
    sha = {r["url"]: r["h"] for r in content.select("url", F.sha2("content", 256).alias("h")).collect()}

    def announce(*rows):
        spark.createDataFrame([(m,) for m in rows], "value string").coalesce(1).write.mode("append").text(store.path("inbox"))

    announce(
        message(sha["u/a"], "u/a", "p1"), message(sha["u/a"], "u/a", "p2"), message(sha["u/b"], "u/b", None),
        message("f" * 64, "u/c", "p1"), message("e" * 64, "u/gone", "p1"), message(sha["u/d"], "u/d", "p1"), "not json",
    )
    run(spark, session, store, content)
    flyers = {r["checksum"]: r for r in flow.flyers_view(spark, store).collect()}
    assert set(flyers) == {sha["u/a"], sha["u/b"]}
    assert [s["placeId"] for s in flyers[sha["u/a"]]["sources"]] == ["p1", "p2"]
    assert flyers[sha["u/b"]]["sources"] is None
    assert (flyers[sha["u/a"]]["chunk_total"], flyers[sha["u/a"]]["offers_count"]) == (2, 7)
    assert str(flyers[sha["u/a"]]["validity_to"]) == "2025-06-30 00:00:00"

    offers = flow.offers_view(spark, store)
    assert offers.count() == 8
    own = offers.filter("name like 'Latte%'").first()
    assert str(own["validity_from"]) == "2025-07-01 00:00:00" and str(own["validity_to"]) == "2025-06-30 00:00:00"
    assert len(own["embeddings"]) == 8
    failures = {r["url"]: r["why"] for r in store.staging(spark).select(
        "url", F.coalesce("error", F.nullif(F.col("fetch_status"), F.lit("ok"))).alias("why")).filter("why is not null").collect()}
    assert failures == {"u/c": "checksum mismatch", "u/gone": "missing", "u/d": "RuntimeError: boom"}

    # Second wave: a known flyer at a new shop, at a known shop, and nothing else to do.
    announce(message(sha["u/a"], "u/a", "p3"), message(sha["u/a"], "u/a", "p1"), message(sha["u/b"], "u/b", None))
    run(spark, session, store, content)
    flyers = {r["checksum"]: r for r in flow.flyers_view(spark, store).collect()}
    assert [s["placeId"] for s in flyers[sha["u/a"]]["sources"]] == ["p1", "p2", "p3"]
    offers = flow.offers_view(spark, store)
    assert offers.count() == 8
    assert {tuple(s["placeId"] for s in r["sources"]) for r in offers.filter("sources is not null").collect()} == {("p1", "p2", "p3")}


def test_failed_sink_is_replayed(spark):
    root = scratch_dir(spark, "test-replay")
    session = streaming_session(spark, drain=True)
    spark.range(10).selectExpr("cast(id as string) as flyer_checksum").coalesce(1).write.parquet(f"{root}/in")
    schema = OFFERS["flyer_checksum"]

    def write(batch, batch_id):
        tables.write_batch(batch, f"{root}/out", batch_id)
        if FAIL["on"]:
            raise OSError("sink is down")

    def start():
        stream = session.readStream.schema(f"{schema.name} string").parquet(f"{root}/in")
        return (
            stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True).start()
        )

    FAIL["on"] = True
    with pytest.raises(Exception, match="sink is down"):
        flow.finish(start())
    FAIL["on"] = False
    flow.finish(start())
    assert spark.read.parquet(f"{root}/out").count() == 10


def test_a_reader_can_leave_out_its_own_batch(spark):
    path = scratch_dir(spark, "test-before")
    rows = spark.range(3).selectExpr("cast(id as string) as checksum")
    tables.write_batch(rows, path, 0)
    tables.write_batch(rows, path, 1)
    assert tables.read_batches(spark, path, rows.schema, before=1).count() == 3
    assert tables.read_latest(spark, path, rows.schema.add("v", "string"), "checksum").count() == 3


def test_a_batch_is_committed_once(spark):
    path = scratch_dir(spark, "test-commit")
    rows = spark.range(3).selectExpr("cast(id as string) as checksum", "cast(id % 2 as string) as prefix")
    assert tables.commit_batch(rows, path, 0, "prefix")
    assert not tables.commit_batch(rows.union(rows), path, 0, "prefix")
    broken = rows.withColumn("checksum", F.raise_error(F.lit("no space")).cast("string"))
    with pytest.raises(Exception, match="no space"):
        tables.commit_batch(broken, path, 1)
    assert not tables.is_committed(spark, path, 1)
    assert tables.read_batches(spark, path, rows.schema).count() == spark.read.parquet(path).count() == 3
    assert tables.commit_batch(rows, path, 1, "prefix") and tables.read_batches(spark, path, rows.schema).count() == 6


def test_upserts_rewrite_what_they_touch(spark):
    path = scratch_dir(spark, "test-upsert")
    schema = spark.createDataFrame([], "checksum string, n long").schema

    def rows(keys, n):
        return spark.createDataFrame([(str(k), n) for k in keys], schema)

    tables.create_if_absent(spark, path, schema)
    assert tables.read_current(spark, path, schema).count() == 0
    for batch_id, keys in enumerate((range(40), [3], [3, 50], [])):
        assert tables.upsert_batch(rows(keys, batch_id), path, schema, "checksum", batch_id, 8)
        assert not tables.upsert_batch(rows(range(99), -1), path, schema, "checksum", batch_id, 8)
    current = tables.read_current(spark, path, schema)
    assert {int(r["checksum"]): r["n"] for r in current.collect()} == dict.fromkeys(range(40), 0) | {3: 2, 50: 2}
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    assert len(spark.read.parquet(f"{path}/batch_id=1").select("part").distinct().collect()) == 1
    old = tables.superseded(spark, path)
    assert 1 <= len(old) <= 3 and all("part=" in folder for folder in old)


def test_replayed_intake_and_extraction_change_nothing(spark):
    session = streaming_session(spark, drain=True)
    store = flow.Store(scratch_dir(spark, "test-replayed"))
    store.create(session)
    from leafmill.sources.messages import parse_messages

    rows = spark.createDataFrame([(message(c * 64, f"u/{c}", "p"),) for c in "ab"], "value string")
    batch = parse_messages(rows).withColumns({"at": F.current_timestamp(), "part": F.lit("f")})
    content = spark.createDataFrame([], "url string, content binary")
    calls = []

    def counted(chunks):
        calls.append(1)
        return extract(chunks)

    queued = spark.createDataFrame([], "checksum string")
    for _ in range(2):
        flow.ingest_batch(batch, 0, store)
        queued = flow.parse_messages(spark.read.text(store.path("queue/batch_id=0")), schema=flow.schemas.QUEUED)
        flow.extract_batch(queued, 0, content, counted, store)
    assert len(calls) == 1 and queued.count() == 2 and {str(r["arrived_on"]) for r in queued.collect()} != {"None"}
    flow.ingest_batch(batch, 1, store)
    assert spark.read.text(store.path("queue/batch_id=1")).count() == 0
    registry = tables.read_batches(spark, store.path("registry"), flow.schemas.REGISTRY)
    assert sorted((r["checksum"][0], r["prefix"]) for r in registry.collect()) == [("a", "a"), ("b", "b")]
    reasons = [r["reason"] for r in tables.read_batches(spark, store.path("rejects"), flow.schemas.REJECTS).collect()]
    assert reasons == ["missing", "missing"]


def test_a_standing_query_gives_up_on_a_flyer(spark):
    import time

    session = streaming_session(spark)
    store = flow.Store(scratch_dir(spark, "test-give-up"))
    store.create(session)
    staging = flow.schemas.STAGING
    row = dict.fromkeys(staging.fieldNames()) | {"checksum": "a", "chunk_n": 0, "chunk_total": 2, "fetch_status": "ok"}
    tables.commit_batch(spark.createDataFrame([tuple(row.values())], staging), store.path("staging"), 0)
    running = flow.start_fold(flow.staged_chunks(session, store), store, give_up_ms=2_000)
    try:
        gone, until = [], time.time() + 90
        while not gone and time.time() < until:
            time.sleep(1)
            assert running.isActive, running.exception()
            gone = tables.read_batches(spark, store.path("incomplete"), flow.schemas.INCOMPLETE).collect()
    finally:
        running.stop()
    assert [(r["checksum"], r["chunks_seen"], r["chunk_total"]) for r in gone] == [("a", 1, 2)]


def test_offers_of_a_batch_are_joined_once_and_adaptively(spark, monkeypatch):
    session = streaming_session(spark, drain=True)
    store = flow.Store(scratch_dir(spark, "test-joined-once"))
    store.create(session)
    staging = flow.schemas.STAGING
    offer = {f.name: None for f in flow.schemas.OFFER.fields} | {"name": "pane", "category": "Bevande"}
    row = dict.fromkeys(staging.fieldNames()) | {"checksum": "a", "chunk_total": 3, "fetch_status": "ok"}
    chunks = [
        row | {"chunk_n": 0, "validity_from": "2025-06-28", "validity_to": "giugno 2025", "offers_data": [offer, offer | {"validity_to": "2025-07-02"}]},
        row | {"chunk_n": 1, "offers_data": [offer | {"validity_from": "luglio 2025"}]},
        row | {"chunk_n": 2, "offers_data": []},
    ]
    rows = spark.createDataFrame([tuple(chunk.values()) for chunk in chunks], staging)
    tables.commit_batch(rows, store.path("staging"), 0)
    plans, commit = [], tables.commit_batch

    def seen(rows, path, batch_id, *partitions, **options):
        if path == store.path("offers"):
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return commit(rows, path, batch_id, *partitions, **options)

    monkeypatch.setattr(tables, "commit_batch", seen)
    flow.finish(flow.start_fold(flow.staged_chunks(session, store), store, once=True))
    assert len(plans) == 1 and plans[0].count("Join") == 1 and "AdaptiveSparkPlan" in plans[0]
    found = flow.offers_view(spark, store, with_places=False).orderBy("chunk_n", "offer_n").select(
        "chunk_n", "offer_n", *[F.date_format(c, "MM-dd") for c in ("validity_from", "validity_to")]
    )
    assert [tuple(r) for r in found.collect()] == [(0, 0, "06-28", "06-30"), (0, 1, "06-28", "07-02"), (1, 0, "07-01", "06-30")]


def test_retry_waits_and_gives_up():
    calls = []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError("not yet")
        return "ok"

    quick = Retry(attempts=5, first_delay=0.0)
    assert call_with_retry(call, quick) == ("ok", 3, None)
    assert call_with_retry(lambda: 1 / 0, quick) == (None, 5, "ZeroDivisionError: division by zero")
    assert [Retry().delay(n) for n in (1, 2, 3, 4)] == [5.0, 20.0, 60.0, 60.0]


def test_embedder_failure_keeps_offers(spark):
    from leafmill.schemas import OFFER

    offer = {f.name: None for f in OFFER.fields} | {"name": "a", "category": "Giochi"}
    rows = spark.createDataFrame([([offer, offer],)], f"offers_data array<{OFFER.simpleString()}>")

    def down(texts):
        raise ConnectionError("embedder")

    kept = embed_offers(rows, down, Retry(attempts=2, first_delay=0.0)).first()["offers_data"]
    assert [o["embeddings"] for o in kept] == [None, None]


def test_older_files_can_be_left_out(spark):
    root = scratch_dir(spark, "test-since")
    session = streaming_session(spark, drain=True)
    spark.createDataFrame([(message("a" * 64, "u/x", "p"),)], "value string").write.text(f"{root}/inbox")
    seen = {}
    for name, since in (("all", "2000-01-01"), ("none", "2999-01-01")):
        rows = read_message_stream(session, f"{root}/inbox", since=since)
        flow.finish(
            rows.writeStream.format("parquet").option("path", f"{root}/{name}")
            .option("checkpointLocation", f"{root}/c-{name}").trigger(availableNow=True).start()
        )
        seen[name] = spark.read.schema(rows.schema).parquet(f"{root}/{name}").count()
    assert seen == {"all": 1, "none": 0}


def test_batches_are_released(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    store = flow.Store(scratch_dir(spark, "test-release"))
    store.create(spark)
    rows = spark.createDataFrame([(message("a" * 64, "u/x", "p"),)], "value string")
    from leafmill.sources.messages import parse_messages

    batch = parse_messages(rows).withColumns({"at": F.current_timestamp(), "part": F.lit("f")})
    flow.ingest_batch(batch, 0, store)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_shared_folder_comes_from_the_session(spark):
    import leafmill.session as session_module

    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "hdfs://shared/scratch/"}.get(key, default)

    class Session:
        conf = Conf()

    assert session_module.scratch_dir(Session(), "x").startswith("hdfs://shared/scratch/x-")


def test_progress_log():
    from types import SimpleNamespace

    from leafmill.streaming.progress import ProgressLog

    seen = []
    log = ProgressLog(seen.append)
    row = SimpleNamespace(asDict=lambda: {"chunks": 3})
    log.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(batchId=1, numInputRows=3, observedMetrics={"chunks": row})))
    assert seen == [{"event": "progress", "batch_id": 1, "rows": 3, "chunks": {"chunks": 3}}]


def test_a_finished_step_leaves_no_shuffle_files_and_batches_are_packed(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    session, path = streaming_session(spark), scratch_dir(spark, "test-cleanup")
    before = shuffled()
    tables.commit_batch(session.range(50_000).selectExpr("id", "cast(id as string) as s").repartition(3, "id"), path, 0)
    wait = time.time() + 20
    while shuffled() - before and time.time() < wait:
        time.sleep(0.2)
    assert not shuffled() - before
    assert tables.read_batches(spark, path, session.range(1).schema).count() == 50_000
    (name, *_) = glob.glob(f"{path.removeprefix('file://')}/batch_id=0/*.parquet")
    assert pq.ParquetFile(name).metadata.row_group(0).column(0).compression == "ZSTD"
