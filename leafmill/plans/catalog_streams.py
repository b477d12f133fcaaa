"""Streams and sinks: the same rows must come out of micro-batches, replays and restarts."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from leafmill.operators.extraction import extract_by_rule
from leafmill.operators.types import words
from leafmill.plans import standins
from leafmill.plans.catalog_fold import CACHED_NULLS, CONVERSATION_FLYERS, cached_with_nulls
from leafmill.plans.registry import query
from leafmill.schemas import FLYERS, FOLD_INPUT, FOLD_OUTPUT, MESSAGE, OFFER, REJECTS
from leafmill.session import scratch_dir, streaming_session
from leafmill.sources import tables
from leafmill.sources.messages import message_json, parse_messages, read_message_stream, write_queue
from leafmill.streaming import flow
from leafmill.streaming.fold import COMPLETE, fold_stream
from leafmill.streaming.progress import counters, write_counters


def _run_fold(spark, chunks, copies=1, per_batch=1):
    """Stage chunks as files split by chunk number, fold them as a stream, return the sink."""
    root = scratch_dir(spark, "fold")
    for _ in range(copies):
        chunks.repartition(2, "chunk_n").write.mode("append").parquet(f"{root}/chunks")
    session = streaming_session(spark, drain=True)
    stream = session.readStream.schema(FOLD_INPUT).option("maxFilesPerTrigger", per_batch)
    folded = fold_stream(stream.parquet(f"{root}/chunks"))
    running = (
        folded.writeStream.format("parquet").outputMode("append")
        .option("path", f"{root}/flyers").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    flow.finish(running)
    rows = spark.read.parquet(f"{root}/flyers").filter(F.col("status") == COMPLETE)
    return rows.select(*[f.name for f in FOLD_OUTPUT.fields]).drop("copies")


@query("fold_stream", CONVERSATION_FLYERS.format(cached="len(string_split(text, chr(10)))"))
def stream(spark, sf_dir):
    """Chunks of one flyer arrive in different micro-batches."""
    return _run_fold(spark, standins.conversation_chunks(spark, sf_dir))


@query("fold_redelivery", CONVERSATION_FLYERS.format(cached=CACHED_NULLS))
def redelivery(spark, sf_dir):
    """Every chunk is delivered twice, some copies after the flyer was complete; some counters are null."""
    chunks = standins.conversation_chunks(spark, sf_dir, cached_with_nulls())
    return _run_fold(spark, chunks, copies=2, per_batch=2)


@query(
    "queue_roundtrip",
    """select 'doc-' || doc_id || '.txt' as filename, 'flyer://documents/' || doc_id as url, sha256(text) as checksum,
  source as place_id, 'Shop ' || source as place_name, lang as address
from documents""",
)
def queue_roundtrip(spark, sf_dir):
    """Messages written as JSON to the queue, read back as a stream into a file sink."""
    root = scratch_dir(spark, "queue")
    messages = standins.messages(spark, sf_dir)
    messages.select(message_json(*MESSAGE.fieldNames()).alias("value")).write.text(f"{root}/queue/batch_id=0")
    session = streaming_session(spark, drain=True)
    raw = session.readStream.format("text").schema("value string").load(f"{root}/queue/*")
    running = (
        parse_messages(raw).writeStream.format("parquet").outputMode("append")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    flow.finish(running)
    return spark.read.schema(MESSAGE).parquet(f"{root}/out").select(
        "filename", "url", "checksum", F.col("source.placeId").alias("place_id"),
        F.col("source.name").alias("place_name"), F.col("source.address").alias("address"),
    )


@query(
    "upsert_flyers",
    """select coalesce(o_orderkey, l_orderkey)::varchar as checksum, coalesce(n, 0)::bigint as offers_count,
  coalesce(q, o_totalprice) as processing_time_seconds
from orders full join (select l_orderkey, count(*) as n, sum(l_quantity) as q from lineitem group by 1)
  on o_orderkey = l_orderkey""",
)
def upsert(spark, sf_dir):
    """Two batches of the flyer table, each put in twice: every hash partition is read as its last batch left it."""
    path = scratch_dir(spark, "flyers")
    tables.create_if_absent(spark, path, FLYERS)
    for batch_id, rows in enumerate(standins.flyer_versions(spark, sf_dir)):
        for _ in range(2):
            tables.upsert_batch(rows, path, FLYERS, "checksum", batch_id, parts=8)
    return tables.read_current(spark, path, FLYERS).select("checksum", "offers_count", "processing_time_seconds")


@query(
    "append_offers_idempotent",
    """select l_returnflag as category, count(*) as n, sum(l_quantity) as quantity, count(distinct l_orderkey) as flyers
from lineitem group by 1""",
)
def append_idempotent(spark, sf_dir):
    """Three batches of offers, each delivered twice; the second delivery finds its batch there."""
    path = scratch_dir(spark, "offers")
    lines = standins.table(spark, sf_dir, "lineitem")
    offers = lines.select(
        F.col("l_orderkey").cast("string").alias("flyer_checksum"), F.col("l_returnflag").alias("category"),
        F.col("l_quantity").cast("float").alias("quantity"),
    )
    for batch_id in range(3):
        batch = offers.filter(F.pmod(F.xxhash64("flyer_checksum"), F.lit(3)) == batch_id)
        for _ in range(2):
            tables.commit_batch(batch, path, batch_id)
    stored = tables.read_batches(spark, path, offers.schema)
    return stored.groupBy("category").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("quantity"),
        F.count_distinct("flyer_checksum").alias("flyers"),
    )


@query(
    "progress_counters",
    """select count(*) as chunks, sum(len(string_split(text, chr(10))))::bigint as offers,
  sum(case when role = 'assistant' then 0 else length(text) end)::bigint as tokens_in,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as tokens_out,
  sum(length(text) / 8.0::double) as seconds
from conversations""",
)
def progress(spark, sf_dir):
    """Counters of a stream, one stored row per micro-batch, here added up."""
    root = scratch_dir(spark, "progress")
    standins.conversation_chunks(spark, sf_dir).repartition(2, "chunk_n").write.parquet(f"{root}/chunks")
    session = streaming_session(spark, drain=True)
    chunks = session.readStream.schema(FOLD_INPUT).option("maxFilesPerTrigger", 1).parquet(f"{root}/chunks")
    running = (
        chunks.writeStream.foreachBatch(lambda batch, batch_id: write_counters(batch, batch_id, f"{root}/counters"))
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    flow.finish(running)
    seen = counters(spark, f"{root}/counters").drop("batch_id")
    return seen.agg(*[F.sum(c).alias(c) for c in seen.columns])


def _line_offers(chunks):
    """A rule extractor for plain documents: every non-blank line is an offer, its length the price."""
    def offer(line):
        parts = {"name": line, "category": F.lit("Giochi"), "price": F.length(line)}
        return F.struct(*[parts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OFFER.fields])

    filled = chunks.withColumn("lines", F.filter("chunk", lambda line: F.trim(line) != ""))
    text = F.array_join("chunk", "\n")
    results = extract_by_rule(
        filled, F.transform("lines", offer), F.lit("2025-06-28"), F.lit("giugno 2025"),
        F.length(text), F.size("lines"),
    )
    return results.drop("lines")


def _announce(spark, sf_dir, store):
    """Documents announced in two files, so that a document goes out with its own source's half of the sources."""
    standins.messages(spark, sf_dir).repartition(2, "source.placeId").select(
        message_json(*MESSAGE.fieldNames()).alias("value")
    ).write.text(store.path("inbox"))


def _start_flow(spark, name):
    store = flow.Store(scratch_dir(spark, name))
    session = streaming_session(spark, drain=True)
    store.create(session)
    return session, store


def run_flow(spark, sf_dir, extract=_line_offers, deliveries=1, terms=None):
    """Documents announced in two waves, through intake, extraction and fold.

    With more ``deliveries`` the staged chunks reach the fold as often, from batches of their own.
    """
    session, store = _start_flow(spark, "flow")
    _announce(spark, sf_dir, store)
    flow.finish(flow.start_intake(read_message_stream(session, store.path("inbox"), 1), store, once=True))
    content = standins.content(session, sf_dir)
    flow.finish(flow.start_extraction(flow.queue_stream(session, store), content, extract, store, once=True))
    for copy in range(1, deliveries):
        again = spark.read.parquet(store.path("staging/batch_id=0"))
        changed = again.withColumn("offers_data", F.slice("offers_data", 1, 1)).withColumn("offers_count", F.size("offers_data"))
        tables.commit_batch(changed, store.path("staging"), 1_000 + copy)
    flow.finish(flow.start_fold(flow.staged_chunks(session, store), store, once=True, terms=terms))
    return store


_FLOW_SQL = """
with d as (select text, sha256(text) as checksum, string_split(text, chr(10)) as pages from documents),
f as (select checksum, any_value(pages) as pages from d group by 1)
"""


@query(
    "flyers_end_to_end",
    _FLOW_SQL + """, places as (
  select sha256(text) as checksum, string_agg(distinct source, '|' order by source) as places from documents group by 1
)
select f.checksum, ((len(pages) + 4) // 5)::int as chunk_total, '2025-06-28' as validity_from, '2025-06-30' as validity_to,
  len(list_filter(pages, lambda x: length(trim(x, ' ')) > 0))::bigint as offers_count,
  places.places
from f join places using (checksum)""",
)
def flyers_end_to_end(spark, sf_dir):
    rows = flow.flyers_view(spark, run_flow(spark, sf_dir))
    return rows.select(
        "checksum", "chunk_total", F.date_format("validity_from", "yyyy-MM-dd").alias("validity_from"),
        F.date_format("validity_to", "yyyy-MM-dd").alias("validity_to"), "offers_count",
        F.array_join(F.array_sort("sources.placeId"), "|").alias("places"),
    )


@query(
    "offers_end_to_end",
    _FLOW_SQL + """, l as (
  select checksum, unnest(pages) as line, generate_subscripts(pages, 1) - 1 as i from f
)
select checksum as flyer_checksum, (i // 5)::int as chunk_n, count(*) as n, sum(length(line))::double as price,
  '2025-06-28' as validity_from
from l where length(trim(line, ' ')) > 0 group by 1, 2""",
)
def offers_end_to_end(spark, sf_dir):
    rows = flow.offers_view(spark, run_flow(spark, sf_dir), with_places=False)
    return rows.groupBy("flyer_checksum", "chunk_n").agg(
        F.count("*").alias("n"), F.sum(F.col("price").cast("double")).alias("price"),
        F.date_format(F.max("validity_from"), "yyyy-MM-dd").alias("validity_from"),
    )


_WORDS = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


@query(
    "offer_types_end_to_end",
    _FLOW_SQL + f""", w as (select {_WORDS.format("text")} as ws from documents),
terms as (select distinct ws[1] as term from w where len(ws) > 0 union select distinct ws[1] || ' ' || ws[2] from w where len(ws) > 1),
o as (select checksum, unnest(pages) as line from f),
l as (select line, {_WORDS.format("line")} as ws from (select distinct line from o where length(trim(line, ' ')) > 0)),
g as (select line, ws, unnest(range(1, len(ws) + 1)) as i from l),
r as (select line, i, 1 as n, ws[i] as term from g union all select line, i, 2, ws[i] || ' ' || ws[i + 1] from g where i < len(ws)),
best as (
  select line, term from r join terms using (term)
  qualify row_number() over (partition by line order by n desc, length(term) desc, i) = 1
)
select checksum as flyer_checksum, 'type of ' || term as type, count(*) as n
from o left join best using (line) where length(trim(line, ' ')) > 0 group by all""",
)
def offer_types_end_to_end(spark, sf_dir):
    """Types of published offers: the longest of the terms, one or two words that open some document."""
    opening = standins.table(spark, sf_dir, "documents").select(words(F.col("text")).alias("w"))
    term = F.explode(F.array(F.get("w", F.lit(0)), F.array_join(F.slice("w", 1, 2), " "))).alias("term")
    terms = opening.select(term).distinct().select("term", F.concat(F.lit("type of "), "term").alias("type"))
    rows = flow.offers_view(spark, run_flow(spark, sf_dir, terms=terms), with_places=False)
    return rows.groupBy("flyer_checksum", "type").agg(F.count("*").alias("n"))


def _queue(spark, sf_dir, store):
    """One message per text in the queue, that of the least id, with a day of arrival; its documents' content by day."""
    documents = standins.table(spark, sf_dir, "documents")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int"))
    first = documents.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    url = F.format_string("flyer://documents/%d", "doc_id")
    queued = first.select(
        F.format_string("doc-%d.txt", "doc_id").alias("filename"), url.alias("url"), F.sha2("text", 256).alias("checksum"),
        F.lit(None).cast(MESSAGE["source"].dataType).alias("source"), day.alias("arrived_on"),
    )
    write_queue(queued, store.path("queue"), 0)
    there = documents.filter("doc_id % 10 <> 3")
    altered = F.when(F.col("doc_id") % 10 == 4, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    kept = there.select(url.alias("url"), altered.cast("binary").alias("content"), day.alias("arrived_on"))
    kept.repartition("arrived_on").write.partitionBy("arrived_on").parquet(store.path("content"))


@query(
    "acquire_stream",
    """with d as (select text, min(doc_id) as doc_id from documents group by 1)
select 'flyer://documents/' || doc_id as url, sha256(text) as checksum,
  case doc_id % 10 when 3 then 'missing' when 4 then 'checksum mismatch' else 'ok' end as fetch_status,
  case when doc_id % 10 in (3, 4) then 0 else len(string_split(text, chr(10))) end::bigint as pages
from d""",
)
def acquire_stream(spark, sf_dir):
    """Content by day of arrival, fetched batch by batch; some is missing, some has changed."""
    session, store = _start_flow(spark, "acquire")
    _queue(spark, sf_dir, store)

    def content(session):
        return session.read.parquet(store.path("content"))

    def count_pages(chunks):
        return extract_by_rule(
            chunks, F.array().cast(T.ArrayType(OFFER)), F.lit("2025-06-28"), F.lit("2025-06-30"), F.size("chunk"), F.lit(0)
        )

    queued = flow.queue_stream(session, store)
    flow.finish(flow.start_extraction(queued, content, count_pages, store, once=True, on=["url", "arrived_on"]))
    staged = store.staging(spark)
    return staged.groupBy("url", "checksum", "fetch_status").agg(
        F.sum(F.when(F.col("chunk_n").isNotNull(), F.col("ai_input_tokens")).otherwise(0)).alias("pages")
    )


@query(
    "queue_replay",
    """with d as (select distinct sha256(text) as checksum, len(string_split(text, chr(10))) as pages from documents)
select checksum, unnest(range(0, (pages + 4) // 5))::int as chunk_n, 1::bigint as copies from d""",
)
def queue_replay(spark, sf_dir):
    """An intake batch is run again after its flyers were extracted: nothing is extracted twice."""
    session, store = _start_flow(spark, "replay")
    _announce(spark, sf_dir, store)
    lines = spark.read.text(store.path("inbox"))
    batch = parse_messages(lines.select("value", F.current_timestamp().alias("at"), F.lit("f").alias("part")))
    content = standins.content(session, sf_dir)
    for _ in range(2):
        flow.ingest_batch(batch, 0, store)
        flow.finish(flow.start_extraction(flow.queue_stream(session, store), content, _line_offers, store, once=True))
    return store.staging(spark).groupBy("checksum", "chunk_n").agg(F.count("*").alias("copies"))


def _contract_breaking(chunks):
    """Line offers of which some have an unknown category and some no name; chunks with a very long line have no dates."""
    results = _line_offers(chunks)

    def spoiled(offer):
        kind = F.length(offer["name"]) % 5
        category = F.when(kind == 0, "Altro").when(kind != 1, offer["category"])
        return offer.withField("category", category).withField("name", F.when(kind != 2, offer["name"]))

    dated = F.forall("offers_data", lambda o: o["price"] < 2_000)
    return results.withColumn("validity_from", F.when(dated, F.col("validity_from"))).withColumn(
        "offers_data", F.transform("offers_data", spoiled)
    )


_REJECTS_SQL = _FLOW_SQL + """, l as (
  select checksum, unnest(pages) as line, (generate_subscripts(pages, 1) - 1) // 5 as chunk_n from f
),
o as (select checksum, chunk_n, length(line) as n from l where length(trim(line, ' ')) > 0),
broken as (select checksum, chunk_n from o group by 1, 2 having max(n) >= 2000)
"""


@query(
    "rejects_end_to_end",
    _REJECTS_SQL + """
select checksum, chunk_n::int as chunk_n, case n % 5 when 0 then 'category unknown' when 1 then 'category missing' else 'name missing' end as reason,
  count(*) as n from o where n % 5 < 3 group by all
union all
select checksum, chunk_n::int, 'validity_from missing', 1 from broken""",
)
def rejects_end_to_end(spark, sf_dir):
    """Offers and chunks that break the contract end in the reject table, with the reason."""
    store = run_flow(spark, sf_dir, _contract_breaking)
    rows = tables.read_batches(spark, store.path("rejects"), REJECTS)
    return rows.groupBy("checksum", "chunk_n", "reason").agg(F.count("*").alias("n"))


@query(
    "offers_kept_end_to_end",
    _REJECTS_SQL + """
select checksum as flyer_checksum, count(*) as n, 'Giochi' as category from o
where n % 5 >= 3 and checksum not in (select checksum from broken) group by 1""",
)
def offers_kept_end_to_end(spark, sf_dir):
    """No offer of an unknown category reaches the offer table, nor one of a flyer with a broken chunk."""
    rows = flow.offers_view(spark, run_flow(spark, sf_dir, _contract_breaking), with_places=False)
    return rows.groupBy("flyer_checksum").agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("category")), "|").alias("category")
    )


@query(
    "fold_counts_offers",
    _FLOW_SQL + """
select checksum, len(list_filter(pages, lambda x: length(trim(x, ' ')) > 0))::bigint as offers_count,
  len(list_filter(pages, lambda x: length(trim(x, ' ')) > 0))::bigint as offers from f""",
)
def fold_counts_offers(spark, sf_dir):
    """Every chunk staged three times, with different offers: a flyer's count and its offers are of the same copies."""
    store = run_flow(spark, sf_dir, deliveries=3)
    flyers = flow.flyers_view(spark, store).select("checksum", "offers_count")
    offers = flow.offers_view(spark, store, with_places=False).groupBy(F.col("flyer_checksum").alias("checksum")).agg(F.count("*").alias("offers"))
    return flyers.join(offers, "checksum", "left").select("checksum", "offers_count", F.coalesce("offers", F.lit(0)).cast("bigint").alias("offers"))


@query(
    "flow_counters",
    _FLOW_SQL + """, o as (
  select checksum, len(pages) as lines, len(list_filter(pages, lambda x: length(trim(x, ' ')) > 0)) as offers, (len(pages) + 4) // 5 as chunks,
    list_sum(list_transform(pages, lambda x: length(x))) as chars from f
)
select (select count(*) from documents)::bigint as messages, count(*)::bigint as queued, sum(chunks)::bigint as chunks,
  sum(offers)::bigint as offers, sum(chars + lines - chunks)::bigint as tokens_in, sum(offers)::bigint as tokens_out,
  count(*)::bigint as flyers, sum(offers)::bigint as published, 0::bigint as incomplete
from o""",
)
def flow_counters(spark, sf_dir):
    """What the three queries counted, added up over their micro-batches."""
    store = run_flow(spark, sf_dir)
    intake, extraction, fold = (store.counters(spark, name) for name in ("intake", "extraction", "fold"))
    parts = [
        intake.agg(F.sum("messages").alias("messages"), F.sum("queued").alias("queued")),
        extraction.agg(*[F.sum(c).alias(c) for c in ("chunks", "offers", "tokens_in", "tokens_out")]),
        fold.agg(F.sum("flyers").alias("flyers"), F.sum("offers").alias("published"), F.sum("incomplete").alias("incomplete")),
    ]
    one = spark.range(1)
    for part in parts:
        one = one.join(part.withColumn("id", F.lit(0).cast("bigint")), "id")
    return one.drop("id")
