"""The three streaming queries: intake, extraction, fold and publication.

::

    messages -> [intake]     -> queue (JSON), registry, places
    queue    -> [extraction] -> staging (chunk results, offers nested per chunk), rejects
    staging  -> [fold]       -> flyers, offers, incomplete

and what is refused on the way goes to ``rejects``, with a reason.

Each arrow ends in files that every executor can read, so a lost executor costs a task and a
lost driver a micro-batch. Every batch of every table appears whole and is never written again
(``tables.commit_batch``), so a replayed batch neither changes a table nor shows the next query a
row twice, and an extractor is not called again for a batch that is staged. No error is caught on
the way to a sink: a batch that fails is run again.

Micro-batches read what they may hit: the registry in the folders of their checksums' prefixes, the
content table in the folders of their days, the flyer table in the hash partitions of their flyers,
staging in the batches of the copies that were folded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from leafmill import schemas
from leafmill.functions.chunks import text_pages
from leafmill.operators.chunking import OK, acquire, split_chunks, spread
from leafmill.operators.extraction import split_valid
from leafmill.operators.fold import fold_input
from leafmill.operators.ingest import known_among, new_flyers, new_places, place_lists
from leafmill.operators.offers import dated_offers, explode_offers, flyer_dates, flyer_rows
from leafmill.operators.types import digest, fill_types, types_in_chunks
from leafmill.session import adaptive
from leafmill.sources import tables
from leafmill.sources.messages import parse_messages, with_arrival, write_queue
from leafmill.streaming.fold import COMPLETE, INCOMPLETE, fold_stream
from leafmill.streaming.progress import commit_counters, count_chunks, count_messages

Extract = Callable[[DataFrame], DataFrame]
Terms = DataFrame | Callable[[SparkSession], DataFrame] | None

# What names a copy of a chunk in staging.
CHUNK = ["batch_id", "checksum", "chunk_n"]


@dataclass(frozen=True)
class Store:
    """Where the tables and checkpoints of one flow live, below a shared folder."""

    root: str
    # Hash partitions of the flyer table, and how many first characters of a checksum name a folder of the
    # registry and the places (16 folders a character); chosen once, for the life of the tables.
    flyer_parts: int = 16
    prefix_chars: int = 1

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def create(self, spark: SparkSession) -> None:
        """All tables, where absent."""
        for name, schema in (
            ("registry", schemas.REGISTRY),
            ("places", schemas.PLACES),
            ("staging", schemas.STAGING),
            ("rejects", schemas.REJECTS),
            ("flyers", schemas.FLYERS),
            ("offers", schemas.OFFERS),
            ("incomplete", schemas.INCOMPLETE),
        ):
            tables.create_if_absent(spark, self.path(name), schema)

    def staging(self, spark: SparkSession) -> DataFrame:
        """All staged chunks, with the ``batch_id`` that staged them."""
        return tables.read_batches(spark, self.path("staging"), schemas.STAGING)

    def counters(self, spark: SparkSession, name: str) -> DataFrame:
        """Counters of one of the three queries, a row per micro-batch."""
        return spark.read.option("basePath", self.path(f"counters/{name}")).parquet(self.path(f"counters/{name}"))


def _start(rows: DataFrame, name: str, store: Store, once: bool):
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", store.checkpoint(name))
    return writer.trigger(availableNow=True) if once else writer


def _prefix(store: Store) -> Column:
    return F.substring("checksum", 1, store.prefix_chars)


def _by_prefix(rows: DataFrame, schema: StructType) -> DataFrame:
    """The columns of a table, a file for each folder rather than one from every task."""
    return rows.select(*schema.fieldNames()).repartition("prefix")


def registered(spark: SparkSession, store: Store, messages: DataFrame, batch_id: int | None = None) -> DataFrame:
    """The checksums of ``messages`` that earlier batches queued: a read of their prefixes' folders only.

    ``messages``, with ``prefix``, are what prunes: small ones are broadcast, and their prefixes
    choose folders before any file is opened; large ones go through a shuffle with a bloom filter of their
    checksums in front of it (see ``streaming_session``).
    """
    registry = tables.read_batches(spark, store.path("registry"), schemas.REGISTRY, batch_id)
    return known_among(registry, messages.filter(F.length("checksum") > 0), "checksum", "prefix")


def ingest_batch(batch: DataFrame, batch_id: int, store: Store) -> None:
    """Queue the unseen flyers of a batch and record every new (flyer, shop) pair.

    Shops are recorded for every message, queued or not, so a flyer announced by two shops
    before it is processed keeps both.
    """
    spark = batch.sparkSession
    arrived = with_arrival(batch).filter("checksum is not null").withColumn("prefix", _prefix(store))
    messages = arrived.persist()
    try:
        n = messages.count()  # from here on Spark knows its size
        places = tables.read_batches(spark, store.path("places"), schemas.PLACES, batch_id)
        keyed = messages.select("checksum", "prefix", F.col("source.placeId").alias("place_id")).filter(F.length("checksum") > 0)
        flyers = new_flyers(messages, registered(spark, store, messages, batch_id)).withColumn("arrived_on", F.to_date("arrival.at")).persist()
        found = new_places(messages, known_among(places, keyed, "checksum", "place_id", "prefix")).withColumn("prefix", _prefix(store))
        try:
            tables.commit_batch(_by_prefix(found, schemas.PLACES), store.path("places"), batch_id, "prefix")
            write_queue(flyers, store.path("queue"), batch_id)
            tables.commit_batch(_by_prefix(flyers, schemas.REGISTRY), store.path("registry"), batch_id, "prefix")
            counted = [F.lit(n).cast("bigint").alias("messages"), F.count("*").alias("queued")]
            commit_counters(flyers, store.path("counters/intake"), batch_id, *counted)
        finally:
            flyers.unpersist()
    finally:
        messages.unpersist()


def start_intake(messages: DataFrame, store: Store, once: bool = False) -> StreamingQuery:
    """Route a message stream (see ``sources.messages``)."""
    return (
        _start(count_messages(messages), "intake", store, once)
        .queryName("intake")
        .foreachBatch(lambda batch, batch_id: ingest_batch(batch, batch_id, store))
        .start()
    )


def queue_stream(spark: SparkSession, store: Store, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").schema("value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_messages(reader.load(store.path("queue") + "/batch_id=*"), schema=schemas.QUEUED)


def extraction_plan(
    messages: DataFrame, content: DataFrame, extract: Extract,
    partitions: int | None = None, on: str | list[str] = "url",
) -> DataFrame:
    """Messages to staged chunk results; failures stay as rows with a reason."""
    fetched = acquire(messages, content, on)
    pages = F.when(F.col("fetch_status") == OK, text_pages(F.col("content").cast("string")))
    chunks = spread(split_chunks(fetched, pages, outer=True), partitions)
    results = extract(chunks)
    for name, kind in (("attempts", "int"), ("error", "string")):
        if name not in results.columns:
            results = results.withColumn(name, F.lit(None).cast(kind))
    results = split_valid(results)
    broken = F.when(F.col("chunk_n").isNotNull(), F.col("reject_reason"))
    results = results.withColumns(
        {"error": F.coalesce("error", broken), "offers_count": F.coalesce(F.size("offers_data"), F.lit(0))}
    )
    return results.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.STAGING.fields])


def rejected(staged: DataFrame) -> DataFrame:
    """``REJECTS`` of staged chunks: refused offers, failed chunks, documents that could not be fetched."""
    offers = staged.select("checksum", "chunk_n", F.explode("rejected_offers").alias("r")).select(
        "checksum", "chunk_n", "r.reason", "r.offer"
    )
    reason = F.coalesce("error", F.when(F.col("fetch_status") != OK, F.col("fetch_status")))
    failed = staged.filter(reason.isNotNull()).select("checksum", "chunk_n", reason.alias("reason"))
    wanted = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.REJECTS.fields]
    return offers.unionByName(failed, allowMissingColumns=True).select(*wanted)


def extract_batch(
    batch: DataFrame, batch_id: int, content: DataFrame | Callable[[SparkSession], DataFrame], extract: Extract,
    store: Store, partitions: int | None = None, on: str | list[str] = "url",
) -> None:
    """Fetch, chunk and extract the queued flyers of a batch; each step runs once, whatever is replayed."""
    spark = batch.sparkSession
    if not tables.is_committed(spark, store.path("staging"), batch_id):
        messages = batch.filter("checksum is not null").dropDuplicates(["checksum"]).persist()
        try:
            messages.count()  # from here on Spark knows its size
            known = content(spark) if callable(content) else content
            tables.commit_batch(extraction_plan(messages, known, extract, partitions, on), store.path("staging"), batch_id)
        finally:
            messages.unpersist()
    staged = store.staging(spark).filter(F.col("batch_id") == batch_id)
    tables.commit_batch(rejected(staged), store.path("rejects"), batch_id)
    commit_counters(staged.filter("chunk_n is not null and error is null"), store.path("counters/extraction"), batch_id)


def start_extraction(
    messages: DataFrame, content: DataFrame | Callable[[SparkSession], DataFrame], extract: Extract, store: Store,
    partitions: int | None = None, once: bool = False, on: str | list[str] = "url",
) -> StreamingQuery:
    """Fetch, chunk and extract queued flyers into the staging table; ``on`` as in ``acquire``.

    A content table that grows is given as a function, so that each batch sees its new days.
    """
    return (
        _start(messages, "extraction", store, once)
        .queryName("extraction")
        .foreachBatch(lambda batch, batch_id: extract_batch(batch, batch_id, content, extract, store, partitions, on))
        .start()
    )


def staged_chunks(spark: SparkSession, store: Store, files_per_batch: int | None = None) -> DataFrame:
    """The fold's input: good chunks, narrow columns only, counted for listeners."""
    reader = spark.readStream.schema(StructType([*schemas.STAGING.fields, StructField("batch_id", LongType())]))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    good = reader.parquet(store.path("staging")).filter("chunk_n is not null and error is null")
    return count_chunks(fold_input(good.withColumnRenamed("batch_id", "staged_batch")))


def _chunk_key() -> Column:
    """What names a copy of a chunk, as 16 bytes: it travels with every name that is looked up."""
    return digest(F.concat_ws("/", "batch_id", "chunk_n", "checksum")).alias("_chunk")


def _publish_offers(chunks: DataFrame, store: Store, batch_id: int) -> None:
    tables.commit_batch(dated_offers(explode_offers(chunks, "_flyer_from", "_flyer_to")), store.path("offers"), batch_id)


def publish_batch(batch: DataFrame, batch_id: int, store: Store, terms: Terms = None) -> None:
    """Write the flyers a batch completed, with their offers, and those it gave up on.

    The offers wait in staging. The fold tells which copy of each chunk it counted, so just those
    copies' offers are read, from the folders of the batches that staged them. A copy brings the
    flyer's dates along, so the offers are joined, and shuffled, once. With ``terms``, an
    offer without a type gets that of the longest term in its name, which is looked up where staging is read and
    joins the chunk of its offer.
    """
    spark = batch.sparkSession
    folded = flyer_rows(batch, keep=("status", "chunks_seen", "copies")).persist()
    try:
        flyers = folded.filter(F.col("status") == COMPLETE)
        copies = flyers.select("checksum", *flyer_dates(), F.explode("copies").alias("c")).select(
            F.col("c.staged_batch").alias("batch_id"), "checksum", "c.chunk_n", "_flyer_from", "_flyer_to"
        )
        folded.count()  # from here on Spark knows its size
        staged = store.staging(spark).select(*CHUNK, "offers_data")
        if terms is None:
            _publish_offers(staged.join(copies, CHUNK), store, batch_id)
        else:
            batches = [r["batch_id"] for r in copies.select("batch_id").distinct().collect()]
            named = staged.filter(F.col("batch_id").isin(batches)).select(_chunk_key(), "offers_data")
            with types_in_chunks(named, terms(spark) if callable(terms) else terms, "_chunk") as types:
                wanted = named.join(copies.select("*", _chunk_key()), "_chunk").join(types, "_chunk", "left")
                filled = fill_types(F.col("offers_data"), F.col("types"))
                _publish_offers(wanted.withColumn("offers_data", filled), store, batch_id)
        gone = folded.filter(F.col("status") == INCOMPLETE)
        tables.commit_batch(gone.select(*schemas.INCOMPLETE.fieldNames()), store.path("incomplete"), batch_id)
        tables.upsert_batch(flyers, store.path("flyers"), schemas.FLYERS, "checksum", batch_id, store.flyer_parts)
        counted = [F.count_if(F.col("status") == COMPLETE).alias("flyers"), F.count_if(F.col("status") == INCOMPLETE).alias("incomplete"),
                   F.coalesce(F.sum(F.when(F.col("status") == COMPLETE, F.col("offers_count"))), F.lit(0)).alias("offers")]
        commit_counters(folded, store.path("counters/fold"), batch_id, *counted)
    finally:
        folded.unpersist()


def start_fold(chunks: DataFrame, store: Store, once: bool = False, terms: Terms = None, **fold_options) -> StreamingQuery:
    """Fold staged chunks (see ``staged_chunks``) and publish what is complete.

    ``terms``: a table of product types (see ``operators.types``), or a function that reads it per batch.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            publish_batch(batch, batch_id, store, terms)

    return (
        _start(fold_stream(chunks, **fold_options), "fold", store, once)
        .queryName("fold")
        .foreachBatch(publish)
        .start()
    )


def stored_places(spark: SparkSession, store: Store) -> DataFrame:
    """``checksum, sources``: the shops of every flyer, in arrival order."""
    rows = tables.read_batches(spark, store.path("places"), schemas.PLACES)
    return place_lists(rows, F.struct("batch_id", "arrival"))


def flyers_view(spark: SparkSession, store: Store) -> DataFrame:
    """The flyer table, one row per checksum, with all its shops."""
    latest = tables.read_current(spark, store.path("flyers"), schemas.FLYERS).drop("sources")
    joined = latest.join(stored_places(spark, store), "checksum", "left")
    return joined.select(*schemas.FLYERS.fieldNames())


def offers_view(spark: SparkSession, store: Store, with_places: bool = True) -> DataFrame:
    """The offer table; its shops are joined on reading, never copied into the rows."""
    offers = tables.read_batches(spark, store.path("offers"), schemas.OFFERS).drop("batch_id")
    if not with_places:
        return offers
    places = stored_places(spark, store).withColumnRenamed("checksum", "flyer_checksum")
    return offers.join(places, "flyer_checksum", "left")


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query; its failure is raised here."""
    query.awaitTermination()
    return query
