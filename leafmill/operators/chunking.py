"""From announced documents to numbered chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.functions.chunks import PAGES_PER_CHUNK, chunk_pages, content_matches, text_pages

OK, MISSING, MISMATCH = "ok", "missing", "checksum mismatch"


def acquire(messages: DataFrame, content: DataFrame, on: str | list[str] = "url") -> DataFrame:
    """Messages with their ``content`` and a ``fetch_status``; failures are kept, not lost.

    ``content`` has one row per key. Where the content table is partitioned, say by arrival
    day, name that column in ``on`` as well: the join then reads the days of the messages only.

    For a batch the content table is on the probe side: messages that are small at run time are
    broadcast by Spark, and no content is shuffled. Messages without content are found by a second
    look at the keys alone. A stream, which cannot prune, is joined as it is.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if messages.isStreaming:
        joined = messages.join(content, keys, "left")
    else:
        asked = messages.filter(F.length(F.col(keys[0]).cast("string")) > 0)
        found = asked.select(*keys).distinct()
        there = content.select(*keys).join(found, keys, "left_semi")
        joined = content.join(asked, keys).unionByName(messages.join(there, keys, "left_anti"), allowMissingColumns=True)
    status = (
        F.when(F.col("content").isNull(), MISSING)
        .when(content_matches(F.col("content"), F.col("checksum")), OK)
        .otherwise(MISMATCH)
    )
    return joined.withColumn("fetch_status", status)


def split_chunks(
    documents: DataFrame, pages: Column | None = None, size: int = PAGES_PER_CHUNK, outer: bool = False
) -> DataFrame:
    """One row per chunk: ``chunk_n`` from 0, ``chunk_total``, ``chunk`` (its pages).

    Documents without pages give no row, or with ``outer`` one row without a chunk.
    The content column itself does not travel on.
    """
    pages = text_pages(F.col("content").cast("string")) if pages is None else pages
    keep = [c for c in documents.columns if c != "content"]
    chunks = documents.select(*keep, chunk_pages(pages, size).alias("_chunks"))
    explode = F.posexplode_outer if outer else F.posexplode
    return chunks.select(
        *keep, F.size("_chunks").alias("chunk_total"), explode("_chunks").alias("chunk_n", "chunk")
    )


def spread(
    rows: DataFrame, partitions: int | None = None, keys: tuple[str, ...] = ("checksum", "chunk_n")
) -> DataFrame:
    """Redistribute rows before a slow step, by a hash that a replay reproduces.

    What a row costs there has nothing to do with how the files happen to be cut, and
    no statistics can tell Spark. The keys should be as good as unique.
    """
    return rows.repartition(partitions, *keys) if partitions else rows.repartition(*keys)
