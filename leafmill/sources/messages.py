"""Message intake and the queue between ingest and extraction.

A queue is a folder of JSON lines, or a Kafka topic where the connector is on the class
path. Both sides carry one column ``value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pyspark.sql.types import StructType

from leafmill.schemas import MESSAGE, QUEUED
from leafmill.sources.tables import commit_batch


def parse_messages(raw: DataFrame, value: str = "value", schema: StructType = MESSAGE) -> DataFrame:
    """JSON bytes or text to message columns; malformed input gives nulls, not a failure."""
    keep = [c for c in raw.columns if c != value]
    parsed = raw.select(*keep, F.from_json(F.col(value).cast("string"), schema).alias("_m"))
    return parsed.select(*keep, "_m.*")


def message_json(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*(columns or MESSAGE.fieldNames())))


def read_message_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, since: str | None = None
) -> DataFrame:
    """Messages from a folder of JSON-line files, in micro-batches of so many files.

    ``at`` and ``part`` say which file, and which stretch of it, a message came from. A
    flow that must ignore what was there before it was first started gives that time as
    ``since``; a topic does the same with its starting offsets.
    """
    reader = spark.readStream.format("text").schema("value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    block = F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")
    raw = reader.load(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("at"),
        F.concat_ws("#", "_metadata.file_path", block).alias("part"),
    )
    if since is not None:
        raw = raw.filter(F.col("at") >= F.lit(since).cast("timestamp"))
    return parse_messages(raw)


def with_arrival(batch: DataFrame) -> DataFrame:
    """A micro-batch with ``arrival`` made from ``at``, ``part`` and the position.

    Kafka rows bring their offset; lines of a file are numbered as they are read.
    """
    position = F.col("pos") if "pos" in batch.columns else F.monotonically_increasing_id()
    rest = [c for c in batch.columns if c not in ("at", "part", "pos")]
    return batch.select(*rest, F.struct("at", "part", position.alias("pos")).alias("arrival"))


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Messages from a topic; without a checkpoint it starts at ``starting``."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
    return parse_messages(
        raw.select(
            "value",
            F.col("timestamp").alias("at"),
            F.format_string("%010d", "partition").alias("part"),
            F.col("offset").alias("pos"),
        )
    )


def write_queue(messages: DataFrame, path: str, batch_id: int) -> bool:
    """One folder of JSON lines per batch, which appears whole; a replayed batch leaves it as it is."""
    json = messages.select(message_json(*QUEUED.fieldNames()).alias("value"))
    return commit_batch(json, path, batch_id, text=True)


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    json = messages.select(F.col("checksum").alias("key"), message_json(*MESSAGE.fieldNames()).alias("value"))
    json.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
