"""Progress counters of a stream, measured where the rows pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import _parse_datatype_string

from leafmill.sources.tables import commit_batch, read_batches, write_batch

MESSAGES, CHUNKS = "messages", "chunks"

COUNTERS = "chunks bigint, offers bigint, tokens_in bigint, tokens_out bigint, seconds double"


def _counted() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("chunks"),
        F.sum("offers_count").alias("offers"),
        F.sum("ai_input_tokens").alias("tokens_in"),
        F.sum("ai_output_tokens").alias("tokens_out"),
        F.sum("processing_time_seconds").alias("seconds"),
    ]


def count_chunks(chunks: DataFrame, name: str = CHUNKS) -> DataFrame:
    """The same stream, observed: chunks, offers, tokens and seconds per micro-batch, for listeners."""
    return chunks.observe(name, *_counted())


def count_messages(messages: DataFrame, name: str = MESSAGES) -> DataFrame:
    """The same stream, observed: messages per micro-batch, and those that could not be read."""
    return messages.observe(name, F.count(F.lit(1)).alias("messages"), F.count_if(F.col("checksum").isNull()).alias("unreadable"))


def commit_counters(rows: DataFrame, path: str, batch_id: int, *counted: Column) -> None:
    """One row of counters for a micro-batch, once."""
    commit_batch(rows.agg(*(counted or _counted())), path, batch_id)


def write_counters(batch: DataFrame, batch_id: int, path: str) -> None:
    """For ``foreachBatch``: one row of counters per micro-batch. A replay overwrites its own row.

    Unlike a query's recent progress, of which Spark keeps the last batches only, the table is whole.
    """
    write_batch(batch.agg(*_counted()), path, batch_id)


def counters(spark: SparkSession, path: str) -> DataFrame:
    """Counters of all micro-batches, with their ``batch_id``."""
    return read_batches(spark, path, _parse_datatype_string(COUNTERS))


class ProgressLog(StreamingQueryListener):
    """Hands the counters of every micro-batch to a function, by default ``print``."""

    def __init__(self, emit=print):
        self.emit = emit

    def onQueryStarted(self, event) -> None:
        self.emit({"event": "started", "name": event.name})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {k: row.asDict() for k, row in p.observedMetrics.items()}
        self.emit({"event": "progress", "batch_id": p.batchId, "rows": p.numInputRows, **observed})

    def onQueryTerminated(self, event) -> None:
        self.emit({"event": "terminated", "error": event.exception})
