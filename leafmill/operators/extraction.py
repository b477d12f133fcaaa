"""Applying an extractor to chunks: by rule inside the JVM, or a plugged-in function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from leafmill.functions.packs import offers_type, read_offers
from leafmill.functions.text import flyer_reject_reason, offer_reject_reason
from leafmill.schemas import CHUNK_RESULT

Extractor = Callable[[Any], dict[str, Any]]


@dataclass(frozen=True)
class Retry:
    """Attempts and waits around a call that may fail for a while."""

    # Five attempts, waits of 5 s growing fourfold, at most 60 s.
    attempts: int = 5
    first_delay: float = 5.0
    base: float = 4.0
    max_delay: float = 60.0

    def delay(self, failures: int) -> float:
        return min(self.max_delay, self.first_delay * self.base ** (failures - 1))


# Five attempts, waits of half a second doubling.
EMBEDDER_RETRY = Retry(attempts=5, first_delay=0.5, base=2.0, max_delay=120.0)


def call_with_retry(call: Callable[[], Any], retry: Retry) -> tuple[Any, int, str | None]:
    """Result, attempts used, and the last error when all of them failed."""
    error = None
    for attempt in range(1, retry.attempts + 1):
        try:
            return call(), attempt, None
        except Exception as exc:  # noqa: BLE001 - any failure of a plugged-in call is a reject
            error = f"{type(exc).__name__}: {exc}"
            if attempt < retry.attempts:
                time.sleep(retry.delay(attempt))
    return None, retry.attempts, error


def extract_with(
    chunks: DataFrame, extractor: Extractor, chunk: str = "chunk", retry: Retry = Retry(),
    schema: T.StructType = CHUNK_RESULT,
) -> DataFrame:
    """Run ``extractor(chunk)`` once per row; typed result columns, ``attempts``, ``error``.

    The extractor returns a dict of ``schema`` fields; wall time, time stamp and
    offer count are filled in here. A chunk that keeps failing becomes a row with ``error`` set.
    """
    keys = [f for f in chunks.schema.fields if f.name != chunk]
    names = [f.name for f in schema.fields]
    out = T.StructType(
        keys + list(schema.fields)
        + [T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType())]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for value in frame[chunk]:
                started = time.perf_counter()
                if value is None:  # nothing was fetched: the row only carries the reason
                    rows.append({name: None for name in names} | {"attempts": 0, "error": None})
                    continue
                result, attempts, error = call_with_retry(lambda: extractor(value), retry)
                row = {name: None for name in names} | (result or {})
                if "processing_time_seconds" in row and row["processing_time_seconds"] is None:
                    row["processing_time_seconds"] = time.perf_counter() - started
                if "processed_at" in row and row["processed_at"] is None:
                    row["processed_at"] = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
                if row.get("offers_count", 0) is None and row.get("offers_data") is not None:
                    row["offers_count"] = len(row["offers_data"])
                rows.append(row | {"attempts": attempts, "error": error})
            done = pd.DataFrame(rows, columns=[*names, "attempts", "error"], dtype=object)
            yield pd.concat([frame.drop(columns=[chunk]).reset_index(drop=True), done], axis=1)

    return chunks.mapInPandas(run, out)


def extract_json(rows: DataFrame, json: str = "json") -> DataFrame:
    """Extractor output that arrives as JSON text, forced into the chunk contract."""
    keep = [c for c in rows.columns if c != json]
    parsed = rows.select(*keep, F.from_json(json, CHUNK_RESULT, {"mode": "PERMISSIVE"}).alias("_r"))
    return parsed.select(*keep, "_r.*")


def rule_offers(chunk: Column, as_of: Column, category: Column) -> Column:
    """All offers on the pages of one chunk, by rule, in page and line order."""
    lines = F.flatten(F.transform(chunk, lambda page: F.split(page, r"\n")))
    return F.flatten(F.transform(lines, lambda line: read_offers(line, as_of, category)))


def extract_by_rule(
    chunks: DataFrame, offers: Column, validity_from: Column, validity_to: Column,
    input_units: Column, output_units: Column, seconds: Column | None = None,
) -> DataFrame:
    """Chunk results from column expressions, metered, without leaving the JVM."""
    keep = [c for c in chunks.columns if c != "chunk"]
    fields = {
        "validity_from": validity_from,
        "validity_to": validity_to,
        "offers_count": F.size("_offers").cast("bigint"),
        "ai_model": F.lit("rules"),
        "ai_input_tokens": input_units.cast("bigint"),
        "ai_cached_tokens": F.lit(0).cast("bigint"),
        "ai_output_tokens": output_units.cast("bigint"),
        "ai_finish_reason": F.lit(None).cast("string"),
        "processed_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "processing_time_seconds": F.lit(0.0) if seconds is None else seconds.cast("double"),
        "offers_data": F.col("_offers"),
    }
    with_offers = chunks.withColumn("_offers", offers.cast(offers_type()))
    return with_offers.select(*keep, *[column.alias(name) for name, column in fields.items()])


def split_valid(results: DataFrame) -> DataFrame:
    """Chunk results with ``reject_reason``, and the offers cut into valid and rejected.

    Adds ``rejected_offers``: ``array<struct<offer, reason>>``; ``offers_data`` keeps the rest.
    """
    judged = F.transform(
        "offers_data", lambda o: F.struct(o.alias("offer"), offer_reject_reason(o).alias("reason"))
    )
    good = F.filter("_judged", lambda j: j["reason"].isNull())
    return (
        results.withColumn(
            "reject_reason",
            flyer_reject_reason(F.col("validity_from"), F.col("validity_to"), F.col("offers_data")),
        )
        .withColumn("_judged", judged)
        .withColumn("offers_data", F.transform(good, lambda j: j["offer"]))
        .withColumn("rejected_offers", F.filter("_judged", lambda j: j["reason"].isNotNull()))
        .drop("_judged")
    )
