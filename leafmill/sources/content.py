"""Flyer content as rows, so that any executor can take any chunk, again if need be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Whole files as ``url, content``."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path").alias("url"), "content")


def as_content(table: DataFrame, url: str, content: str) -> DataFrame:
    """Any table with a url and a text or binary column, as ``url, content``."""
    return table.select(F.col(url).alias("url"), F.col(content).cast("binary").alias("content"))
