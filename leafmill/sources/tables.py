"""Batch-versioned Parquet tables.

A table is a folder with one ``batch_id=N`` folder per micro-batch. ``commit_batch`` writes a batch
beside the table and moves it there in one step, so a folder is whole when it is seen, and it is
never written again: a replay of a batch that is there changes nothing, and a stream that reads the
table meets each file once. ``write_batch`` overwrites the folder of its own batch instead, for
tables that only batch jobs read.

Keyed tables come in two kinds. ``read_latest`` takes the last version per key when it reads.
``upsert_batch`` keeps each hash partition of a table whole: a batch writes the partitions that it
touches anew, and ``read_current`` reads the last folder of each, without looking at keys.

A reader that must not see what a failed attempt of its own batch left behind asks for
``before=batch_id``; as ``batch_id`` is a partition column, that only prunes folders. Tables and the
checkpoint that numbers their batches belong together.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leafmill.operators.offers import latest_versions

# A folder that Spark's readers pass over.
ATTEMPTS = "_attempts"


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField("batch_id", T.LongType())])


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table with the schema; nothing happens where one exists."""
    empty = spark.createDataFrame([], _stored(schema))
    empty.write.mode("ignore").partitionBy("batch_id").parquet(path)


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    files, place = _files(spark, _folder(path, batch_id))
    return files.exists(place)


def commit_batch(rows: DataFrame, path: str, batch_id: int, *partitions: str, text: bool = False) -> bool:
    """The rows as batch ``batch_id``, once; False, and nothing is computed, where that batch is there already.

    What a failed attempt leaves lies in a folder that no reader sees.
    """
    spark = rows.sparkSession
    if is_committed(spark, path, batch_id):
        return False
    attempt = f"{path}/{ATTEMPTS}/{batch_id}-{uuid.uuid4().hex}"
    writer = rows.write.partitionBy(*partitions) if partitions else rows.write
    # Batches are kept, and most of them is text: zstd takes two thirds of the space of Spark's default.
    writer.text(attempt) if text else writer.option("compression", "zstd").parquet(attempt)
    files, written = _files(spark, attempt)
    if not files.rename(written, _files(spark, _folder(path, batch_id))[1]):
        raise OSError(f"batch {batch_id} could not be moved to {path}")
    return True


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """The rows as version ``batch_id`` of the table, in place of any before it."""
    rows.write.mode("overwrite").parquet(_folder(path, batch_id))


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """All versions, with ``batch_id``."""
    rows = spark.read.schema(_stored(schema)).option("basePath", path).parquet(path)
    return rows if before is None else rows.filter(F.col("batch_id") < before)


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, key: str | list[str], before: int | None = None
) -> DataFrame:
    """One row per key, the last written."""
    latest = latest_versions(read_batches(spark, path, schema, before), key, "batch_id")
    return latest.select(*schema.fieldNames())


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str | list[str], target: str) -> None:
    """The last versions as the first version of a new table, for readers to move to."""
    write_batch(read_latest(spark, path, schema, key), target, 0)


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _current_folders(spark: SparkSession, path: str, before: int | None = None) -> dict[int, str]:
    """Per hash partition the folder that was written last; names of folders only, no data."""
    files, pattern = _files(spark, f"{path}/batch_id=*/part=*")
    found: dict[int, tuple[int, str]] = {}
    for status in files.globStatus(pattern) or []:
        folder = status.getPath().toString()
        batch_id, part = map(int, re.search(r"/batch_id=(\d+)/part=(\d+)$", folder).groups())
        if before is None or batch_id < before:
            found[part] = max(found.get(part, (-1, "")), (batch_id, folder))
    return {part: folder for part, (_, folder) in found.items()}


def _read_parts(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    kept = T.StructType([*schema.fields, T.StructField("part", T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], kept)
    return spark.read.schema(kept).option("basePath", path).parquet(*sorted(folders)).select(*kept.fieldNames())


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per key: the last folder of every hash partition, read as it is."""
    folders = _current_folders(spark, path)
    return _read_parts(spark, path, schema, list(folders.values())).drop("part")


def upsert_batch(
    rows: DataFrame, path: str, schema: T.StructType, key: str, batch_id: int, parts: int
) -> bool:
    """Rows, one per key, put in place of those with the same key or added; False where the batch is there already.

    Only the hash partitions that the batch touches are read and written again, as folders of this
    batch that appear together. ``parts`` belongs to the table and must not change.
    """
    spark = rows.sparkSession
    if is_committed(spark, path, batch_id):
        return False
    new = rows.select(*schema.fieldNames()).withColumn("part", _part(key, parts)).persist()
    try:
        touched = {r["part"] for r in new.select("part").distinct().collect()}
        folders = [f for part, f in _current_folders(spark, path, batch_id).items() if part in touched]
        before = _read_parts(spark, path, schema, folders)
        kept = before.join(new.select(key), key, "left_anti").select(*new.columns)
        return commit_batch(kept.unionByName(new).repartition("part"), path, batch_id, "part")
    finally:
        new.unpersist()


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Folders of an upserted table that newer ones replace, for whoever clears up when no reader is left."""
    files, pattern = _files(spark, f"{path}/batch_id=*/part=*")
    current = set(_current_folders(spark, path).values())
    found = [status.getPath().toString() for status in files.globStatus(pattern) or []]
    return sorted(folder for folder in found if folder not in current)
