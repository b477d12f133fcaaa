"""Search over offers: facets, ranges, validity, distance, ranked text, neighbours."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from leafmill.functions.geo import FINENESS, covering_cells, haversine_km, space_cell
from leafmill.functions.text import stem, without_elision, words
from leafmill.session import scratch_dir

# The usual BM25 constants.
BM25_K1, BM25_B = 1.2, 0.75

# A block of queries and a tile of rows: of 1,024 floats, 16 and 128 MB in double precision; a strip of
# queries is scored at a time.
QUERY_BLOCK, TILE_ROWS, STRIP = 2_048, 16_384, 256

# Cells of an approximate index are fitted on so many rows at most, in so many rounds.
SAMPLE_ROWS, ROUNDS = 20_000, 8

NEIGHBOURS = "query_id bigint, row_id bigint, similarity double"


def exact_match(rows: DataFrame, **wanted: object) -> DataFrame:
    """Rows whose keyword columns equal the given values; reaches the file scan."""
    return rows.filter(reduce(Column.__and__, [F.col(c) == F.lit(v) for c, v in wanted.items()]))


def facet(rows: DataFrame, *keys: str) -> DataFrame:
    """Row count per value of the key columns."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def numeric_range(rows: DataFrame, column: str, low: float | None, high: float | None) -> DataFrame:
    """Rows with ``low <= column <= high``; an open end is None."""
    if low is not None:
        rows = rows.filter(F.col(column) >= F.lit(low))
    if high is not None:
        rows = rows.filter(F.col(column) <= F.lit(high))
    return rows


def valid_on(rows: DataFrame, day: Column, start: str = "validity_from", end: str = "validity_to") -> DataFrame:
    """Rows whose validity contains the day."""
    return rows.filter((F.col(start) <= day) & (F.col(end) >= day))


def valid_per_day(
    rows: DataFrame, days: DataFrame, start: str = "validity_from", end: str = "validity_to"
) -> DataFrame:
    """``day, n``: how many rows are valid on each day of ``days``.

    Every row adds one at its first day and takes one off after its last, both summed per
    day before any ordering. The running sum then goes over calendar days, not over rows,
    so no interval is ever expanded or paired with the days it covers.
    """
    first, last = F.to_date(F.col(start)), F.to_date(F.col(end))
    spans = rows.filter(first.isNotNull() & last.isNotNull() & (first <= last))
    steps = spans.select(
        F.explode(
            F.array(
                F.struct(first.alias("day"), F.lit(1).alias("step")),
                F.struct(F.date_add(last, 1).alias("day"), F.lit(-1).alias("step")),
            )
        ).alias("s")
    ).groupBy("s.day").agg(F.sum("s.step").alias("step"))
    asked = days.select(F.to_date(F.col("day")).alias("day")).filter("day is not null").distinct()
    line = steps.select("day", "step", F.lit(False).alias("asked")).unionByName(
        asked.select("day", F.lit(0).cast("bigint").alias("step"), F.lit(True).alias("asked"))
    ).groupBy("day").agg(F.sum("step").alias("step"), F.bool_or("asked").alias("asked"))
    running = F.sum("step").over(Window.orderBy("day"))
    return line.withColumn("n", running).filter("asked").select("day", "n")


def within_km(rows: DataFrame, lat: float, lon: float, radius_km: float) -> DataFrame:
    """Rows within the radius of one point, with ``km``. The latitude range is pushed to the scan."""
    degrees = radius_km / 111.0
    near = rows.filter(F.col("lat").between(lat - degrees, lat + degrees))
    km = haversine_km(F.col("lat"), F.col("lon"), F.lit(lat), F.lit(lon))
    return near.withColumn("km", km).filter(F.col("km") <= radius_km)


def candidate_pairs(rows: DataFrame, points: DataFrame, radius_km: float) -> DataFrame:
    """Rows joined to the points whose cover holds their cell: an equi-join on cells finer than the radius."""
    cells = covering_cells(points, "point_lat", "point_lon", radius_km, "_cell")
    placed = rows.withColumn("_cell", space_cell(F.col("lat"), F.col("lon"), radius_km / FINENESS))
    return placed.join(cells, "_cell").drop("_cell")


def near_points(rows: DataFrame, points: DataFrame, radius_km: float) -> DataFrame:
    """Rows joined to the points within the radius, with ``km``.

    Each point stands in every cell that its circle reaches, so candidates are few more than the
    answer. ``points``: point_id, point_lat, point_lon.
    """
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("point_lat"), F.col("point_lon"))
    return candidate_pairs(rows, points, radius_km).withColumn("km", km).filter(F.col("km") <= radius_km)


def kept_words(rows: DataFrame, key: str, text: str, stop_words: list[str]) -> DataFrame:
    """One row ``key, word`` per word that counts: elisions cut, stop words dropped."""
    split = rows.select(key, F.explode(words(F.col(text))).alias("word"))
    cut = split.select(key, without_elision(F.col("word")).alias("word")).filter("word != ''")
    return cut.filter(~F.col("word").isin(stop_words)) if stop_words else cut


def term_index(
    documents: DataFrame, stop_words: list[str], doc_id: str = "doc_id", text: str = "text", buckets: int | None = None
) -> DataFrame:
    """Postings ``doc_id, term, tf, length``, to be stored once and asked many times (``store_index``).

    The texts are shuffled once, on the document id, before they are cut into words, which
    is smaller than the words would be. Counting terms and adding up lengths then need no
    further shuffle. Words are stemmed after they are counted, once per document.
    """
    texts = documents.select(doc_id, text)
    texts = texts.repartition(buckets, doc_id) if buckets else texts.repartition(doc_id)
    seen = kept_words(texts, doc_id, text, stop_words).groupBy(doc_id, "word").agg(F.count("*").alias("n"))
    counts = seen.groupBy(doc_id, stem(F.col("word")).alias("term")).agg(F.sum("n").alias("tf"))
    length = F.sum("tf").over(Window.partitionBy(doc_id))
    return counts.select(doc_id, "term", "tf", length.alias("length"))


@dataclass(frozen=True)
class StoredIndex:
    """``postings`` bucketed by document and sorted by term; ``terms``: in how many documents, and how often in all."""

    postings: DataFrame
    terms: DataFrame


def store_index(
    documents: DataFrame, stop_words: list[str], path: str, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None
) -> StoredIndex:
    """The term index of the documents as a bucketed table below ``path``, and the counts of its terms.

    All postings of a document lie in one bucket, one file of which a task reads whole: scores of a
    document add up without a shuffle. Within it they are sorted by term, so that a reader skips
    what no query asks. The table is known to this session's catalog by a name of its own.
    """
    spark = documents.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"term_index_{uuid.uuid4().hex}"
    index = term_index(documents, stop_words, doc_id, text, buckets)
    index.write.bucketBy(buckets, doc_id).sortBy("term").option("path", f"{path}/postings").saveAsTable(name)
    postings = spark.table(name)
    counted = postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))
    counted.write.parquet(f"{path}/terms")
    return StoredIndex(postings, spark.read.parquet(f"{path}/terms"))


def text_rank(
    index: DataFrame | StoredIndex, n_docs: Column, queries: DataFrame, k: int, stop_words: list[str],
    doc_id: str = "doc_id", query_id: str = "query_id", query: str = "query",
) -> DataFrame:
    """The best ``k`` documents per query by BM25: ``query_id, rank, doc_id, score``.

    ``index``: a stored index, or the postings of ``term_index``; ``n_docs``: how many documents it
    covers. What the queries ask is written down first, so that Spark knows its size and, if it is
    small, broadcasts it. Scores of a stored index are then added up where its buckets are read, each task
    cuts its own list to ``k`` per query, and only those rows are shuffled. Scores are summed in whole
    millionths, so equal documents tie exactly and the id decides.
    """
    postings = index.postings if isinstance(index, StoredIndex) else index
    asked = kept_words(queries, query_id, query, stop_words).select(query_id, stem(F.col("word")).alias("term"))
    asked = asked.groupBy(query_id, "term").agg(F.count("*").alias("weight"))
    if isinstance(index, StoredIndex):
        terms = index.terms
    else:
        terms = postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))
    mean_length = terms.agg(F.sum("tf").alias("n")).scalar() / n_docs
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    wanted = asked.join(terms.select("term", "df"), "term").select(query_id, "term", (F.col("weight") * idf).alias("factor"))
    path = scratch_dir(queries.sparkSession, "asked-terms")
    wanted.write.parquet(path)
    wanted = queries.sparkSession.read.schema(wanted.schema).parquet(path)

    norm = F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / mean_length)
    part = F.col("factor") * (F.col("tf") * (BM25_K1 + 1) / norm)
    scores = (
        postings.join(wanted, "term")
        .groupBy(doc_id, query_id)
        .agg(F.sum(F.floor(part * 1e6 + 0.5)).alias("score"))
    )
    best = Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(doc_id))
    return (
        scores.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select(query_id, "rank", doc_id, (F.col("score") / 1e6).alias("score"))
    )


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    """Rows of unit length in double precision; a zero vector stays zero."""
    vectors = table.column(column).combine_chunks()
    data = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    norms = np.linalg.norm(data, axis=1)
    return data / np.where(norms == 0.0, 1.0, norms)[:, None]


def _best_pairs(tile: pa.Table, block: pa.Table, k: int, digits: int) -> pa.Table:
    """The best ``k`` rows of a tile for each query of a block: by similarity, then the smaller id."""
    out = {"query_id": [], "row_id": [], "similarity": []}
    if tile.num_rows and block.num_rows:
        ids, asked = tile.column("row_id").to_numpy(), block.column("query_id").to_numpy()
        data, unit = _matrix(tile, "v"), _matrix(block, "v")
        for start in range(0, len(asked), STRIP):
            sims = np.round(unit[start : start + STRIP] @ data.T, digits)
            least = np.partition(sims, -k, axis=1)[:, -k] if len(ids) > k else sims.min(axis=1)
            for name, row, low in zip(asked[start : start + STRIP], sims, least, strict=True):
                at = np.flatnonzero(row >= low)
                at = at[np.lexsort((ids[at], -row[at]))[:k]]
                out["query_id"].append(np.full(len(at), name))
                out["row_id"].append(ids[at])
                out["similarity"].append(row[at])
    kinds = {"query_id": np.int64, "row_id": np.int64, "similarity": np.float64}
    return pa.table({c: pa.array(np.concatenate([np.empty(0, kinds[c]), *parts])) for c, parts in out.items()})


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc("row_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "row_id", "similarity")


def _share(rows: DataFrame, key: str, size: int) -> tuple[Column, Column]:
    """Of ``rows`` cut into parts of about ``size``: the part of a row, and the numbers of all parts."""
    parts = F.greatest(F.lit(1), F.ceil(rows.agg(F.count("*").alias("n")).scalar() / size)).cast("int")
    return F.pmod(F.xxhash64(key), parts).cast("int"), F.sequence(F.lit(0), parts - 1)


def _base(rows: DataFrame, row_id: str, vector: str) -> DataFrame:
    return rows.select(F.col(row_id).cast("bigint").alias("row_id"), F.col(vector).alias("v")).filter("v is not null")


def nearest(
    rows: DataFrame, queries: DataFrame, k: int, row_id: str = "row_id", vector: str = "embedding",
    query_id: str = "query_id", query_vector: str = "query_vector", digits: int = 6,
) -> DataFrame:
    """Exact cosine neighbours: ``query_id, rank, row_id, similarity``.

    Rows are dealt to tiles and queries to blocks, both of bounded size; a task holds a tile and a block,
    scores them by one matrix product and keeps ``k`` rows per query, so only tiles x queries x k
    rows are ranked. One plan for any number of rows and queries, with nothing on the driver.
    """
    base = _base(rows, row_id, vector)
    asked = _base(queries, query_id, query_vector).withColumnRenamed("row_id", "query_id")
    tile, tiles = _share(base, "row_id", TILE_ROWS)
    block, every_block = _share(asked, "query_id", QUERY_BLOCK)
    left = base.withColumn("tile", tile).withColumn("block", F.explode(every_block))
    right = asked.withColumn("block", block).withColumn("tile", F.explode(tiles))

    def best_of(tile: pa.Table, block: pa.Table) -> pa.Table:
        return _best_pairs(tile, block, k, digits)

    keys = ("tile", "block")
    return _ranked(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best_of, NEIGHBOURS), k)


@dataclass(frozen=True)
class CellIndex:
    """Vectors stored in a folder per cell, and the cells' directions."""

    path: str
    centroids: np.ndarray

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("row_id bigint, v array<double>, cell int").parquet(self.path)


def _nearest_cells(vectors: DataFrame, centroids: np.ndarray, probes: int, key: str) -> DataFrame:
    """A row for each of a vector's ``probes`` nearest cells: the key, ``v``, ``cell``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.argsort(-(_matrix(pa.Table.from_batches([batch]), "v") @ centroids.T), axis=1, kind="stable")[:, :probes]
                for j in range(near.shape[1]):
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near[:, j].astype(np.int32))], names=[key, "v", "cell"])

    return vectors.select(key, F.col("v").cast("array<double>").alias("v")).mapInArrow(run, f"{key} bigint, v array<double>, cell int")


def store_cells(rows: DataFrame, path: str, cells: int, row_id: str = "row_id", vector: str = "embedding") -> CellIndex:
    """Vectors in a folder per cell of spherical k-means, fitted on at most ``SAMPLE_ROWS`` of them; every row is stored."""
    base = _base(rows, row_id, vector)
    sample = base.orderBy(F.xxhash64("row_id"), "row_id").limit(SAMPLE_ROWS).select("v").toArrow()
    unit = _matrix(sample, "v") if sample.num_rows else np.zeros((1, 1))
    centroids = unit[: max(1, min(cells, len(unit)))]
    for _ in range(ROUNDS):
        own = (unit @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, unit)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1.0), centroids)
    _nearest_cells(base, centroids, 1, "row_id").repartition("cell").write.partitionBy("cell").parquet(path)
    return CellIndex(path, centroids)


def nearest_in_cells(
    index: CellIndex, queries: DataFrame, k: int, probes: int, query_id: str = "query_id", query_vector: str = "query_vector", digits: int = 6
) -> DataFrame:
    """Approximate neighbours: as ``nearest``, among the rows of each query's ``probes`` nearest cells.

    Only the folders of probed cells are read; the driver sees their numbers. With as many probes as
    cells the answer is exact. Large cells are cut into tiles, many queries of a cell into blocks.
    """
    asked = _base(queries, query_id, query_vector).withColumnRenamed("row_id", "query_id")
    sent = _nearest_cells(asked, index.centroids, probes, "query_id")
    probed = sorted(r["cell"] for r in sent.select("cell").distinct().collect())
    base = index.rows(queries.sparkSession).filter(F.col("cell").isin(probed))
    tile, tiles = _share(base, "row_id", TILE_ROWS)
    block, every_block = _share(asked, "query_id", QUERY_BLOCK)
    left = base.withColumn("tile", tile).withColumn("block", F.explode(every_block))
    right = sent.withColumn("block", block).withColumn("tile", F.explode(tiles))

    def best_of(tile: pa.Table, block: pa.Table) -> pa.Table:
        return _best_pairs(tile, block, k, digits)

    keys = ("cell", "tile", "block")
    return _ranked(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best_of, NEIGHBOURS), k)
