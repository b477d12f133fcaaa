"""Near-duplicate documents by min-max hashing.

Under each hash permutation both the least and the greatest shingle are kept, so a signature
needs half the hash evaluations. Bands of signature values put documents into buckets. Members of
a bucket are tried against one leader first. Buckets that still hold different components are
compared whole, block by block inside tasks, which give back links between components only, so
pairs of a group are never made as rows. Every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import by_bytes, mix64, shingle_sets, stored, texts_of, word_hashes
from leafmill.llm.components import components

# A pair at the threshold of 0.8 shares no band of 7 values with probability (1 - 0.8 ** 7) ** 56 < 2e-6.
BANDS, ROWS = 56, 7
BATCH_BYTES = 1 << 18
# Documents of a bucket in one block of a comparison.
BLOCK = 512
# Bits of the filter that keeps texts nobody asks for out of the shuffle: its broadcast is 2 MB at any
# input size. With very many ids it only lets more texts pass.
FILTER_BITS = 1 << 23

_RNG = np.random.default_rng(7)
_FACTORS = _RNG.integers(1, 2**32, BANDS * ROWS // 2, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _RNG.integers(0, 2**32, BANDS * ROWS // 2, dtype=np.uint32)


def min_max_signature(shingles: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One row per text that has shingles: least and greatest value under each permutation of 32 bits."""
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    starts = begins[:-1][np.diff(begins) > 0]
    out = np.empty((len(starts), 2 * len(_FACTORS)), dtype=np.uint32)
    for i, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS, strict=True)):
        values = folded * factor + shift
        values ^= values >> np.uint32(15)
        out[:, 2 * i] = np.minimum.reduceat(values, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(values, starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """64-bit bucket keys, one per band."""
    grouped = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2])
    for i in range(ROWS):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, i])
    return keys


def signatures(documents: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, f1, f2, bands``: set size, a 128-bit fingerprint of the set, bucket keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for start, stop in by_bytes(texts, BATCH_BYTES):
                shingles, begins = shingle_sets(*word_hashes(texts[start:stop], lower=True), n)
                sizes = np.diff(begins)
                some = sizes > 0
                prints = np.zeros((2, len(sizes)), dtype=np.uint64)
                keys = np.empty((0, BANDS), dtype=np.uint64)
                if some.any():
                    for row, values in zip(prints, (mix64(shingles), mix64(shingles ^ np.uint64(0x5DEECE66D))), strict=True):
                        row[some] = np.add.reduceat(values, begins[:-1][some])
                    keys = band_keys(min_max_signature(shingles, begins))
                offsets = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(sizes.astype(np.int64)),
                     *(pa.array(p.view(np.int64)) for p in prints), bands],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands"],
                )

    return documents.mapInArrow(sign, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>")


def texts_for(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is among ``ids`` (``doc_id``), and a few more, without a shuffle of texts."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    words = ids.select(place(F.col("doc_id")).alias("bit")).select(
        F.shiftright("bit", 6).alias("_word"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("mask")
    ).groupBy("_word").agg(F.bit_or("mask").alias("_mask"))
    bit = place(F.col("doc_id"))
    marked = documents.withColumn("_word", F.shiftright(bit, 6)).withColumn("_bit", (bit % 64).cast("int"))
    # At most FILTER_BITS / 64 rows.
    asked = F.expr("shiftright(_mask, _bit) & 1L") == 1
    return marked.join(F.broadcast(words), "_word").filter(asked).select("doc_id", "text")


def confirmed(pairs: DataFrame, documents: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` whose full shingle sets are similar enough.

    Both joins move texts by id at every input size, so that the plan is the same for all.
    """
    first = texts_for(documents, pairs.select(F.col("a").alias("doc_id")))
    second = texts_for(documents, pairs.select(F.col("b").alias("doc_id")))
    first = first.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge")
    second = second.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).hint("merge")
    both = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown, sets = b"", np.empty(0, dtype=np.uint64)
        for batch in batches:
            keep = []
            for left, right in zip(texts_of(batch.column(2)), texts_of(batch.column(3)), strict=True):
                if right != shown:  # rows with one leader come one after the other
                    shown, sets = right, shingle_sets(*word_hashes([right], lower=True), n)[0]
                own = shingle_sets(*word_hashes([left], lower=True), n)[0]
                common = len(np.intersect1d(own, sets, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (len(own) + len(sets) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(confirm, "a bigint, b bigint")


def near_duplicates(
    documents: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Texts are linked when 100 * shared >= percent * all of their distinct ``n``-word shingles
    (A-Z as a-z). A text of fewer words is one shingle; null and wordless texts are linked with
    nothing. ``component_id`` is the least id that links lead to, and that document is kept.
    A row without id has no component and is kept. Repeated rows get a row each with equal
    values. No rows: no rows.
    """
    docs = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = stored(signatures(docs, n), "signatures")
    known = docs.filter("doc_id is not null")

    # Equal sets are one class, and its least document stands for it.
    prints = ["n_shingles", "f1", "f2"]
    sets = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = sets.groupBy(*prints).agg(F.min("doc_id").alias("rep"))
    members = stored(sets.select("doc_id", *prints).join(classes, prints).select("doc_id", "rep").distinct(), "classes")
    standing = members.filter("doc_id = rep").select("doc_id")
    rows = signed.join(standing, "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), F.explode("bands").alias("key"))
    leaders = rows.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).filter("leader < last")
    buckets = stored(rows.join(leaders.select("key", "leader"), "key").select("key", "rep", "leader"), "buckets")

    star = stored(buckets.filter("rep > leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct(), "star")
    links = stored(confirmed(star, known, n, percent), "links")
    rows = stored(_open_rows(buckets, components(links)), "open")
    links = links.union(stored(_across_components(rows, known, n, percent), "links"))
    linked = stored(components(links), "components")

    known_class = members.select("doc_id", "rep").join(
        linked.select(F.col("node").alias("rep"), "component"), "rep", "left"
    ).select("doc_id", F.coalesce("component", "rep").alias("component")).groupBy("doc_id").agg(F.min("component").alias("component"))
    named = signed.select("doc_id", "n_shingles").join(known_class, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return named.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_representatives(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents`` (``doc_id, text`` and others) that stand for their group, all columns as they were.

    Rows without id stay; of repeated rows of a representative one per distinct text stays.
    """
    named = near_duplicates(documents, n, percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    with_id = documents.filter("doc_id is not null").select(row, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"))
    kept = with_id.join(named.select(F.col("doc_id").alias("_id")), "_id", "left_semi")
    # By the partitioning of the join, so without a shuffle of its own.
    kept = kept.dropDuplicates(["_id", "_text"]).select("row.*")
    return kept.union(documents.filter("doc_id is null").select(row).select("row.*"))


def _open_rows(buckets: DataFrame, linked: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component: ``key, rep, component``."""
    named = buckets.join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = named.select("key", "rep", F.coalesce("component", "rep").alias("component"))
    open_keys = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return named.join(open_keys.filter("low < high").select("key"), "key", "left_semi")


def _across_components(rows: DataFrame, documents: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between components that meet in a bucket, one per document and other component.

    A bucket of many rows is cut into blocks, and a task compares two blocks (or one with
    itself) through an inverted list of their shingles.
    """
    counts = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = rows.join(counts, "key")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    placed = placed.select("key", "rep", "component", own.alias("own"), other)
    texts = texts_for(documents, rows.select(F.col("rep").alias("doc_id"))).select(F.col("doc_id").alias("rep"), "text").hint("merge")

    def compare(group: pa.Table) -> pa.Table:
        ids, parts = group.column("rep").to_numpy(), group.column("component").to_numpy()
        shingles, begins = shingle_sets(*word_hashes(texts_of(group.column("text").combine_chunks()), lower=True), n)
        sizes = np.diff(begins)
        by_value = np.argsort(shingles, kind="stable")
        values, holders = shingles[by_value], np.repeat(np.arange(len(ids)), sizes)[by_value]
        found = [np.empty((2, 0), dtype=np.int64)]
        for i in range(len(ids)):
            held = shingles[begins[i] : begins[i + 1]]
            low, high = np.searchsorted(values, held), np.searchsorted(values, held, side="right")
            lengths = high - low
            at = np.arange(lengths.sum()) + np.repeat(low - np.cumsum(lengths) + lengths, lengths)
            common = np.bincount(holders[at], minlength=len(ids))
            close = (common > 0) & (parts != parts[i]) & (100 * common >= percent * (sizes + sizes[i] - common))
            if close.any():
                near = ids[close][np.unique(parts[close], return_index=True)[1]]
                found.append(np.stack([np.full(len(near), ids[i]), near]))
        a, b = np.concatenate(found, axis=1)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    grouped = placed.join(texts, "rep").select(
        "key", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "rep", "component", "text"
    ).groupBy("key", "first", "second")
    return grouped.applyInArrow(compare, "a bigint, b bigint")
