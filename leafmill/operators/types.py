"""The generic product type of an offer: the longest term of a table that its name contains.

Of a large table neither the runs of words nor the offers are moved: a filter of bounded size (a Bloom filter)
leaves, where a name is read, the best run that may be a term. Only that one meets the terms. Names whose best run was
none after all, which the filter makes rare, are then looked up by all of their runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# What parts the words of a name.
NOT_A_WORD = r"[^\p{L}\p{N}]+"

# The filter of terms: bits for each term, at least so many and at most (16 MB), and how many of them a term sets.
TERM_BITS, LEAST_BITS, MOST_BITS, PROBES = 64, 1 << 16, 1 << 27, 6

# Of so many names, those missed by the filter, the keys may be sent to every task.
FEW_NAMES = 100_000

# Names that are looked up together hold so many words, or are one name.
GROUP_WORDS = 1 << 19


def words(text: Column) -> Column:
    """The words of a text in lower case, in order."""
    return F.filter(F.split(F.lower(text), NOT_A_WORD), lambda w: w != "")


def digest(text: Column) -> Column:
    """Half of a SHA-256, as bytes: what stands for a text, as a name, where it would have to travel."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _runs(names: DataFrame) -> DataFrame:
    """Every run of one to ``_longest`` words of ``_words``, with its length and place; the array itself is not copied."""
    lengths = F.sequence(F.lit(1), F.least(F.size("_words"), F.col("_longest")))
    sized = names.filter((F.size("_words") > 0) & (F.col("_longest") > 0)).select("*", F.explode(lengths).alias("n"))
    placed = sized.select("*", F.explode(F.sequence(F.lit(1), F.size("_words") - F.col("n") + 1)).alias("at"))
    return placed.select("name_key", F.array_join(F.slice("_words", F.col("at"), F.col("n")), " ").alias("term"), "n", "at")


def listed_terms(terms: DataFrame) -> DataFrame:
    """``term, type``: each term once, its words parted by single spaces."""
    listed = terms.select(words(F.col("term")).alias("_words"), "type").filter("size(_words) > 0 and type is not null")
    return listed.groupBy(F.array_join("_words", " ").alias("term")).agg(F.min("type").alias("type"))


class TermFilter:
    """Which runs of words may be terms, by their hashes: a Bloom filter of bounded size, however many terms there are.

    A listed term always may be one, another run now and then.
    """

    def __init__(self, listed: DataFrame, n: int):
        self.bits = LEAST_BITS
        while self.bits < min(n * TERM_BITS, MOST_BITS):
            self.bits *= 2

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes, begins = word_codes(batch.column(0))
                hashed = np.zeros(len(begins) - 1, dtype=np.uint64)
                sizes = np.diff(begins)
                for i in range(int(sizes.max(initial=0))):
                    more = np.flatnonzero(sizes > i)
                    hashed[more] = one_more(hashed[more], codes[begins[more] + i])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([self.place(hashed, i) for i in range(PROBES)]).astype(np.int64))], names=["p"])

        parts = listed.select(F.split("term", " ").alias("parts"))
        ones = F.expr("shiftleft(1L, cast(p & 63L as int))")
        found = parts.mapInArrow(places, "p bigint").groupBy(F.shiftright("p", 6).alias("id")).agg(F.bit_or(ones).alias("word")).toArrow()
        self.words = np.zeros(self.bits >> 6, dtype=np.uint64)
        self.words[found["id"].to_numpy()] = found["word"].to_numpy().view(np.uint64)

    def place(self, hashed: np.ndarray, probe: int) -> np.ndarray:
        return (hashed + np.uint64(probe) * ((hashed >> np.uint64(32)) | np.uint64(1))) & np.uint64(self.bits - 1)

    def may_be(self, hashed: np.ndarray) -> np.ndarray:
        """Indices of the hashes that may be terms."""
        left = np.arange(len(hashed))
        for probe in range(PROBES):
            p = self.place(hashed[left], probe)
            left = left[(self.words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1]
        return left


def word_codes(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of an array of arrays, and where each array begins (one more: the end)."""
    distinct = parts.flatten().dictionary_encode()
    hashes = [hashlib.blake2b(w.encode(), digest_size=8).digest() for w in distinct.dictionary.to_pylist()]
    codes = np.frombuffer(b"".join(hashes), dtype="<u8")[distinct.indices.to_numpy()]
    return codes, np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy())]).astype(np.int64)


def one_more(hashed: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of runs that go on with one more word each."""
    x = (hashed + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + codes
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def by_words(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of so many words in the last column, one row at least."""
    ends, start = np.cumsum(batch.column(batch.num_columns - 1).value_lengths().to_numpy().astype(np.int64)), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + GROUP_WORDS, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def best_runs(parts: pa.Array, longest: int, known: TermFilter) -> tuple[np.ndarray, list[str]]:
    """Of each array of words the run that may be a term and that ``types_of`` prefers; indices of arrays with one, and these."""
    codes, begins = word_codes(parts)
    flat = parts.flatten()
    letters = np.concatenate([[0], np.cumsum(pc.utf8_length(flat).to_numpy())]).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), np.diff(begins))
    ends = begins[1:][owner]
    at, hashed = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
    start, stop = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
    for n in range(1, longest + 1):
        fits = at + n <= ends[at]
        at, hashed = at[fits], hashed[fits]
        hashed = one_more(hashed, codes[at + n - 1])
        found = at[known.may_be(hashed)]
        if len(found):
            # The last of a name is the one with most letters, then the first; a longer run takes the place of a shorter one.
            order = np.lexsort((-found, letters[found + n] - letters[found], owner[found]))
            found = found[order]
            last = found[np.append(owner[found][1:] != owner[found][:-1], True)]
            start[owner[last]], stop[owner[last]] = last, last + n
    some = np.flatnonzero(stop)
    sizes = (stop - start)[some]
    ends = np.cumsum(sizes)
    chosen = flat.take(pa.array(np.arange(sizes.sum()) - np.repeat(ends - sizes, sizes) + np.repeat(start[some], sizes))).to_pylist()
    return some, [" ".join(chosen[end - size : end]) for size, end in zip(sizes.tolist(), ends.tolist(), strict=True)]


def types_of(names: DataFrame, terms: DataFrame, name: str = "name") -> DataFrame:
    """``name_key, type``: one row for every distinct name with a term in it; null names have none.

    ``terms``: term, type. Terms and names are compared word by word, whatever parts the words. Most words
    win, then most letters, then the first in the name; a term listed twice has the smaller type, a term
    without words or type counts for nothing. The runs of words meet the terms in an equi-join, so
    neither table is held anywhere; only a digest of the name travels with a run. The join is a merge:
    Spark takes exploded runs for as small as the names were, and would send them all through the driver.
    """
    listed = listed_terms(terms)
    longest = listed.select(F.coalesce(F.max(F.size(F.split("term", " "))), F.lit(0))).scalar()
    known = names.select(F.col(name).alias("_name")).filter("_name is not null").distinct()
    runs = _runs(known.select(digest(F.col("_name")).alias("name_key"), words(F.col("_name")).alias("_words"), longest.alias("_longest")))
    best = F.max_by("type", F.struct("n", F.length("term"), -F.col("at")))
    return runs.join(listed.hint("merge"), "term").groupBy("name_key").agg(best.alias("type"))


def with_types(offers: DataFrame, terms: DataFrame, name: str = "name") -> DataFrame:
    """``offers`` with ``type`` filled from the terms where it is null; null when no term is in the name.

    A name is looked up once, however many offers carry it, and its type is joined on a unique key.
    """
    untyped = offers.filter("type is null")
    found = types_of(untyped, terms, name).select(F.col("name_key").alias("_name_key"), F.col("type").alias("_type"))
    key = F.when(F.col("type").isNull(), digest(F.col(name)))
    typed = offers.withColumn("_name_key", key).join(found, "_name_key", "left")
    typed = typed.withColumn("type", F.coalesce("type", "_type"))
    return typed.select(*offers.columns)


@contextmanager
def types_in_chunks(chunks: DataFrame, terms: DataFrame, *keys: str, offers: str = "offers_data") -> Iterator[DataFrame]:
    """``keys, types``: for a chunk the types, by hash of the name, of its offers without one of their own, as ``with_types`` gives them.

    For large tables: a chunk is known by its ``keys``, and of an offer only these, a hash and one run of words are moved.
    Chunks without such an offer have no row. What is kept for the time of the context is let go at its end.
    """
    listed = listed_terms(terms).persist()
    try:
        size = listed.select(F.size(F.split("term", " ")).alias("n")).agg(F.count("*").alias("n"), F.max("n").alias("longest")).first()
        longest, known_terms = size["longest"] or 0, TermFilter(listed, size["n"])

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in by_words(batch):
                    some, found = best_runs(piece.column(piece.num_columns - 1), longest, known_terms)
                    kept = [c.take(pa.array(some)) for c in piece.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], names=[*batch.schema.names[:-1], "term"])

        untyped = chunks.select(*keys, F.explode(offers).alias("offer")).filter("offer.type is null and offer.name is not null")
        names = untyped.select(*keys, F.xxhash64("offer.name").alias("h"), F.col("offer.name").alias("name"))
        parts = names.select(*keys, "h", words(F.col("name")).alias("term"))
        runs = parts.mapInArrow(find, parts.select(*keys, "h", F.lit("").alias("term")).schema)
        known = runs.join(listed.hint("merge"), "term", "left").select(*keys, "h", "type").persist()
        try:
            typed = known.filter("type is not null")
            left = known.filter("type is null").select(*keys, "h").distinct()
            if missed := left.count():
                again = names.join(F.broadcast(left) if missed <= FEW_NAMES else left, [*keys, "h"])
                found = types_of(again, listed).withColumnRenamed("name_key", "_name_key")
                again = again.withColumn("_name_key", digest(F.col("name"))).join(found, "_name_key")
                typed = typed.unionByName(again.select(*keys, "h", "type"))
            yield typed.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("h", "type"))).alias("types"))
        finally:
            known.unpersist()
    finally:
        listed.unpersist()


def fill_types(offers: Column, types: Column) -> Column:
    """An array of offers with the types of ``types_in_chunks`` where they have none."""
    return F.transform(offers, lambda o: o.withField("type", F.coalesce(o["type"], F.element_at(types, F.xxhash64(o["name"])))))
