"""What several corpus operators share: reading tables, byte-exact words, shared scratch tables."""

from __future__ import annotations

import ctypes
import gc
import math
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from leafmill.session import scratch_dir

# Texts that are worked on together in a task hold so many bytes, or are one text.
GROUP_BYTES = 1 << 20

# What a task remembers of equal pieces takes about twice so many bytes.
MEMORY_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read again.

    Cuts lineage and spares a second computation; the files outlive a lost executor.
    """
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(key.cast("string").cast("binary")) % n


def annotate(
    documents: DataFrame, text: str, carry: list[str], schema: str, make: Callable[[], Callable[[list[bytes]], list]],
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``row`` (a struct of the carried columns) and the columns of ``schema``, computed from each whole text.

    ``make`` is called once per task and gives a function from texts to one list or array per
    column. Texts come in groups of bounded bytes; a null text counts as empty. Carried columns
    sit in a struct, so their names clash with nothing.
    """
    kinds = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            texts = texts_of(batch.column(1))
            for start, stop in by_bytes(texts, group_bytes):
                columns = compute(texts[start:stop])
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *arrays], names=["row", *kinds.names])
        release()

    asked = documents.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(text).alias("text"))
    return asked.mapInArrow(run, f"row {asked.schema['row'].dataType.simpleString()}, {schema}")


def release() -> None:
    """Freed memory back to the system, at the end of a task: workers outlive it and would hold on to it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def kept_in_worker(key: tuple, make):
    """An object that outlives the task in its Python worker, made on first use.

    Functions arrive in workers by value, so the globals of their modules don't outlive a task.
    Workers serve later stages too, so this is for loaded vocabularies only; what a task remembers of
    its texts goes with the task (see ``Memory``).
    """
    holder = sys.modules.setdefault("leafmill_worker_memory", types.ModuleType("leafmill_worker_memory"))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


class Memory:
    """Results for inputs seen before, in two generations of ``limit`` bytes each.

    ``young`` takes what is new; when it is full it becomes the older one, whose entries come back
    when they are asked for. So what recurs stays, and what doesn't is dropped.
    """

    # Of a key, a pair of values and a place in the dictionary, about.
    ENTRY = 300

    def __init__(self, limit: int | None = None):
        self.limit = MEMORY_BYTES if limit is None else limit
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def keep(self, key, value, size: int):
        """``value``, remembered; ``size``: the bytes of key and value."""
        self.size += size + self.ENTRY
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, size + self.ENTRY
        self.young[key] = value
        return value


def hashed_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """The ``limit`` rows that come first by a hash of a column, or all if there are fewer.

    A filter on the hash leaves about twice as many rows before they are sorted, so that what all
    tasks together hand over is bounded, however many tasks there are.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    n = rows.count()
    if n > 4 * limit:
        rows = rows.filter(place < math.ceil((1 << 30) * 2 * limit / n))
    return rows.orderBy(place, key).limit(limit)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 texts of an Arrow column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def by_bytes(items: list[bytes], limit: int):
    """Index ranges of consecutive texts that hold up to ``limit`` bytes, one text at least."""
    start = size = 0
    for i, item in enumerate(items):
        if size and size + len(item) > limit:
            yield start, i
            start, size = i, 0
        size += len(item)
    if start < len(items):
        yield start, len(items)


# Odd multipliers and a byte table for hashing, drawn once from a fixed seed.
_RNG = np.random.default_rng(20_240_607)
_BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


# Upper-case A-Z to lower case, other bytes as they are; and which bytes are white space.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _hash_block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~IS_SPACE[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    lengths = ends - starts
    letters = data[inside]
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(letters), dtype=np.int32) - np.repeat(firsts.astype(np.int32), lengths)
    powers = np.ones(int(lengths.max()), dtype=np.uint64)
    powers[1:] = np.multiply.accumulate(np.full(len(powers) - 1, _STEP, dtype=np.uint64))
    coded = _BYTE_CODES[letters] * powers[place]
    return mix64(np.add.reduceat(coded, firsts) + lengths.astype(np.uint64)), starts


def _space_after(data: np.ndarray, start: int, stop: int) -> int:
    """The last place in ``start..stop`` right after white space, else the first one behind ``stop``."""
    if stop >= len(data):
        return len(data)
    gaps = np.flatnonzero(IS_SPACE[data[start:stop]])
    if len(gaps):
        return start + int(gaps[-1]) + 1
    after = np.flatnonzero(IS_SPACE[data[stop:]])
    return stop + int(after[0]) + 1 if len(after) else len(data)


def word_hashes(texts: list[bytes], lower: bool, block: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and where each text's words begin (one more: the end).

    Words are runs of bytes other than the six white-space ones; with ``lower`` A-Z count as a-z. A
    word's hash is a sum over its bytes of a code times a power by place, scrambled; it depends on
    the word alone. Long texts are taken in blocks that end at white space, to bound memory.
    """
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    if lower:
        data = LOWER[data]
    hashes, places, start = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)], 0
    while start < len(data):
        stop = _space_after(data, start, start + block)
        found, at = _hash_block(data[start:stop])
        hashes.append(found)
        places.append(at + start)
        start = stop
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), begins)


def shingle_sets(words: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of many texts as sorted 64-bit hashes, and where each text's begin.

    A text of fewer words has its whole sequence as one shingle, one without words none.
    """
    sizes = np.diff(begins)
    hashes, owners = [], []
    for width in range(1, n + 1):
        chosen = np.flatnonzero(sizes == width if width < n else sizes >= n)
        if not len(chosen):
            continue
        counts = sizes[chosen] - width + 1
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) - np.repeat(ends - counts, counts) + np.repeat(begins[chosen], counts)
        total = np.full(len(at), np.uint64(width))
        for i in range(width):
            total = mix64(total * _STEP + words[at + i])
        hashes.append(total)
        owners.append(np.repeat(chosen, counts))
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.zeros(len(begins), dtype=np.int64)
    shingles, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.searchsorted(owner[new], np.arange(len(begins)))
