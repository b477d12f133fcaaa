"""The fold as a stream: keyed state per flyer, one row out when its last chunk is in.

The state of an open flyer is one small value: counters, chunk numbers seen, and for
each carried field the lowest chunk that had it. That keeps the result independent of the
arrival order and equal to the batch form. A complete flyer leaves only a tombstone,
which stops redelivered chunks and expires; by then the stored-flyer test rejects the
checksum at intake. A flyer has few chunks, so rows come one by one rather than as frames.

Flyers are many and each is little work, while every call of the state operator costs messages between JVM
and Python worker and a frame of its own on the way back. So a call folds all flyers of a slot, one of a fixed number
of hash values, and their states are entries of the slot's two maps.

A chunk may be delivered many times. Of the copies that one task reads, one goes on to the state
operator; of those that reach a flyer together, the one of the earliest staging batch counts, and
none after it. The state says which copy that was, and publication takes the offers of just that copy.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import MapState
from pyspark.sql.types import DoubleType

from leafmill.operators.fold import COUNTERS
from leafmill.schemas import FOLD_INPUT, FOLD_OUTPUT

COMPLETE, INCOMPLETE = "complete", "incomplete"

OUTPUT_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FOLD_OUTPUT.fields) + ", status string"

# Fields taken from the lowest chunk that has them, each with that chunk's number.
_LOWEST = (("spot_n", ("place_id", "lat", "lon")), ("name_n", ("place_name",)), ("address_n", ("address",)))
_STATE = (
    "seen array<int>, copies array<bigint>, chunk_total int, last_n int, url string, filename string,"
    " spot_n int, place_id string, lat double, lon double, name_n int, place_name string,"
    " address_n int, address string, validity_from string, validity_to string,"
    " offers_count bigint, ai_input_tokens bigint, ai_cached_tokens bigint,"
    " ai_output_tokens bigint, processing_time_seconds double, due bigint"
)
_FIELDS = [part.split()[0] for part in _STATE.split(", ")]

_CHUNK = FOLD_INPUT.fieldNames()
_DOUBLES = [f.name for f in FOLD_INPUT.fields if isinstance(f.dataType, DoubleType)]

_DAY_MS = 24 * 60 * 60 * 1000

# Bytes of a tombstone, and into how many values a slot's are cut by age.
_DIGEST, _PERIODS = 16, 32

# Rows that a task lets gather before it looks for copies.
_PIECE = 65_536


class FlyerFold(StatefulProcessor):
    """The fold of one flyer, see the module text. ``give_up_ms`` reports a flyer still open after that time; None waits for ever."""

    def __init__(self, tombstone_ms: int = 30 * _DAY_MS, give_up_ms: int | None = _DAY_MS):
        self.tombstone_ms = tombstone_ms
        self.give_up_ms = give_up_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _STATE)
        self.done = handle.getValueState("done", "at timestamp", self.tombstone_ms)

    def handleInputRows(self, key, rows: Iterator[Row | dict], timerValues) -> Iterator[Row]:
        if self.done.exists():
            return
        stored = self.open.get() if self.open.exists() else None
        state = dict(zip(_FIELDS, stored or [None] * len(_FIELDS)))
        seen = dict(zip(state["seen"] or (), state["copies"] or (), strict=True))
        new: dict[int, Row | dict] = {}
        for row in rows:
            n = row["chunk_n"]
            if n not in seen and (n not in new or _staged(row) < _staged(new[n])):
                new[n] = row
        for n in sorted(new):
            seen[n] = new[n]["staged_batch"]
            self._add(state, new[n])
        if not seen:
            return
        state["seen"] = sorted(seen)
        state["copies"] = [seen[n] for n in state["seen"]]
        if len(seen) == state["chunk_total"]:
            yield self._row(key[0], state, COMPLETE)
            self.done.update((datetime.now(timezone.utc).replace(tzinfo=None),))
            if stored is not None:
                self.open.clear()
                for timer in list(self.handle.listTimers()) if self.give_up_ms else []:
                    self.handle.deleteTimer(timer)
            return
        if stored is None and self.give_up_ms:
            state["due"] = timerValues.getCurrentProcessingTimeInMs() + self.give_up_ms
            self.handle.registerTimer(state["due"])
        self.open.update(tuple(state[name] for name in _FIELDS))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists():
            state = dict(zip(_FIELDS, self.open.get()))
            yield self._row(key[0], state, INCOMPLETE)
            self.open.clear()  # a later chunk opens the flyer anew

    def close(self) -> None:
        pass

    @staticmethod
    def _add(state: dict, row: Row | dict) -> None:
        """Add one new chunk to the state."""
        n = row["chunk_n"]
        for name in COUNTERS:
            state[name] = (state[name] or 0) + (row[name] or 0)
        seconds = "processing_time_seconds"
        state[seconds] = (state[seconds] or 0.0) + (row[seconds] or 0.0)
        state["chunk_total"] = max(state["chunk_total"] or 0, row["chunk_total"] or 0)
        if n == 0:
            state.update(validity_from=row["validity_from"], validity_to=row["validity_to"])
        if state["last_n"] is None or n > state["last_n"]:
            state.update(last_n=n, url=row["url"], filename=row["filename"])
        for number, columns in _LOWEST:
            values = {c: row[c] for c in columns}
            if any(v is not None for v in values.values()) and (state[number] is None or n < state[number]):
                state.update(values)
                state[number] = n

    @staticmethod
    def _row(checksum: str, state: dict, status: str) -> Row:
        copies = [Row(chunk_n=n, staged_batch=b) for n, b in zip(state["seen"], state["copies"], strict=True)]
        values = {**state, "checksum": checksum, "chunks_seen": len(copies), "copies": copies, "status": status}
        return Row(**{name: values[name] for name in (*FOLD_OUTPUT.fieldNames(), "status")})


def _staged(row: Row | dict) -> tuple:
    return row["staged_batch"] is None, row["staged_batch"] or 0


class _Entry:
    """What a map state holds for the flyer at hand, used like a value state."""

    def __init__(self, states: MapState):
        self.states = states
        self.key: tuple = ()
        self.empty = False

    def exists(self) -> bool:
        return not self.empty and self.states.containsKey(self.key)

    def get(self) -> tuple | None:
        return self.states.getValue(self.key)

    def update(self, value: tuple) -> None:
        self.states.updateValue(self.key, value)

    def clear(self) -> None:
        self.states.removeKey(self.key)


class _Tombstones:
    """Digests of a slot's complete flyers, one value for each of ``_PERIODS`` parts of their life, used like a value state.

    They are read in one go and a call adds to the current period only. A period expires as a whole, a life after
    its last tombstone.
    """

    def __init__(self, states: MapState, life_ms: int):
        self.states = states
        self.span = max(1, life_ms // _PERIODS)
        self.key: tuple = ()

    def load(self, now: int) -> None:
        periods = {period: bytes(digests) for (period,), (digests,) in self.states.iterator()}
        self.period, self.added = now // self.span, []
        self.current = periods.get(self.period, b"")
        self.known = {d[i : i + _DIGEST] for d in periods.values() for i in range(0, len(d), _DIGEST)}

    def save(self) -> None:
        if self.added:
            self.states.updateValue((self.period,), (self.current + b"".join(self.added),))

    def exists(self) -> bool:
        return self._digest() in self.known

    def update(self, value: tuple) -> None:
        self.added.append(self._digest())

    def _digest(self) -> bytes:
        return blake2b(self.key[0].encode(), digest_size=_DIGEST).digest()


class SlotFold(StatefulProcessor):
    """``FlyerFold`` for every flyer of a slot in one call; to that fold the slot is its handle.

    Rows carry a task's chunks of the slot as JSON, as a worker reads a row cell by cell. A flyer that comes whole to a slot without open
    ones costs no message of its own. A slot has one timer, for the open flyer that is due first.
    """

    def __init__(self, tombstone_ms: int = 30 * _DAY_MS, give_up_ms: int | None = _DAY_MS):
        self.fold = FlyerFold(tombstone_ms, give_up_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        life = self.fold.tombstone_ms
        self.open = _Entry(handle.getMapState("open", "checksum string", _STATE))
        self.done = _Tombstones(handle.getMapState("done", "period bigint", "digests binary", life), life)
        self.due: list[int] = []
        self.fold.handle, self.fold.open, self.fold.done = self, self.open, self.done

    def registerTimer(self, at: int) -> None:
        self.due.append(at)

    def listTimers(self) -> Iterator[int]:
        return iter(())  # the slot's timer serves other flyers, too

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        flyers: dict[str, list[dict]] = {}
        for row in rows:
            for text in row["chunks"]:
                chunk = _chunk(text)
                flyers.setdefault(chunk["checksum"], []).append(chunk)
        self.open.empty = not self.open.states.exists()
        self.done.load(timerValues.getCurrentProcessingTimeInMs())
        for checksum, chunks in flyers.items():
            yield from self.fold.handleInputRows(self._at(checksum), iter(chunks), timerValues)
        self.done.save()
        self._set_timer()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, gone = timerValues.getCurrentProcessingTimeInMs(), []
        for (checksum,), value in self.open.states.iterator():
            due = value[_FIELDS.index("due")]
            if due is not None and due <= now:
                gone.append(checksum)
            elif due is not None:
                self.due = [min([due, *self.due])]
        self.open.empty = False
        for checksum in gone:
            yield from self.fold.handleExpiredTimer(self._at(checksum), timerValues, expiredTimerInfo)
        self._set_timer(now)

    def close(self) -> None:
        pass

    def _at(self, checksum: str) -> tuple[str]:
        """Turn the states to a flyer; its key."""
        self.open.key = self.done.key = (checksum,)
        return (checksum,)

    def _set_timer(self, after: int = -1) -> None:
        """A timer for the first of ``due``, unless one fires ``after`` a time and by then."""
        if self.due:
            first = min(self.due)
            if not any([after < at <= first for at in self.handle.listTimers()]):
                self.handle.registerTimer(first)
            self.due = []


def _chunk(text: str) -> dict:
    """A ``FOLD_INPUT`` row from Spark's JSON, which leaves out nulls and quotes doubles that are no numbers."""
    chunk = dict.fromkeys(_CHUNK) | json.loads(text)
    for name in _DOUBLES:
        if isinstance(chunk[name], str):
            chunk[name] = float(chunk[name])
    return chunk


def _first(rows: pa.Table) -> pa.Table:
    """Of the copies of a chunk the first of the earliest staging batch, rows in the order of slots; nulls come last."""
    keys = ("slot", "checksum", "chunk_n")
    rows = rows.take(pc.sort_indices(rows, sort_keys=[(k, "ascending") for k in (*keys, "staged_batch")]))
    new = np.zeros(max(0, len(rows) - 1), dtype=bool)
    for key in keys:
        column = rows.column(key)
        here, before = column.slice(1), column.slice(0, max(0, len(rows) - 1))
        differ = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(pc.is_null(here), pc.is_null(before)))
        new |= differ.to_numpy()
    return rows.filter(pa.array(np.concatenate([[True], new])[: len(rows)], pa.bool_()))


def first_per_task(chunks: DataFrame) -> DataFrame:
    """``slot, chunks``: a row per slot and task, with the first of the earliest staging batch of each chunk's copies.

    ``chunks``: slot, checksum, chunk_n, staged_batch, chunk; rows without a number go. A million copies of a chunk
    leave one a task for the shuffle. A task holds one narrow row for each chunk of its part of a micro-batch until it
    ends, and as many again, or ``_PIECE``, that are still to be looked through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, n = None, [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= max(_PIECE, 0 if held is None else len(held)):
                held, waiting, n = _first(pa.Table.from_batches([*(held.to_batches() if held else []), *waiting])), [], 0
        if waiting:
            held = _first(pa.Table.from_batches([*(held.to_batches() if held else []), *waiting]))
        if held:
            held = held.combine_chunks()
            slots = held.column("slot").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
            bounds = pa.array(np.append(starts, len(slots)), pa.int32())
            lists = pa.ListArray.from_arrays(bounds, held.column("chunk").combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array(slots[starts], pa.int32()), lists], ["slot", "chunks"])

    return chunks.filter(F.col("chunk_n").isNotNull()).mapInArrow(run, "slot int, chunks array<string>")


def fold_stream(
    chunks: DataFrame, tombstone_ms: int = 30 * _DAY_MS, give_up_ms: int | None = _DAY_MS, slots: int = 4_096
) -> DataFrame:
    """Folded flyers (``FOLD_OUTPUT`` and ``status``) of a stream of ``FOLD_INPUT`` rows.

    A task holds a slot's narrow rows of one micro-batch at a time. ``slots`` belongs to the checkpoint
    and must not change. Needs the RocksDB state store provider, see ``leafmill.session``.
    """
    slot = F.pmod(F.xxhash64("checksum"), F.lit(slots)).cast("int").alias("slot")
    chunk = F.to_json(F.struct(*_CHUNK)).alias("chunk")
    first = first_per_task(chunks.select(slot, "checksum", "chunk_n", "staged_batch", chunk))
    return first.groupBy("slot").transformWithState(
        statefulProcessor=SlotFold(tombstone_ms, give_up_ms),
        outputStructType=OUTPUT_DDL,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
