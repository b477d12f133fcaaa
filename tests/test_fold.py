"""The fold: scenarios, order independence, and stream against batch."""

import json
import random

import pytest
from pyspark.sql import Row, functions as F

from leafmill.operators.fold import fold_batch, fold_totals, incomplete_flyers
from leafmill.schemas import FOLD_INPUT, FOLD_OUTPUT
from leafmill.session import scratch_dir, streaming_session
from leafmill.streaming.flow import finish
from leafmill.streaming.fold import COMPLETE, INCOMPLETE, FlyerFold, SlotFold, fold_stream

NAMES = FOLD_INPUT.fieldNames()
OUT = [n for n in FOLD_OUTPUT.fieldNames()]


def chunk(key, n, total, tokens=1, start=None, pid=None, name=None):
    row = dict.fromkeys(NAMES)
    row.update(
        checksum=key, chunk_n=n, chunk_total=total, url=f"u/{key}", filename=f"{key}.pdf", place_id=pid,
        place_name=name, validity_from=start, validity_to=start, offers_count=2, ai_input_tokens=tokens,
        ai_cached_tokens=0, ai_output_tokens=3, processing_time_seconds=0.5,
    )
    return tuple(row[n] for n in NAMES)


def frame(spark, rows):
    return spark.createDataFrame(rows, FOLD_INPUT)


def test_scenarios(spark):
    rows = [
        chunk("two", 0, 2, start="d0"), chunk("two", 1, 2, start="d1"),
        chunk("gap", 0, 3), chunk("gap", 2, 3),
        chunk("one", 0, 1, tokens=None),
        chunk("null", 0, 2, tokens=None), chunk("null", 1, 2, tokens=5),
        chunk("headless", 0, 2), chunk("headless", 1, 2, start="d1"),
        chunk("late", 0, 2), chunk("late", 1, 2, pid="p1", name="n1"),
        chunk("twice", 0, 2), chunk("twice", 0, 2), chunk("twice", 1, 2),
    ]
    got = {r["checksum"]: r for r in fold_batch(frame(spark, rows)).collect()}
    assert set(got) == {"two", "one", "null", "headless", "late", "twice"}
    assert got["two"]["validity_from"] == "d0" and got["headless"]["validity_from"] is None
    assert got["null"]["ai_input_tokens"] == 5 and got["one"]["ai_input_tokens"] == 0
    assert (got["late"]["place_id"], got["late"]["place_name"]) == ("p1", "n1")
    assert (got["twice"]["chunks_seen"], got["twice"]["offers_count"]) == (2, 4)
    gone = [tuple(r) for r in incomplete_flyers(frame(spark, rows)).collect()]
    assert gone == [("gap", 2, 3)]


def test_first_arrival_counts(spark):
    rows = frame(spark, [chunk("a", 0, 1, tokens=7), chunk("a", 0, 1, tokens=9)])
    rows = rows.withColumn("arrival", -F.col("ai_input_tokens"))
    assert fold_batch(rows, "arrival").first()["ai_input_tokens"] == 9


class FakeState:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class FakeHandle:
    def __init__(self):
        self.states, self.timers = {}, []

    def getValueState(self, name, schema, ttl=None):
        return self.states.setdefault(name, FakeState())

    def registerTimer(self, at):
        self.timers.append(at)

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)


class FakeClock:
    def getCurrentProcessingTimeInMs(self):
        return 1_000


def fold_in_memory(rows, cuts, **options):
    """The processor over chosen micro-batches of one flyer, without a stream around it."""
    handle, out = FakeHandle(), []
    processor = FlyerFold(**options)
    processor.init(handle)
    for start, end in zip([0, *cuts], [*cuts, len(rows)]):
        if start < end:
            batch = [Row(**dict(zip(NAMES, values))) for values in rows[start:end]]
            out += list(processor.handleInputRows((rows[0][0],), iter(batch), FakeClock()))
    return processor, handle, out


def test_any_order_copies_and_cuts_give_the_batch_row(spark):
    rng = random.Random(7)
    cases, batch_rows = [], []
    for i in range(60):
        key, total = f"k{i}", rng.randint(1, 6)
        chunks = [
            chunk(
                key, n, total, rng.choice([None, 1, 5]), rng.choice([None, "d"]), rng.choice([None, f"p{n}"]),
                rng.choice([None, f"n{n}"]),
            )
            for n in range(total)
        ]
        batch_rows += chunks
        arrivals = chunks + rng.choices(chunks, k=rng.randint(0, 4))
        rng.shuffle(arrivals)
        cases.append((arrivals, sorted(rng.choices(range(len(arrivals) + 1), k=rng.randint(0, 3)))))
    expected = {r["checksum"]: r for r in fold_batch(frame(spark, batch_rows)).collect()}
    for arrivals, cuts in cases:
        _, handle, out = fold_in_memory(arrivals, cuts)
        assert len(out) == 1
        got = out[0]
        assert {n: got[n] for n in OUT} == expected[arrivals[0][0]].asDict()
        assert not handle.states["open"].exists() and handle.states["done"].exists()


def test_redelivery_and_timer():
    rows = [chunk("a", 0, 2), chunk("a", 1, 2), chunk("a", 0, 2), chunk("a", 1, 2)]
    _, handle, out = fold_in_memory(rows, [1, 2], give_up_ms=500)
    assert len(out) == 1 and out[0]["status"] == COMPLETE
    assert handle.timers == []

    processor, handle, out = fold_in_memory([chunk("b", 1, 2)], [], give_up_ms=500)
    assert out == [] and handle.timers == [1_500]
    late = list(processor.handleExpiredTimer(("b",), FakeClock(), None))
    assert late[0]["status"] == INCOMPLETE and late[0]["chunks_seen"] == 1


@pytest.fixture
def staged(spark):
    root = scratch_dir(spark, "test-fold")
    rows = [chunk(f"k{i}", n, 3, tokens=i, start=f"d{n}") for i in range(20) for n in range(3)]
    return root, rows


def start(session, root, per_batch=1):
    stream = session.readStream.schema(FOLD_INPUT).option("maxFilesPerTrigger", per_batch).parquet(f"{root}/in")
    return (
        fold_stream(stream).writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )


def test_restart_loses_and_repeats_nothing(spark, staged):
    root, rows = staged
    session = streaming_session(spark, drain=True)
    frame(spark, [r for r in rows if r[1] != 1]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    finish(start(session, root))
    assert spark.read.parquet(f"{root}/out").count() == 0
    # The second run begins from the checkpoint: the missing chunks, then everything again.
    frame(spark, [r for r in rows if r[1] == 1]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    finish(start(session, root))
    frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{root}/in")
    finish(start(session, root))
    got = spark.read.parquet(f"{root}/out").select(*OUT)
    assert got.count() == 20
    assert got.exceptAll(fold_totals(frame(spark, rows))).count() == 0


class FakeMap:
    def __init__(self):
        self.values, self.calls = {}, 0

    def exists(self):
        self.calls += 1
        return bool(self.values)

    def containsKey(self, key):
        self.calls += 1
        return key in self.values

    def getValue(self, key):
        self.calls += 1
        return self.values.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.values[key] = value

    def removeKey(self, key):
        self.calls += 1
        self.values.pop(key, None)

    def iterator(self):
        self.calls += 1
        return iter(list(self.values.items()))


class FakeSlot(FakeHandle):
    def getMapState(self, name, key, schema, ttl=None):
        return self.states.setdefault(name, FakeMap())


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def slot(**options):
    handle, processor = FakeSlot(), SlotFold(**options)
    processor.init(handle)

    def call(rows, now=1_000):
        texts = [json.dumps({n: v for n, v in zip(NAMES, row) if v is not None}) for row in rows]
        return list(processor.handleInputRows((0,), iter(Row(slot=0, chunks=texts[i : i + 7]) for i in range(0, len(texts), 7)), Clock(now)))

    def expire(now):
        out = list(processor.handleExpiredTimer((0,), Clock(now), None))
        handle.timers = [at for at in handle.timers if at > now]
        return out

    return handle, call, expire


def test_flyers_of_a_slot_do_not_cost_a_message_each():
    handle, call, _ = slot()
    rows = [chunk(f"k{i}", n, 3) for i in range(500) for n in range(3)]
    assert len(call(rows)) == 500 and call(rows) == []
    assert sum(state.calls for state in handle.states.values()) <= 6 and not handle.timers


def test_a_slot_gives_the_rows_of_its_flyers():
    rng = random.Random(11)
    rows, cuts = [], []
    for i in range(40):
        total = rng.randint(1, 5)
        rows += [chunk(f"k{i}", n, total, rng.choice([None, 2**60 + n]), rng.choice([None, "d"]), rng.choice([None, f"p{n}"]))
                 for n in range(total)]
    arrivals = rows + rng.choices(rows, k=50)
    rng.shuffle(arrivals)
    cuts = [0, *sorted(rng.choices(range(len(arrivals)), k=4)), len(arrivals)]
    handle, call, _ = slot()
    out = [row for start, end in zip(cuts, cuts[1:]) for row in call(arrivals[start:end])]
    alone = [fold_in_memory([r for r in arrivals if r[0] == f"k{i}"], [])[2][0] for i in range(40)]
    assert sorted(out, key=lambda r: r["checksum"]) == sorted(alone, key=lambda r: r["checksum"])
    assert not handle.states["open"].values


def test_tombstones_are_kept_by_period():
    handle, call, _ = slot(tombstone_ms=32_000)
    for number in range(4):
        assert len(call([chunk(f"k{number}", 0, 1)], now=600 * number)) == 1
    assert {k: len(v[0]) for k, v in handle.states["done"].values.items()} == {(0,): 32, (1,): 32}
    assert call([chunk(f"k{number}", 0, 1) for number in range(4)], now=2_500) == []


def test_one_timer_a_slot_serves_all_open_flyers():
    handle, call, expire = slot(give_up_ms=500)
    call([chunk("a", 0, 2), chunk("b", 0, 2), chunk("c", 0, 2)], now=1_000)
    call([chunk("d", 0, 2)], now=1_200)
    call([chunk("b", 1, 2)], now=1_300)
    assert handle.timers == [1_500]
    assert sorted(r["checksum"] for r in expire(1_500)) == ["a", "c"] and handle.timers == [1_700]
    assert [(r["checksum"], r["status"]) for r in expire(1_700)] == [("d", INCOMPLETE)] and handle.timers == []


def test_json_keeps_what_doubles_and_longs_hold(spark):
    root = scratch_dir(spark, "test-json")
    session = streaming_session(spark, drain=True)
    rows = []
    for i, (lat, lon) in enumerate([(float("nan"), float("-inf")), (0.1 + 0.2, -0.0), (None, 1e-320)]):
        row = dict(zip(NAMES, chunk(f"k{i}", 0, 1, tokens=2**62 + 1, name='"\\\n\u2028')))
        rows.append(tuple((row | {"lat": lat, "lon": lon}).values()))
    frame(spark, rows).write.parquet(f"{root}/in")
    finish(start(session, root, per_batch=9))
    got, wanted = spark.read.parquet(f"{root}/out").select(*OUT), fold_totals(frame(spark, rows))
    assert got.count() == 3 and got.exceptAll(wanted).count() == 0


def test_a_standing_slot_gives_up_on_each_flyer_in_turn(spark):
    import time

    root = scratch_dir(spark, "test-turns")
    session = streaming_session(spark)
    frame(spark, [chunk("a", 0, 2)]).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = session.readStream.schema(FOLD_INPUT).parquet(f"{root}/in")
    running = (
        fold_stream(stream, give_up_ms=6_000, slots=1).writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").start()
    )
    try:
        gone, until = [], time.time() + 90
        while len(gone) < 2 and time.time() < until:
            time.sleep(1)
            assert running.isActive, running.exception()
            if running.lastProgress and not gone and not spark.read.parquet(f"{root}/in").filter("checksum = 'b'").count():
                frame(spark, [chunk("b", 0, 2)]).coalesce(1).write.mode("append").parquet(f"{root}/in")
            gone = spark.read.schema("checksum string, status string").parquet(f"{root}/out").collect()
    finally:
        running.stop()
    assert sorted(tuple(r) for r in gone) == [("a", INCOMPLETE), ("b", INCOMPLETE)]


def test_a_task_sends_a_row_for_each_slot(spark):
    from leafmill.streaming import fold

    columns = "slot int, checksum string, chunk_n int, staged_batch bigint, chunk string"
    rows = [(k % 2, f"k{k}", n, staged, f"{k}/{n}/{staged}") for staged in (None, 5, 3, 9) for k in range(4) for n in range(50)]
    rows += [(0, None, 1, None, "x"), (0, None, 1, 2, "y"), (1, "k1", None, 0, "no number")]
    got = fold.first_per_task(spark.createDataFrame(rows, columns).coalesce(1)).collect()
    wanted = {s: {f"{k}/{n}/3" for k in range(4) if k % 2 == s for n in range(50)} for s in (0, 1)}
    wanted[0].add("y")
    assert len(got) == 2 and {r["slot"]: set(r["chunks"]) for r in got} == wanted
    assert sum(len(r["chunks"]) for r in got) == 201
