import datetime as dt

import pytest
from pyspark.sql import functions as F

from leafmill.functions.dates import iso_millis, mixed_timestamp, normalize_date, resolve_day, validity_span


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "day", "expected"),
    [
        ("2025-06-28", "first", "2025-06-28T00:00:00.000Z"),
        (" 28/06/2025 ", "last", "2025-06-28T00:00:00.000Z"),
        ("1.2.2025", "first", "2025-02-01T00:00:00.000Z"),
        ("28 giugno 2025", "first", "2025-06-28T00:00:00.000Z"),
        ("28 GIU 2025", "first", "2025-06-28T00:00:00.000Z"),
        ("giugno 2025", "first", "2025-06-01T00:00:00.000Z"),
        ("giugno 2025", "last", "2025-06-30T00:00:00.000Z"),
        ("febbraio 2024", "last", "2024-02-29T00:00:00.000Z"),
        ("06/2025", "last", "2025-06-30T00:00:00.000Z"),
        ("2025-06-28T10:30:00.000+02:00", "first", "2025-06-28T08:30:00.000Z"),
        ("28 giugno", "first", None),
        ("31/02/2025", "first", None),
        ("28 brumaio 2025", "first", None),
        ("presto", "first", None),
        ("   ", "first", None),
        (None, "first", None),
    ],
)
def test_normalize(spark, text, day, expected):
    assert one(spark, iso_millis(normalize_date(F.lit(text).cast("string"), day))) == expected


def test_current_day_is_that_of_the_context(spark):
    as_of = F.lit("2025-03-31").cast("date")
    assert one(spark, iso_millis(normalize_date(F.lit("giugno 2025"), "current", as_of))).startswith("2025-06-30")
    with pytest.raises(ValueError):
        normalize_date(F.lit("giugno 2025"), "current")
    with pytest.raises(ValueError):
        normalize_date(F.lit("giugno 2025"), "middle")


@pytest.mark.parametrize(
    ("text", "expected"),
    [("28/06", "2025-06-28"), ("28 giugno", "2025-06-28"), ("1 gennaio", "2026-01-01"), ("giugno", None)],
)
def test_missing_year_leans_to_the_future(spark, text, expected):
    found = resolve_day(F.lit(text), F.lit("2025-06-20").cast("date"))
    assert one(spark, F.date_format(found, "yyyy-MM-dd")) == expected


@pytest.mark.parametrize(
    ("text", "start", "end"),
    [
        ("Offerta valida dal 28/06 al 30/06", "2025-06-28", "2025-06-30"),
        ("Valida dal 24 al 27 giugno", "2025-06-24", "2025-06-27"),
        ("dal 28 dicembre al 3 gennaio", "2025-12-28", "2026-01-03"),
        ("dal 1/2/2026 al 5/3/2026", "2026-02-01", "2026-03-05"),
        ("dall'8 all'11 luglio", "2025-07-08", "2025-07-11"),
        ("dal 25 luglio all’1 agosto 2026", "2026-07-25", "2026-08-01"),
        ("fino al 30/06", None, "2025-06-30"),
        ("Fino all'8 luglio 2026", None, "2026-07-08"),
        ("fino al 20 percento", None, None),
        ("fino ad esaurimento scorte", None, None),
    ],
)
def test_span(spark, text, start, end):
    found = validity_span(F.lit(text), F.lit("2025-06-20").cast("date"))
    row = spark.range(1).select(*[F.date_format(c, "yyyy-MM-dd") for c in found]).first()
    assert tuple(row) == (start, end)


def test_mixed_timestamp(spark):
    stamp = dt.datetime(2025, 6, 28, 10, 0)
    assert one(spark, mixed_timestamp(F.lit("2025-06-28T10:00:00.000Z")).cast("timestamp_ntz")) == stamp
    assert one(spark, mixed_timestamp(F.lit("1751104800000")).cast("timestamp_ntz")) == stamp
    assert one(spark, mixed_timestamp(F.lit("soon"))) is None
