"""Date normalisation with built-in expressions only.

A text is cut into year, month and day by a few patterns, and the three parts
go through one ``try_to_timestamp``. That is one parse per row instead of one
failing parse per format.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leafmill.functions.binding import Known, bind, first_match, groups, in_stages

# Italian month names, January to December.
ITALIAN_MONTHS = (
    "gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno",
    "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre",
)

# Output format of a zone-less date.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

_YEAR_FIRST = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"
_DAY_FIRST = r"^(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4})$"
_MONTH_YEAR = r"^(\d{1,2})[/.\-](\d{4})$"
_MONTH_NAME = r"^(?:(\d{1,2})\s+)?(\p{L}+)\s+(\d{4})$"
_NO_YEAR = r"^(\d{1,2})(?:[/.\-](\d{1,2})|\s+(\p{L}+))$"
_STAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d"
# Fixed values: "dal 24 al 27 giugno", "dall'8 all'11 luglio", "fino al 30/06".
_TO_DAY = r"al(?:\s+|l['’]\s*)(\d{1,2})°?(?:/(\d{1,2})|\s+(\p{L}{3,}))(?:[/\s](\d{4})\b)?"
SPAN = (
    r"\bdal(?:\s+|l['’]\s*)(\d{1,2})°?(?:/(\d{1,2})|\s+(\p{L}{3,}))?(?:[/\s](\d{4})\b)?\s+" + _TO_DAY
)
UNTIL = r"\bfino\s+" + _TO_DAY


def month_number(word: Column) -> Column:
    """1..12 for an Italian month name or its three-letter short form, else null."""
    names = {name: n for n, name in enumerate(ITALIAN_MONTHS, start=1)}
    names |= {name[:3]: n for name, n in list(names.items())}
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(word)).cast("string")


def _build(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("y-M-d"))


def normalize_date(text: Column, day_of_month: str = "first", as_of: Column | None = None) -> Column:
    """Timestamp of a date text, or null unless both month and year are given.

    ``day_of_month`` says what a missing day becomes: the ``first`` or ``last`` of
    the month, or the ``current`` one, which is the day of ``as_of``.
    """
    if day_of_month not in ("first", "last", "current"):
        raise ValueError(f"day_of_month: {day_of_month}")
    if day_of_month == "current" and as_of is None:
        raise ValueError("day_of_month='current' needs as_of")

    def missing_day(opening: Column) -> Column:
        if day_of_month == "first":
            return opening
        if day_of_month == "last":
            return F.last_day(opening).cast("timestamp")
        offset = F.least(F.dayofmonth(as_of), F.dayofmonth(F.last_day(opening))) - 1
        return F.date_add(opening, offset).cast("timestamp")

    def stamp(parts: Column) -> Column:
        year, month, day = parts["year"], parts["month"], parts["day"]
        known = year.isNotNull() & month.isNotNull()
        return F.when(known & day.isNotNull(), _build(year, month, day)).when(
            known, missing_day(_build(year, month, F.lit("1")))
        )

    def parse(t: Column) -> Column:
        numeric = F.coalesce(
            groups(t, _YEAR_FIRST, year=1, month=2, day=3),
            groups(t, _DAY_FIRST, year=3, month=2, day=1),
        )
        partial = groups(t, _MONTH_YEAR, year=2, month=1).withField("day", F.lit(None).cast("string"))
        named = bind(
            groups(t, _MONTH_NAME, year=3, month=2, day=1),
            lambda m: m.withField("month", month_number(m["month"])),
        )
        parts = F.when(t.rlike(r"\p{L}"), named).otherwise(F.coalesce(numeric, partial))
        # The fields of a stamp are those of UTC, whatever the session's zone.
        moment = F.try_to_timestamp(t)
        moment = F.when(t.rlike(r"(?:[Zz]|[+-]\d{2}:?\d{2})$"), F.to_utc_timestamp(moment, F.current_timezone())).otherwise(moment)
        return F.when(t.rlike(_STAMP), moment).otherwise(bind(parts, stamp))

    return F.when(text.isNotNull(), bind(F.trim(text), parse))  # most offers have no date of their own


def iso_millis(stamp: Column) -> Column:
    """The wire form of a normalised date."""
    return F.date_format(stamp, ISO_MILLIS)


def _next_occurrence(month: Column, day: Column, as_of: Column) -> Column:
    this_year = _build(F.year(as_of).cast("string"), month, day)
    next_year = _build((F.year(as_of) + 1).cast("string"), month, day)
    return F.when(this_year >= as_of.cast("timestamp"), this_year).otherwise(next_year)


def resolve_day(text: Column, as_of: Column) -> Column:
    """A date without a year, taken as its next occurrence on or after ``as_of``."""

    def resolve(m: Column) -> Column:
        month = F.coalesce(m["month"], month_number(m["name"]))
        return F.when(month.isNotNull(), _next_occurrence(month, m["day"], as_of))

    without_year = bind(groups(F.trim(text), _NO_YEAR, day=1, month=2, name=3), resolve)
    return F.coalesce(normalize_date(text), without_year)


def _span_found(m: Known) -> Known:
    return {"low": F.lower(m["line"])}


def _span_matched(m: Known) -> Known:
    return {"span": first_match(m["low"], SPAN, ("dal",)), "until": first_match(m["low"], UNTIL, ("fino",))}


def _span_parts(m: Known) -> Known:
    def part(of_span: int, of_until: int) -> Column:
        own = F.when(m["span"] != "", F.regexp_extract(m["span"], SPAN, of_span))
        return own.when(m["until"] != "", F.regexp_extract(m["until"], UNTIL, of_until))

    start = {
        name: F.when(m["span"] != "", F.regexp_extract(m["span"], SPAN, n))
        for n, name in enumerate(("from_day", "from_month", "from_name", "from_year"), start=1)
    }
    end = {
        name: part(n + 4, n) for n, name in enumerate(("to_day", "to_month", "to_name", "to_year"), start=1)
    }
    return start | end


def _span_months(m: Known) -> Known:
    return {
        side + "_m": F.when(m[side + "_month"] != "", m[side + "_month"]).otherwise(month_number(m[side + "_name"]))
        for side in ("from", "to")
    }


def _span_this_year(m: Known) -> Known:
    return {"this_year": _build(F.year(m["as_of"]).cast("string"), m["to_m"], m["to_day"])}


def _span_end(m: Known) -> Known:
    next_year = _build((F.year(m["as_of"]) + 1).cast("string"), m["to_m"], m["to_day"])
    leaning = F.when(m["this_year"] >= m["as_of"].cast("timestamp"), m["this_year"]).otherwise(next_year)
    stated = _build(m["to_year"], m["to_m"], m["to_day"])
    return {"end": F.when(m["to_day"] != "", F.when(m["to_year"] != "", stated).otherwise(leaning))}


def _span_same_year(m: Known) -> Known:
    year = F.when(m["from_year"] != "", m["from_year"]).otherwise(F.year(m["end"]).cast("string"))
    month = F.coalesce(m["from_m"], m["to_m"])
    return {"month": month, "same_year": F.when(m["from_day"] != "", _build(year, month, m["from_day"]))}


def _span_start(m: Known) -> Known:
    year_before = _build((F.year(m["end"]) - 1).cast("string"), m["month"], m["from_day"])
    return {"start": F.when(m["same_year"] <= m["end"], m["same_year"]).when(m["from_day"] != "", year_before)}


# From ``line`` and ``as_of`` to ``start`` and ``end``.
SPAN_STAGES = (
    _span_found, _span_matched, _span_parts, _span_months, _span_this_year, _span_end, _span_same_year, _span_start,
)


def validity_span(text: Column, as_of: Column) -> tuple[Column, Column]:
    """First and last day of a "dal 24 al 27 giugno" remark, nulls when there is none.

    The end leans to the future of ``as_of``; the start is the last such day not after it. "Fino al
    30/06" has an end only.
    """
    span = in_stages(
        {"line": text, "as_of": as_of}, SPAN_STAGES,
        lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")),
    )
    return span["start"], span["end"]


def mixed_timestamp(text: Column) -> Column:
    """A time stamp written either as ISO text or as epoch milliseconds."""
    return F.when(
        text.rlike(r"^-?\d{5,}$"), F.timestamp_millis(text.try_cast("bigint"))
    ).otherwise(F.try_to_timestamp(text))
