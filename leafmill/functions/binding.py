"""Small helpers to build expressions that read a value more than once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Named values of a row, and a step that computes more of them from those known so far.
Known = dict[str, Column]
Stage = Callable[[Known], Known]


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column used in several branches is otherwise computed in each of them, and nested
    uses multiply until the generated method is too large to compile.
    """
    return F.transform(F.array(value), body)[0]


def mentions(text: Column, words: tuple[str, ...]) -> Column:
    """Does the text contain one of the words? Far cheaper than a pattern that needs it."""
    return reduce(Column.__or__, [text.contains(word) for word in words])


def groups(text: Column, pattern: str, needs: tuple[str, ...] = (), **wanted: int) -> Column:
    """Struct of named groups of the first match; null when there is no match.

    The text is searched once, and only if it has one of the words in ``needs``. The groups
    are then read off the match itself, so the pattern must not look behind it. A group
    that took no part is null.
    """

    def read(match: Column) -> Column:
        parts = F.struct(*[F.regexp_extract(match, pattern, n).alias(name) for name, n in wanted.items()])
        filled = bind(
            parts, lambda s: F.struct(*[F.when(s[name] != "", s[name]).alias(name) for name in wanted])
        )
        return F.when(match != "", filled)

    return bind(first_match(text, pattern, needs), read)


def first_match(text: Column, pattern: str, needs: tuple[str, ...] = (), group: int = 0) -> Column:
    """The first match, or the empty string."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(mentions(text, needs), found).otherwise("") if needs else found


def in_stages(known: Known, stages: tuple[Stage, ...], result: Callable[[Known], Column]) -> Column:
    """``result`` of what the stages compute, as one expression that also works inside arrays."""
    if not stages:
        return result(known)
    made = stages[0](known)
    values = F.struct(*[column.alias(name) for name, column in made.items()])
    return bind(values, lambda s: in_stages(known | {n: s[n] for n in made}, stages[1:], result))


def add_stages(rows: DataFrame, known: Known, stages: tuple[Stage, ...], mark: str) -> tuple[DataFrame, Known]:
    """The same as columns, one projection per stage.

    The new columns are called ``mark`` and the name of the value; the caller drops them. Each value
    is a short method of generated code: a stage's first value passes through a lambda, which keeps its projection
    out of whole-stage code. That would be one method of over 8,000 bytes, which HotSpot never compiles.
    """
    for stage in stages:
        made = stage(known)
        first = next(iter(made))
        made[first] = bind(made[first], lambda value: value)
        rows = rows.withColumns({mark + name: column for name, column in made.items()})
        known = known | {name: F.col(mark + name) for name in made}
    return rows, known
