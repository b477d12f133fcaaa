"""Integrity check and fixed-size chunking of page arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leafmill.functions.binding import bind

# Pages per chunk.
PAGES_PER_CHUNK = 5


def content_matches(content: Column, checksum: Column) -> Column:
    """True when the SHA-256 of the content is the announced one; never null."""
    return F.coalesce(F.sha2(content, 256) == F.lower(checksum), F.lit(False))


def text_pages(text: Column, separator: str = "\n") -> Column:
    """Pages of a plain-text document, one per line or per form feed."""
    return F.split(text, separator, -1)


def chunk_pages(pages: Column, size: int = PAGES_PER_CHUNK) -> Column:
    """``array<array<page>>`` with ``ceil(n / size)`` parts; the last may be short.

    No pages give no chunks: without the guard ``sequence(0, -1)`` would count down. The pages are bound,
    as an expression over a text would cut all of it anew for every part.
    """

    def parts(p: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / F.lit(size)).cast("int"))
        cut = F.transform(starts, lambda i: F.slice(p, i * size + 1, F.lit(size)))
        return F.when(F.size(p) > 0, cut).otherwise(F.array().cast("array<array<string>>"))

    return bind(pages, parts)
