"""Vectors for offer texts: a plugged-in embedder behind an Arrow batch function."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.functions.text import all_present, embeddable_text
from leafmill.operators.extraction import EMBEDDER_RETRY, Retry, call_with_retry

Embedder = Callable[[list[str]], "list[list[float]] | np.ndarray"]

_WORD = re.compile(r"[^\W_]+")


class HashingEmbedder:
    """Feature hashing of lower-case words, L2-normalised: same text, same vector, anywhere."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def slot(self, word: str) -> int:
        return int(hashlib.sha256(word.encode()).hexdigest()[:6], 16) % self.dims

    def __call__(self, texts: list[str]) -> np.ndarray:
        words = [_WORD.findall(text.lower()) for text in texts]
        slots = {word: self.slot(word) for word in {w for ws in words for w in ws}}
        out = np.zeros((len(texts), self.dims), dtype=np.float64)
        for row, ws in zip(out, words):
            for word in ws:
                row[slots[word]] += 1.0
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norms == 0.0, 1.0, norms)).astype(np.float32)


def embed_lists(texts: Column, embedder: Embedder, retry: Retry = EMBEDDER_RETRY) -> Column:
    """``array<string>`` to ``array<array<float>>``: one embedder call per row of texts.

    A call that fails to the end gives null for the row, so its offers stay, vectorless.
    """

    @F.pandas_udf("array<array<float>>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for items in batch:
                done = None
                if items is not None and len(items):
                    done, _, _ = call_with_retry(lambda: embedder(list(items)), retry)
                out.append(None if done is None else [np.asarray(v, dtype=np.float32) for v in done])
            yield pd.Series(out, dtype=object)

    return vectors(texts)


def embed_texts(text: Column, embedder: Embedder, retry: Retry = EMBEDDER_RETRY) -> Column:
    """``string`` to ``array<float>``: one embedder call per Arrow batch; blank gives null."""

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            given = batch[[isinstance(t, str) and bool(t.strip()) for t in batch]]
            if len(given):
                done, _, _ = call_with_retry(lambda: embedder(given.tolist()), retry)
                if done is not None:
                    out.loc[given.index] = pd.Series(
                        [np.asarray(v, dtype=np.float32) for v in done], index=given.index, dtype=object
                    )
            yield out

    return vectors(text)


def attach_vectors(offers: Column, vectors: Column) -> Column:
    """The i-th vector to the i-th offer; offers beyond the last vector keep none."""
    n = F.size(offers)
    padded = F.slice(F.coalesce(vectors, F.array().cast("array<array<float>>")), F.lit(1), n)
    return F.zip_with(offers, padded, lambda offer, vector: offer.withField("embeddings", vector))


def embed_offers(results: DataFrame, embedder: Embedder, retry: Retry = EMBEDDER_RETRY) -> DataFrame:
    """Chunk results with a vector in every offer; none in a chunk with a blank text."""
    texts = F.transform("offers_data", lambda o: embeddable_text(o["name"], o["type"]))
    usable = F.when(all_present(texts), texts)
    with_vectors = results.withColumn("_vectors", embed_lists(usable, embedder, retry))
    return with_vectors.withColumn(
        "offers_data", attach_vectors(F.col("offers_data"), F.col("_vectors"))
    ).drop("_vectors")
