"""Token counts: texts are encoded in batches inside Arrow functions and only lengths come back.

The work of a task is cut into batches of equal bytes, and texts into pieces at safe
boundaries, so neither a long text nor a run of long texts makes a large batch. Equal pieces of
a batch are encoded once, and lengths of recent pieces are remembered.
"""

from __future__ import annotations

import copy
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.common import MEMORY_BYTES, by_bytes, kept_in_worker, release, texts_of

BATCH_BYTES = 1 << 20
# Of a piece and its count in a dictionary, about.
ENTRY = 150

# Safe boundaries of byte-level pre-tokenisation: it starts a new word there whatever stands around, so
# the counts of the pieces add up. One is before a single space between two characters that are no white
# space, another between a letter and what follows the letters, if that is no white space.
SINGLE_SPACE = re.compile(r"(?<=\S)(?= \S)")
WORD_AND_MARKS = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")


class Lengths:
    """Token counts by one byte-level tokenizer file, as its library gives them without special tokens added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.forget()

    def forget(self) -> None:
        # Counts of whole texts, and of pieces that follow a single space, kept without it.
        self.known: dict[str, int] = {"": 0}
        self.spaced: dict[str, int] = {}
        self.held = 0

    def for_task(self) -> Lengths:
        """The same tokenizer with a memory of its own."""
        own = copy.copy(self)
        own.forget()
        return own

    def __call__(self, texts: list[bytes]) -> list[int]:
        out: list[int] = []
        for start, stop in by_bytes(texts, BATCH_BYTES):
            batch = [t.decode("utf-8", "replace") for t in texts[start:stop]]
            cut = [text.split(" ") for text in batch]
            # What one batch adds is bounded by its bytes, and must stay until its texts are summed up.
            if self.held > 2 * MEMORY_BYTES:
                self.forget()
            self._learn_spaced(set(chain.from_iterable(cut)) - self.spaced.keys())
            self._learn([pieces[0] for pieces in cut])
            out += [self._sum(text, pieces) for text, pieces in zip(batch, cut, strict=True)]
        return out

    def _sum(self, text: str, pieces: list[str]) -> int:
        rest = iter(pieces)
        try:
            return self.known[next(rest)] + sum(map(self.spaced.__getitem__, rest))
        except KeyError:  # white space beside a space
            careful = SINGLE_SPACE.split(text)
            self._learn(careful)
            return sum(map(self.known.__getitem__, careful))

    def _learn_spaced(self, new: set[str]) -> None:
        """Pieces after a single space; one with white space at an edge has no safe boundary there and is left out.

        A word with marks behind it is cut once more, so that the word is encoded once whatever
        marks follow; not where the marks could begin a special string.
        """
        plain = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        cut = {p: m.groups() for p in plain if (m := WORD_AND_MARKS.fullmatch(p))}
        cut = {p: parts for p, parts in cut.items() if not set(parts[1]) & set(self.special)}
        words = [p for p in plain if p not in cut]
        words += {word for word, _ in cut.values()} - self.spaced.keys() - set(words)
        for start, stop in by_bytes(words, BATCH_BYTES):
            self.spaced.update(zip(words[start:stop], self._encode([" " + p for p in words[start:stop]]), strict=True))
            self._hold(words[start:stop])
        self._learn(list({marks for _, marks in cut.values()}))
        self.spaced.update({p: self.spaced[word] + self.known[marks] for p, (word, marks) in cut.items()})
        self._hold(cut)

    def _learn(self, pieces: list[str]) -> None:
        new = list(set(pieces) - self.known.keys())
        for start, stop in by_bytes(new, BATCH_BYTES):
            self.known.update(zip(new[start:stop], self._encode(new[start:stop]), strict=True))
            self._hold(new[start:stop])

    def _hold(self, pieces: Iterable[str]) -> None:
        self.held += sum(len(p) + ENTRY for p in pieces)

    def _encode(self, pieces: list[str]) -> list[int]:
        return list(map(len, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)))


def count_tokens(
    documents: DataFrame, tokenizer: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, whole texts.

    ``tokenizer`` is the path of a tokenizers JSON file that every executor has. Special strings
    inside texts are handled as the library does by default; a null text counts as empty. Repeated
    rows are counted each; an empty table gives no rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = kept_in_worker(("lengths", tokenizer), lambda: Lengths(tokenizer)).for_task()
        for batch in batches:
            texts = texts_of(batch.column(1))
            n_tokens = lengths(texts)
            columns = [
                batch.column(0),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(n_tokens, pa.int64()),
                pa.array([n > limit for n in n_tokens], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
        release()

    asked = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return asked.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
