"""Byte-pair encoding and decoding of lower-case word vocabularies.

A word is held as a short contiguous array of parts with the rank of each adjacent pair. The
array is scanned for the least rank, that boundary is deleted and the two neighbouring ranks are
looked up again, until no pair has a rank. Words too long for repeated scans take the same merges
in the same order from a heap.
"""

from __future__ import annotations

import copy
import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tokenizers import Regex, normalizers
from tokenizers.pre_tokenizers import Split

from leafmill.llm.common import GROUP_BYTES, Memory, by_bytes, kept_in_worker, release, texts_of

SHORT_WORD = 256
NO_RANK = 1 << 60

# Texts are worked on in pieces of so many characters, which end at white space.
PIECE_CHARS = 1 << 18

# Unicode white space; the four separators \x1c to \x1f are none.
WHITE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
BEYOND_LATIN = regex.compile(r"[^\x00-\u024f]")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if it is printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def pair_key(left: int, right: int) -> int:
    return left << 32 | right


def pieces_of(text: str) -> Iterator[str]:
    """A text cut at white space into pieces of bounded size; a longer word is a piece of its own."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        end = next((i for i in range(start + PIECE_CHARS, start, -1) if WHITE.match(text[i])), None)
        if end is None:
            gap = WHITE.search(text, start + PIECE_CHARS)
            end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end
    yield text[start:]


class WordBpe:
    """Encoder and decoder of a tokenizers JSON file: NFC, lower case, white space dropped, word ends marked."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        pairs = [(self.vocab[left], self.vocab[right]) for left, right in model["merges"]]
        self.ranks = {pair_key(*pair): rank for rank, pair in enumerate(pairs)}
        self.merged = [self.vocab[left + right] for left, right in model["merges"]]
        splitter = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(splitter["pattern"]["Regex"])
        # Beyond the first Latin blocks, letters and their lower case are a matter of the library's Unicode tables.
        self.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.splitter = Split(Regex(splitter["pattern"]["Regex"]), "removed", invert=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        alphabet = byte_alphabet()
        self.inner_ids = [self.vocab.get(c) for c in alphabet]
        self.last_ids = [self.vocab.get(c + self.end) for c in alphabet]
        self.forget()

    def forget(self) -> None:
        self.known = Memory()

    def for_task(self) -> WordBpe:
        """The same vocabulary with a memory of its own."""
        own = copy.copy(self)
        own.forget()
        return own

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        *inner, last = word.encode("utf-8")
        ids = [self.inner_ids[b] for b in inner] + [self.last_ids[last]]
        if None in ids:
            ids = [i for i in ids if i is not None]
        return self._scan(ids) if len(ids) <= SHORT_WORD else self._heap(ids)

    def _rank(self, left: int, right: int) -> int:
        return self.ranks.get(pair_key(left, right), NO_RANK)

    def _scan(self, ids: list[int]) -> list[int]:
        rank_of = self.ranks.get
        ranks = [rank_of(left << 32 | right, NO_RANK) for left, right in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) != NO_RANK:
            i = ranks.index(least)
            ids[i] = self.merged[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] << 32 | ids[i], NO_RANK)
            if i < len(ranks):
                ranks[i] = rank_of(ids[i] << 32 | ids[i + 1], NO_RANK)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        queue = [(self._rank(a, b), i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
        queue = [x for x in queue if x[0] < NO_RANK]
        heapq.heapify(queue)
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (rank := self._rank(ids[k], ids[after[k]])) < NO_RANK:
                    heapq.heappush(queue, (rank, k, ids[k], ids[after[k]]))
        return [i for i in ids if i >= 0]

    def _words(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if BEYOND_LATIN.search(text):
            return [word for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]
        return self.words.findall(text.lower())

    def _coded(self, words: list[str]) -> list[tuple[bytes, str]]:
        """Per pre-token its ids and its decoded text; what is remembered is not encoded again."""
        found = list(map(self.known.young.get, words))
        for i, pair in enumerate(found):
            if pair is None:
                word = words[i]
                if (pair := self.known.young.get(word)) is None:
                    if (pair := self.known.old.get(word)) is None:
                        ids = self.encode_word(word)
                        pair = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
                    self.known.keep(word, pair, len(word) + len(pair[0]) + len(pair[1]))
                found[i] = pair
        return found

    def decode(self, ids: list[int]) -> str:
        """Tokens with a space between them, as the library does for a file without decoder."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the decoded text; the file's special strings are tokens of their own."""
        parts = self.specials.split(text) if self.specials is not None and self.specials.search(text) else [text]
        found = []
        for part in parts:
            if part in self.special:
                found.append((struct.pack("<I", self.special[part]), self.decode([self.special[part]])))
            else:
                for piece in pieces_of(part):
                    found += self._coded(self._words(piece))
        return b"".join([p[0] for p in found]), " ".join([p[1] for p in found if p[0]])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_decode(text)[0], dtype="<u4").tolist()


def bpe_round_trip(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", payload: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row, whole texts.

    With ``payload`` the ids (``array<int>``) and the decoded text come too. ``tokenizer`` is the
    path of a tokenizers JSON file that every executor has. A null text counts as empty, and an
    empty one has no tokens. Repeated rows are encoded each; an empty table gives no rows.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if payload else ""
    names = [part.split()[0] for part in schema.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept_in_worker(("bpe", tokenizer), lambda: WordBpe(tokenizer)).for_task()
        kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
        for batch in batches:
            texts = texts_of(batch.column(1))
            for start, stop in by_bytes(texts, GROUP_BYTES):
                columns: list[list] = [[] for _ in names[1:]]
                for raw in texts[start:stop]:
                    ids, decoded = model.encode_decode(raw.decode("utf-8", "replace"))
                    row = [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                    row += [np.frombuffer(ids, dtype="<u4").astype(np.int32), decoded] if payload else []
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *arrays], names=names)
        release()

    asked = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return asked.mapInArrow(encode, schema)
