"""Token counts and BPE against the tokenizers library itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leafmill.llm import bpe, token_counts

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
PIECES = [
    "<|endoftext|>", "<|startoftext|>", " <|", "|> ", "it's", "I'LL", " ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "\xa0", "é", "é",
    "Σ", "ΑΣ ", "İ", "ß", "１", "٣", "12", "!!", "...", "$$$", "###", "日本", "한글", "🎉", "‍", "word", "Word,", " the", "x" * 400,
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return ["", " ", "a"] + ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 30))) for _ in range(3000)]


def test_counts_equal_the_library(texts):
    library = Tokenizer.from_file(BYTES)
    want = [len(library.encode(t, add_special_tokens=False)) for t in texts]
    assert token_counts.Lengths(BYTES)([t.encode() for t in texts]) == want


def test_counts_do_not_depend_on_batches_or_memory(texts, monkeypatch):
    once = token_counts.Lengths(BYTES)([t.encode() for t in texts])
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 200)
    monkeypatch.setattr(token_counts, "MEMORY_BYTES", 5_000)
    assert token_counts.Lengths(BYTES)([t.encode() for t in texts]) == once


def test_ids_and_decoded_text_equal_the_library(texts):
    library, own = Tokenizer.from_file(WORDS), bpe.WordBpe(WORDS)
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        ids, decoded = own.encode_decode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
        assert decoded == library.decode(want, skip_special_tokens=False), repr(text)


def test_every_code_point_equals_the_library():
    library, own = Tokenizer.from_file(WORDS), bpe.WordBpe(WORDS)
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 8):
        text = "".join(f"a{c}B {c}" for c in points[start : start + 8])
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode_decode(text)[0], "<u4").tolist() == want, repr(text)


def test_memory_is_bounded_in_bytes(texts, monkeypatch):
    own = bpe.WordBpe(WORDS)
    once = [own.encode_decode(t) for t in texts]
    task = own.for_task()
    assert not task.known.young and task.vocab is own.vocab
    task.known.limit = 3_000
    assert [task.encode_decode(t) for t in texts] == once
    for memory in (task.known.young, task.known.old):
        assert len(memory) * task.known.ENTRY <= 3_000
    monkeypatch.setattr(bpe, "PIECE_CHARS", 7)
    assert [own.encode_decode(t) for t in texts] == once


def test_long_words_merge_in_the_same_order():
    own = bpe.WordBpe(WORDS)
    rng = random.Random(1)
    for size in (1, 2, 300, 2000):
        word = "".join(rng.choice("theandion") for _ in range(size))
        starts = [own.inner_ids[b] for b in word.encode()]
        assert own._scan(list(starts)) == own._heap(list(starts))
    assert own.encode("theand" * 200) == Tokenizer.from_file(WORDS).encode("theand" * 200, add_special_tokens=False).ids


def test_tables_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b", 5, "x"), (1, "a b", 5, "x"), (None, None, 5, "x"), (2, "", 5, "x"), (3, "word " * 200_000, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, decoded string").repartition(3)
    counts = {r["doc_id"]: r for r in token_counts.count_tokens(docs, BYTES).collect()}
    assert (counts[1]["n_tokens"], counts[None]["n_tokens"], counts[2]["n_bytes"]) == (2, 0, 0)
    assert counts[3]["over_limit"] and counts[3]["n_tokens"] == len(Tokenizer.from_file(BYTES).encode("word " * 200_000).ids)
    coded = {r["doc_id"]: r for r in bpe.bpe_round_trip(docs, WORDS, payload=True).collect()}
    assert coded[3]["n_tokens"] == 200_000 == len(coded[3]["ids"])
    assert coded[None]["ids_sha256"] == coded[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert coded[1]["decoded"] == "a</w> b</w>"
    assert token_counts.count_tokens(docs, BYTES).count() == bpe.bpe_round_trip(docs, WORDS).count() == 5
    assert token_counts.count_tokens(docs.limit(0), BYTES).count() == bpe.bpe_round_trip(docs.limit(0), WORDS).count() == 0
