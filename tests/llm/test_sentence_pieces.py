"""Ids and texts against the library itself."""

import random

import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tributary.llm import sentence_pieces

ODD = [
    "", " ", "  ", "   a", *(" " * n for n in range(1, 40)), " " * 27 + "x", "▁▁ ▁a", "a▁b", "<s></s><unk><0x41>",
    "\x00a\x00", "é€\U0001f600 漢字", "a" * 400, "\t\n\r x", "�", "ＡＢ ﬁ", "12.34567 89", "https://x.y/z?q=1&b=2",
    "़्क्ष", "‍﻿", "word\nword\n\nword", "()[]{}// ///",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=sentence_pieces.model())


@pytest.fixture(scope="module")
def own():
    return sentence_pieces.vocabulary(sentence_pieces.model())


def ids_of(own, text):
    return memoryview(own.encode(text)).cast("i").tolist()


def test_odd_and_random_texts(own, library):
    some = random.Random(5)
    letters = " ▁ab1é漢\n\U0001f600\x00thern"
    texts = ODD + ["".join(some.choice(letters) for _ in range(some.randint(1, 40))) for _ in range(4000)]
    for text in texts:
        ids = library.encode(text)
        assert ids_of(own, text) == ids, repr(text)
        assert own.decode(ids) == library.decode(ids), repr(text)


def test_any_ids(own, library):
    some = random.Random(6)
    for _ in range(3000):  # bytes, controls and pieces that no text gives
        ids = [some.choice([some.randrange(32000), some.randrange(262), 259]) for _ in range(some.randint(1, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_last_piece_of_each_prefix(own, library):
    word = "internationalisation"
    last = own.prefixes(word)
    for end in range(len(word)):
        # the library puts a blank in front, so the word stands behind a character outside the vocabulary
        assert last[end] == library.encode("\x01" + word[: end + 1])[-1]


def test_long_text(own, library):
    some = random.Random(7)
    text = "".join(some.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(200_000)) + " " * 5000
    assert ids_of(own, text) == library.encode(text)


def test_memory_starts_anew(own, library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "KNOWN_WORDS", 3)
    monkeypatch.setattr(sentence_pieces, "KNOWN_PAIRS", 5)
    fresh = sentence_pieces.Vocabulary(sentence_pieces.model())
    text = "one two three four five six one two three seven"
    assert ids_of(fresh, text) == library.encode(text) == ids_of(fresh, text)
    assert len(fresh.known) <= 3 and sum(map(len, fresh.apart)) <= 5


def test_whole_table(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = sentence_pieces.decode(sentence_pieces.encode(docs)).collect()
    texts = dict(zip(*pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))
    assert len(found) == len(texts)
    for r in found:
        assert r.ids == library.encode(texts[r.doc_id] or "")
        assert r.text == library.decode(r.ids)


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "x" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        F.lit(1).alias("ids"), F.lit("x").alias("_key"), F.lit(2).alias("a.b"), "doc_id", "text"
    )
    encoded = sentence_pieces.encode(docs)
    found = sentence_pieces.digest(sentence_pieces.decode(encoded)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == sorted(
        (key or 0, len(library.encode(text or ""))) for key, text in rows
    )
    by_key = {r.doc_id: r for r in found}
    assert by_key[1].ids_sha256 == by_key[2].decoded_sha256  # both of the empty string
    assert by_key[None][1:] == by_key[3][1:]
    assert sentence_pieces.digest(sentence_pieces.decode(sentence_pieces.encode(docs.limit(0)))).count() == 0
    dotted = docs.select(F.col("doc_id").alias("my.key"), F.col("text").alias("my.text"))
    assert sentence_pieces.encode(dotted, text="my.text", key="my.key").count() == len(rows)
