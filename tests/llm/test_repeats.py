"""Repeated passages against a plain search, hot triggers and odd rows."""

import hashlib
import random

import pytest

from tributary.llm import repeats


def plain(texts, length):
    seen, out = set(), {}
    for key, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            string = raw[i : i + length]
            if string in seen:
                gone[i : i + length] = [True] * length
            seen.add(string)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("ab\u00e9 ") for _ in range(rng.randrange(1, 9)))
    bases = ["".join(word() for _ in range(rng.randrange(5, 90))) for _ in range(12)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            base = rng.choice(bases)
            low = rng.randrange(len(base))
            parts.append(rng.choice([base, base[low:], base[:low], word(), base + base]))
        texts.append("".join(parts))
    return texts + ["x" * 150, "y" + "x" * 300, "ab" * 90, "", None, "short", "aba" * 70, "x" * 30]


@pytest.mark.parametrize("seed, length, width, hot", [(1, 100, 32, 20_000), (2, 30, 8, 20_000), (3, 40, 16, 2)])
def test_remove(spark, seed, length, width, hot):
    texts = list(enumerate(corpus(seed), 5)) + [(None, corpus(seed)[0])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    docs = docs.selectExpr("*", "1 as n_bytes", "'x' as _key")
    rows = repeats.remove(docs, length=length, width=width, hot=hot).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in rows}
    assert len(rows) == len(texts) and found == plain(texts, length)


def test_small_buckets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", 3)
    test_remove(spark, 4, 30, 8, 20_000)


def test_repeated_keys(spark):
    rng = random.Random(9)
    one, two = ("".join(rng.choice("abcdef") for _ in range(300)) for _ in range(2))
    texts = [(1, one), (1, one), (1, two), (2, one + "!"), (None, None), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = repeats.remove(docs).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in rows) == [
        (0, 0, 0), (0, 0, 0), (1, 300, 0), (1, 300, 0), (1, 300, 0), (2, 301, 300)
    ]


def test_texts_of_a_repeated_key_whose_short_hashes_collide(spark):
    digest = lambda i, j: hashlib.sha256(f"{i}-{j}".encode()).hexdigest()
    one, two = ("".join(digest(i, j) for j in range(3)) for i in (28533, 106133))
    for key in (7, None):
        texts = [(key, one), (key, two), (key, two), (8, two + "!"), (9, "?" + one)]
        docs = spark.createDataFrame(texts, "doc_id long, text string")
        short = docs.filter("doc_id is null or doc_id = 7").selectExpr("shiftrightunsigned(xxhash64(text), 33) as h")
        assert short.distinct().count() == 1
        rows = repeats.remove(docs).collect()
        assert sorted((r.doc_id or 0, r.n_removed, r.n_spans, bytes(r.kept).decode()) for r in rows) == sorted(
            [(key or 0, 0, 0, t) for t in (one, two, two)] + [(8, 192, 1, "!"), (9, 192, 1, "?")]
        )


def test_empty_table(spark):
    assert repeats.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0
