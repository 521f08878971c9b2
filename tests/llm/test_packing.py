"""Length buckets and batches against plain Python."""

from collections import Counter, defaultdict
from itertools import combinations

from tributary.llm import packing


def cost(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_are_the_best_of_all():
    lengths, counts = [0, 1, 4, 5, 9, 11, 12, 30], [5, 1, 7, 2, 9, 4, 1, 3]
    for k in range(1, 9):
        found = packing.boundaries(lengths, counts, k)
        best = min(cost(lengths, counts, (*c, 30)) for c in combinations(lengths[:-1], k - 1))
        assert cost(lengths, counts, found) == best and len(found) <= k


TEXTS = [(1, "a b\u00e9  c\td"), (2, None), (2, ""), (3, " \n "), (4, "x " * 95), (5, "\u00f1 " * 23),
         (None, "w"), (6, "one two"), (6, "one two")]


def test_pack(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as piece", "'x' as bucket", "2 as _row")
    rows = packing.pack(docs, 3, 40, 10, with_text=True, rows_per_slice=4).collect()
    texts = Counter()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        assert r.n_tokens == len(r.piece_text.split()) <= min(10, r.bucket_tokens)
        assert r.padding == r.bucket_tokens - r.n_tokens
    for key in (1, 4, 5, None):
        parts = sorted(by_doc[key], key=lambda r: r.piece)
        text = "".join(p.piece_text for p in parts)
        texts[key] = text
        assert text == dict(TEXTS)[key]
        assert [p.start for p in parts] == [len(text[: p.start]) for p in parts]
        assert [text[p.start : p.start + p.n_chars] for p in parts] == [p.piece_text for p in parts]
    assert len(by_doc[2]) == 2 and len(by_doc[6]) == 2
    batches = defaultdict(list)
    for r in rows:
        batches[r.bucket, r.batch].append(r)
    last = {b: max(n for x, n in batches if x == b) for b, _ in batches}
    for (bucket, number), members in batches.items():
        most = max(1, 40 // max(1, members[0].bucket_tokens))
        assert sorted(m.slot for m in members) == list(range(len(members)))
        assert len(members) == most or (number == last[bucket] and len(members) < most)
    used = sorted({(r.bucket, r.bucket_tokens) for r in rows})
    histogram = sorted(Counter(r.n_tokens for r in rows).items())
    assert [e for _, e in used] == packing.boundaries(*zip(*histogram), 3)


def plain_tokens(text):
    """Where tokens begin, character by character."""
    starts, length = [], 0
    for i, c in enumerate(text):
        if c in " \t\n\r\v\f":
            length = 0
        elif any(low <= ord(c) <= high for low, high in packing.ALONE):
            starts.append(i)
            length = 0
        else:
            if length % packing.WORD_CHARS == 0:
                starts.append(i)
            length += 1
    return starts


def test_texts_without_blanks(spark):
    """Scripts without blanks, and endless words, are cut by the budget as well."""
    texts = ["漢字" * 9000, "ab漢cd 字e ไทย 😀x", "q" * 5000, "é" * 100 + " " + "w" * 24 + " " + "w" * 25, "", " ", "字"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(docs, 4, 4096, 512, with_text=True).collect()
    for key, text in enumerate(texts):
        parts = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.piece)
        starts = plain_tokens(text)
        assert "".join(p.piece_text for p in parts) == text
        assert [p.n_tokens for p in parts] == [len(starts[i : i + 512]) for i in range(0, max(1, len(starts)), 512)]
        assert [p.start for p in parts[1:]] == starts[512::512]
    assert max(r.n_tokens for r in rows) == 512


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs).count() == 0
