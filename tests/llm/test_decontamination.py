"""Benchmark windows against a plain search, in one block and in many."""

import random
import re

import pytest
from pyspark import Broadcast

from tributary.llm import decontamination

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [(m[0], m.start(), m.end()) for m in re.finditer(PATTERN, lower)]


def plain(text, items, size):
    own = words(text)
    hit, found = set(), set()
    for item, body in items:
        w = [x for x, *_ in words(body)]
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            gram = w[i : i + size]
            for j in range(len(own) - len(gram) + 1):
                if [x for x, *_ in own[j : j + len(gram)]] == gram:
                    hit.update(range(j, j + len(gram)))
                    found.add("" if item is None else str(item))
    return own, hit, sorted(found)


def cut(text, own, hit):
    keep, last, i = [], 0, 0
    while i < len(own):
        if i in hit:
            j = i
            while j + 1 in hit:
                j += 1
            keep.append(text[last : own[i][1]])
            last, i = own[j][2], j
        i += 1
    return "".join(keep) + text[last:] if text is not None else None


@pytest.mark.parametrize("block", [500_000, 7])
def test_find_and_clean(spark, block):
    rng = random.Random(5)
    some = lambda n: " ".join(rng.choice(["a", "B", "c\u00e9", "d", "9"]) for _ in range(n))
    items = [(i, some(rng.choice([1, 2, 5, 8, 12]))) for i in range(3, 9)] + [(1, None), (2, "..!"), (None, some(6))]
    texts = [(i, rng.choice([", ", "\n", " "]).join([some(rng.randrange(0, 9)), some(9), "Z y x"])) for i in range(40)]
    texts += [(None, items[0][1]), (50, None), (51, ""), (52, "none"), (52, "none")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as _digest", "2 as spans")
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    found = decontamination.find(docs, bench, window=5, block=block)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in found.collect()), key=str)
    want, left, clean = [], [], []
    for key, text in texts:
        own, hit, ids = plain(text, items, 5)
        spans = []
        for i in sorted(hit):
            if i - 1 in hit:
                spans[-1] = (spans[-1][0], own[i][2])
            else:
                spans.append((own[i][1], own[i][2]))
        want.append((key, len(own), len(hit), ids, spans))
        left.append((key, cut(text, own, hit)))
        if not hit:
            clean.append((key, text))
    assert [g[:4] for g in got] == [w[:4] for w in sorted(want, key=str)]
    assert got == sorted(want, key=str)
    by_spans = decontamination.clean(docs, bench, "spans", window=5, block=block)
    assert by_spans.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in by_spans.collect()), key=str) == sorted(left, key=str)
    by_docs = decontamination.clean(docs, bench, window=5, block=block).collect()
    assert sorted(((r.doc_id, r.text) for r in by_docs), key=str) == sorted(clean, key=str)


def test_one_block_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"x a{i} b c{i}") for i in range(6)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, f"a{i} b") for i in range(0, 60, 2)], "item_id long, text string")
    alive, most = set(), []
    context, kind = type(spark.sparkContext), Broadcast

    def broadcast(self, value, plain=context.broadcast):
        made = plain(self, value)
        alive.add(id(made))
        most.append(len(alive))
        return made

    def destroy(self, blocking=False, plain=kind.destroy):
        alive.discard(id(self))
        plain(self, blocking)

    monkeypatch.setattr(context, "broadcast", broadcast)
    monkeypatch.setattr(kind, "destroy", destroy)
    found = decontamination.find(docs, bench, window=2, block=8).filter("n_hit > 0").collect()
    assert sorted(r.doc_id for r in found) == [0, 2, 4]
    left = decontamination.clean(docs, bench, window=2, block=8).collect()
    assert sorted(r.doc_id for r in left) == [1, 3, 5]
    assert len(most) == 8 and max(most) == 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontamination.find(docs.limit(0), items).count() == 0
    (row,) = decontamination.find(docs, items.limit(0)).collect()
    assert (row.n_words, row.n_hit) == (2, 0)
    assert decontamination.clean(docs, items.limit(0)).count() == 1
