"""Shards: balance, slots, links kept, and hot groups."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from tributary.llm import sharding


def check(rows, texts, shards):
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts)
    held = defaultdict(list)
    for r in rows:
        held[r.shard].append(r.slot)
    sizes = [len(held[i]) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in held.values())
    assert set(held) <= set(range(shards))


@pytest.mark.parametrize("slice_rows", [200_000, 7])
def test_groups_stay_together_if_they_fit(spark, slice_rows):
    texts = [(i, f"text {i}") for i in range(100)]
    texts += [(1000 + i, f"group {i % 12}") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    docs = docs.selectExpr("*", "3 as shard", "1 as _row")
    rows = sharding.assign(docs, 4, rows_per_slice=slice_rows).collect()
    check(rows, texts, 4)
    where = defaultdict(set)
    by_id = dict(texts)
    for r in rows:
        where[by_id[r.doc_id]].add(r.shard)
        assert r.size == len(by_id[r.doc_id]) + 1
        assert r.text_crc32 == zlib.crc32(by_id[r.doc_id].encode())
    assert all(len(s) == 1 for t, s in where.items())


def test_hot_group_spreads_over_few_shards(spark):
    texts = [(i, "same") for i in range(200)] + [(1000 + i, f"{i}") for i in range(400)]
    texts += [(None, None), (None, None), (7, ""), (7, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = sharding.assign(docs, 8).collect()
    check(rows, texts, 8)
    assert len({r.shard for r in rows if r.doc_id is not None and r.doc_id < 200}) <= 4
    assert {(r.size, r.text_crc32, r.linked) for r in rows if r.doc_id is None} == {(1, 0, False)}


def test_empty_table(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_with_several_hubs(spark):
    # two cliques joined by one pair
    links = [(r, "a") for r in range(10)] + [(r, "b") for r in range(10, 20)] + [(0, "c"), (10, "c")]
    frame = spark.createDataFrame(links, "_row long, _hub string")
    state = dict(sharding.propagate(frame, [10, 10]).collect())
    assert sorted(Counter(state.values()).values()) in ([10, 10], [9, 11])
    cut = sum((state[r] == state[0]) != (r < 10) for r in range(20))
    assert cut <= 4


def plain_cut(links, state):
    hubs = defaultdict(list)
    for row, hub in links:
        hubs[hub].append(state[row])
    return sum(a != b for held in hubs.values() for i, a in enumerate(held) for b in held[:i])


def test_cut_against_all_assignments(spark):
    """On a small graph: never worse than the start, and close to the best of all halves."""
    links = [(r, "a") for r in range(4)] + [(r, "b") for r in range(4, 9)] + [(3, "c"), (4, "c"), (9, "d"), (0, "d")]
    frame = spark.createDataFrame(links, "_row long, _hub string")
    state = dict(sharding.propagate(frame, [5, 5]).collect())
    best = min(plain_cut(links, [int(r in half) for r in range(10)]) for half in combinations(range(10), 5))
    found = plain_cut(links, state)
    assert best == 1 and found <= 3
    placed = spark.createDataFrame(list(state.items()), "_row long, _shard int")
    assert sharding.cut(frame, placed, 2) == found


def test_cut_shrinks_and_rounds_end_by_themselves(spark):
    """More rounds than any small limit are taken while they help."""
    some = random.Random(2)
    links = [(r, f"g{r // 5}") for r in range(400)] + [(some.randrange(400), f"x{n % 60}") for n in range(180)]
    frame = spark.createDataFrame(links, "_row long, _hub string")
    start = frame.select("_row").distinct().selectExpr("_row", "cast(pmod(xxhash64(_row), 8) as int) as _shard")
    before = sharding.cut(frame, start, 8)
    state = sharding.propagate(frame, [50] * 8)
    after = sharding.cut(frame, state, 8)
    assert after == plain_cut(links, dict(state.collect()))
    assert after < before / 2


def test_no_links(spark):
    frame = spark.createDataFrame([], "_row long, _hub string")
    assert sharding.propagate(frame, [1, 1]).count() == 0
    assert sharding.cut(frame, spark.createDataFrame([], "_row long, _shard int"), 2) == 0
