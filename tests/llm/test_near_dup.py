"""Near-duplicate components against all pairs."""

import random
import re
from collections import defaultdict

import pytest

from tributary.llm import near_dup


def plain(texts, words, percent=80):
    sets = []
    for _, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
        sets.append(grams or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if a and 100 * inter >= percent * (len(a) + len(sets[j]) - inter) and sets[j]:
                root[find(i)] = find(j)
    keys = defaultdict(list)
    for i, (key, _) in enumerate(texts):
        keys[find(i)].append(key)
    least = {r: min((k for k in v if k is not None), default=None) for r, v in keys.items()}
    return sorted(
        ((k, len(s), least[find(i)], k == least[find(i)]) for i, ((k, _), s) in enumerate(zip(texts, sets))),
        key=str,
    )


def corpus(seed, size, vocabulary=400):
    rng = random.Random(seed)
    texts = []
    for _ in range(size):
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([1, 2, 4, 12, 40, 90]))]
        for _ in range(rng.choice([1, 1, 2, 8, 30])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 8)):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], ["new%d" % rng.randrange(999)], [copy[at], "x"]])
            texts.append((rng.randrange(10**6), " ".join(copy)))
    return texts


@pytest.mark.parametrize("words, block", [(2, 500_000), (5, 300)])
def test_components(spark, words, block):
    texts = corpus(words, 60)
    texts += [(None, "only null key"), (None, "Only NULL key"), (5, None), (6, ""), (7, " \n "), (8, None)]
    texts += [(9, "same row here"), (9, "same row here"), (1, "ONE"), (2, "one")]
    texts += [(10**6 + i, "hot " * 3 + "group of very many copies") for i in range(150)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    docs = docs.selectExpr("*", "'x' as n_shingles", "1 as component_id")
    found = near_dup.link(docs, words, block_shingles=block)
    rows = sorted(
        ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=str
    )
    assert rows == plain(texts, words)


def test_long_lists_in_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "LIST", 3)
    monkeypatch.setattr(near_dup, "BLOCK_CLASSES", 5)
    test_components(spark, 2, 500_000)


def test_a_shared_passage_is_not_expanded_into_all_pairs(spark, monkeypatch):
    rng, n = random.Random(3), 400
    passage = " ".join(f"p{i}" for i in range(75))
    own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(45)) for _ in range(n)]
    texts = [(i, f"{passage} {o}") for i, o in enumerate(own)] + [(n, f"{passage} {own[7]} again")]
    pairs = []

    def meeting(found, classes, matches, plain=near_dup._meeting):
        pairs.append(found.count())
        return plain(found, classes, matches)

    monkeypatch.setattr(near_dup, "_meeting", meeting)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    linked = near_dup.link(docs, 2)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in linked.collect()), key=str) == plain(texts, 2)
    assert pairs[1] < 64 * n / 2, pairs


def test_matches_follow_from_the_threshold(spark):
    assert [near_dup.enough_matches(p) for p in (100, 80, 60)] == [48, 14, 3]
    rng, texts = random.Random(4), []
    for i in range(40):  # pairs of sets that share 60 of 100 shingles
        both, one, two = ([f"{s}{i}x{rng.randrange(10**6)}" for _ in range(n)] for s, n in (("b", 60), ("l", 20), ("r", 20)))
        texts += [(2 * i, " ".join(both + one)), (2 * i + 1, " ".join(both + two))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = near_dup.link(docs, 1, 60).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    assert found == plain(texts, 1, 60)
    assert near_dup.dedup(docs, 1, 60).count() == 40
    assert near_dup.dedup(docs, 1, 60, matches=48).count() == 80
    for call in (near_dup.link, near_dup.dedup):
        with pytest.raises(ValueError, match="50 percent"):
            call(docs, percent=50)


def test_dedup_keeps_one_of_each(spark):
    texts = [(i, f"a b c d e f g h i j k l m n o p q r s t u {i // 4}") for i in range(12)]
    texts += [(50, "some other text here"), (50, "some other text here"), (60, None), (61, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "7 as _row", "8 as _key")
    kept = near_dup.dedup(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == [0, 50, 60, 61]
    assert {(r["_row"], r["_key"]) for r in rows} == {(7, 8)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.link(docs).count() == 0 and near_dup.dedup(docs).count() == 0


def test_chosen_collisions(spark):
    """Words after the Thue-Morse sequence collide in polynomials modulo a power of two."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    rows = [(12, f"{one} x"), (13, f"{two} x"), (14, f"{one} x {two} x"), (15, f"{two} x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.link(docs, words=2).collect()}
    assert found == {12: (1, 12), 13: (1, 13), 14: (3, 14), 15: (1, 13)}
    assert sorted(r.doc_id for r in near_dup.dedup(docs, words=2).collect()) == [12, 13, 14]
