"""Interactions of filters against one walk through every order."""

from collections import defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from tributary.llm import filter_audit

PLAIN = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, PLAIN, "s"), (2, PLAIN, "s"), (2, PLAIN, "t"), (3, PLAIN + " # x", "s"), (4, None, "s"), (5, "", None),
    (6, "AB cd", "s"), (7, "same " * 80, "t"), (8, "same " * 80, "t"), (None, PLAIN, ""), (None, "new", "t"),
    (9, "A" * 200_000, "s"), (10, " \t\n ", "t"), (11, "é " * 51 + "$", "t"), (12, PLAIN.upper(), "s"), (12, PLAIN.upper(), "s"),
]
LABELS = [(2, 1, 0), (2, 1, 1), (3, None, 1), (7, 0, None), (None, 1, 1), (99, 1, 1), (12, 1, 0)]


def walk(rows, labels):
    """Every order by itself, document by document."""
    least, good, toxic = {}, set(), set()
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    for key, quality, bad in labels:
        good |= {key} if key is not None and quality == 1 else set()
        toxic |= {key} if key is not None and bad == 1 else set()
    failed = defaultdict(list)
    for key, text, part in rows:
        text = text or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        fails = "A" if len(words) < 50 else ""
        fails += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        fails += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else ""
        fails += "D" if set(text) & set("#$%&*|") else ""
        fails += "E" if key is not None and least[text] < key else ""
        failed[part or ""].append((fails, key in good, key in toxic))
    found = {}
    for part, docs in failed.items():
        shares = defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, own in enumerate(order, 1):
                gone = [d for d in left if own in d[0]]
                left = [d for d in left if own not in d[0]]
                shares[own] += len(gone)
                found[part, order, step] = [
                    len(left), len(gone), sum(own in d[0] for d in docs) - len(gone),
                    sum(d[0] == own for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone),
                ]
        for (p, order, step), counts in found.items():
            if p == part:
                counts.append(shares[order[step - 1]])
    return {k: tuple(v) for k, v in found.items()}


def frames(spark, rows=ROWS, labels=LABELS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.select(*(F.lit("x").alias(c) for c in ("_text", "_key", "part", "failed", "quality", "a.b")), "*")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, said.withColumn("source", F.lit("y")).withColumn("_good", F.lit(1))


def result(docs, labels):
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in filter_audit.audit(docs, labels).collect()}


def test_against_every_order(spark):
    found = result(*frames(spark))
    assert found == walk(ROWS, LABELS)
    assert len(found) == 600 * 3


def test_no_labels_and_no_rows(spark):
    assert result(*frames(spark, labels=[])) == walk(ROWS, [])
    assert result(*frames(spark, rows=[])) == {}


def test_shares_add_up(spark):
    """Shapley values of a part sum to what all filters remove, in each of the 120 orders."""
    docs, labels = frames(spark)
    rows = filter_audit.audit(docs, labels)
    sums = rows.groupBy("part", "filter_order").agg(F.sum("shapley").alias("s"), F.sum("removed").alias("r"))
    assert sums.filter("s <> 120 * r").count() == 0 and sums.count() == 360


def test_other_filters(spark):
    docs, labels = frames(spark)
    own = {"L": lambda text, words: F.length(text) > 100, "M": lambda text, words: F.size(words) == 0}
    rows = filter_audit.audit(docs, labels, own)
    assert {r.filter_order for r in rows.select("filter_order").distinct().collect()} == {
        "".join(p) for p in permutations("LME")
    }
    first = rows.filter("part = 's' and filter_order = 'MLE' and step = 1").first()
    assert first.removed == 1 and first.kept == 7
