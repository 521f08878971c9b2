"""Extra columns with names that the operators use themselves, or with dots, change nothing."""

import pytest
from pyspark.sql import functions as F

from tributary.llm import decontamination, near_dup, quality, secrets

CLASHING = [
    "_row", "_text", "_doc", "_id", "_body", "_key", "_one", "_two", "_tokens", "_root", "_digest", "_spans",
    "_items", "_runs", "start", "end", "verdict", "kind", "value", "count", "token", "c0", "c1", "a.b", "_doc.text",
]
WORDS = " ".join(f"word{i}" for i in range(80))
TEXTS = [
    (1, WORDS), (2, WORDS + " more"), (3, None), (4, ""), (5, WORDS), (None, "alone"), (7, "password = abcdefgh12345678"),
    (8, "x one two three four five six seven eight nine ten y"), (9, "a b c d e f g h i j"), (None, None),
]


def documents(spark, extra):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    own = ["doc_id", "text", F.lit("s").alias("source"), F.lit("en").alias("lang")]
    return docs.select(*(F.lit("x").alias(c) for c in extra), *own, F.lit(None).alias("none"))


def items(spark):
    texts = [(1, "one two three four five six seven eight nine ten"), (2, "a b c d e f g h i j")]
    return spark.createDataFrame(texts, "item_id long, text string")


STAGES = {
    "quality": lambda docs, items: quality.keep(docs),
    "near_dup": lambda docs, items: near_dup.dedup(docs),
    "benchmark": lambda docs, items: decontamination.clean(docs, items),
    "spans": lambda docs, items: decontamination.clean(docs, items, "spans"),
    "span_blocks": lambda docs, items: decontamination.clean(docs, items, "spans", block=1),
    "document_blocks": lambda docs, items: decontamination.clean(docs, items, block=1),
    "secrets": lambda docs, items: secrets.redact(docs),
}


@pytest.mark.parametrize("name", STAGES)
def test_stage(spark, name):
    plain = STAGES[name](documents(spark, []), items(spark))
    docs = documents(spark, CLASHING)
    result = STAGES[name](docs, items(spark))
    assert result.columns == docs.columns
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "text").collect()), key=str)
    assert rows(result) == rows(plain)
    if name != "quality":  # short texts fail its rules
        assert rows(result)
    extra = result.select(F.concat(*(F.col(f"`{c}`") for c in CLASHING)).alias("e")).distinct()
    assert {r["e"] for r in extra.collect()} <= {"x" * len(CLASHING)}


def test_link_reads_key_and_text_only(spark):
    found = near_dup.link(documents(spark, CLASHING), words=2)
    plain = near_dup.link(documents(spark, []), words=2)
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    rows = lambda df: sorted(map(tuple, df.select(*columns).collect()), key=str)
    assert rows(found) == rows(plain)
