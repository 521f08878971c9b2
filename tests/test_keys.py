import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import keys


def numbers(df, key="k"):
    return sorted(row[key] for row in df.select(key).collect())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rows_per_slice", [7, 100, 10_000])
def test_dense_key_ranks_any_order(spark, seed, rows_per_slice):
    ids = random.Random(seed).sample(range(10_000), 400)
    df = spark.createDataFrame([(i,) for i in ids], "id int").repartition(5)
    keyed = keys.dense_key(df, "k", "id", rows_per_slice=rows_per_slice)
    assert [(r["id"], r["k"]) for r in keyed.orderBy("id").collect()] == [
        (i, n) for n, i in enumerate(sorted(ids), 1)
    ]


def test_dense_key_of_nothing(spark):
    df = spark.createDataFrame([], "id int")
    assert keys.dense_key(df, "k", "id").collect() == []
    assert keys.max_key(keys.dense_key(df, "k", "id"), "k") == 0


@pytest.mark.parametrize("order_by", ["hot", ["hot", "id"]])
def test_hot_key_and_copies_are_spread(spark, order_by):
    """A third of the rows share a key, another third are copies of one row."""
    df = spark.range(900).select(
        F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("hot"),
        F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("id"),
    )
    keyed = keys.dense_key(df, "k", order_by, rows_per_slice=100)
    assert numbers(keyed) == list(range(1, 901))
    hot = keyed.filter("hot = 1")
    assert numbers(hot) == list(range(1, 601))


def test_slices_stay_even_under_copies(spark, monkeypatch):
    """Equal rows are cut into slices like any others."""
    written = {}

    def stage(df, label):
        written[label] = keys.stage_counted(df, label)[0]
        return written[label]

    monkeypatch.setattr(keys, "stage", stage)
    df = spark.range(40_000).select(F.lit(7).alias("id"))
    keyed = keys.dense_key(df, "k", "id", rows_per_slice=4_000)
    assert numbers(keyed) == list(range(1, 40_001))
    slices = written["slices"].groupBy(F.shiftright("_slot", 33)).count().collect()
    assert len(slices) == 10
    assert max(r["count"] for r in slices) < 8_000


def test_same_numbers_on_every_read(spark):
    df = spark.range(500).select(F.xxhash64("id").alias("id"), F.rand(1).alias("x"))
    keyed = keys.dense_key(df, "k", "id", rows_per_slice=50)
    assert sorted(keyed.collect()) == sorted(keyed.collect())


def test_continuation_sees_the_highest_key(spark):
    existing = spark.createDataFrame([(3, "a"), (9, "b")], "k bigint, id string")
    new = spark.createDataFrame([("z",), ("c",)], "id string")
    keyed = keys.continue_key(new, existing, "k", "id").collect()
    assert {r["id"]: r["k"] for r in keyed} == {"c": 10, "z": 11}


def test_unique_key_is_unique(spark):
    keyed = keys.unique_key(spark.range(1000).repartition(7), "k")
    assert keyed.select("k").distinct().count() == 1000


def test_no_window_and_nulls_first(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "id int")
    keyed = keys.dense_key(df, "k", "id")
    assert "Window" not in keyed._jdf.queryExecution().toString()
    assert {r["id"]: r["k"] for r in keyed.collect()} == {None: 1, 1: 2, 2: 3}


def test_rows_from_files_are_written_once(spark, tmp_path, monkeypatch):
    """A scan is settled: no copy before the slices, and none at all for a single slice."""
    written = []
    counted, staged = keys.stage_counted, keys.stage
    monkeypatch.setattr(keys, "stage_counted", lambda df, label: written.append(label) or counted(df, label))
    monkeypatch.setattr(keys, "stage", lambda df, label: written.append(label) or staged(df, label))
    spark.range(3000).selectExpr("pmod(xxhash64(id), 900) as id", "'x' as text").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").filter("id <> 5")
    expected = df.count()
    for rows, labels in ((500, ["slices"]), (10_000, [])):
        written.clear()
        keyed = keys.dense_key(df, "k", "id", rows_per_slice=rows)
        assert written == labels
        assert numbers(keyed) == list(range(1, expected + 1))
        ranked = [r["id"] for r in keyed.orderBy("k").collect()]
        assert ranked == sorted(ranked)
    for other in (df.distinct(), df.join(df.select("id").limit(3), "id"), spark.createDataFrame([(1,)], "id int")):
        assert not keys.settled(other)
        written.clear()
        keys.dense_key(other, "k", "id")
        assert written == ["rows"]
