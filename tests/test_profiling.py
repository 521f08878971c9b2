import math

import pytest
from pyspark.sql import functions as F

from tributary.operators import profiling


def extra(df):
    return profiling.duplicate_count(df).first()["duplicate_rows"]


def test_empty_table_counts_zero(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert [tuple(r) for r in profiling.null_counts(df).collect()] == [("a", 0), ("b", 0)]
    assert profiling.null_columns(df).collect() == []
    assert profiling.row_count(df).first()["total_rows"] == 0
    assert extra(df) == 0


def test_nulls_are_equal_and_copies_counted(spark):
    rows = [(1, None), (1, None), (1, None), (None, "x"), (2, "y"), (2, "y")]
    df = spark.createDataFrame(rows, "a int, b string")
    assert extra(df) == 3
    assert extra(df) == df.count() - df.distinct().count()


@pytest.mark.parametrize("narrow_bytes", [0, 40])
def test_zeros_and_nans_compare_as_in_distinct(spark, monkeypatch, narrow_bytes):
    monkeypatch.setattr(profiling, "NARROW_BYTES", narrow_bytes)
    df = spark.createDataFrame(
        [(0.0,), (-0.0,), (math.nan,), (float("nan"),), (1.5,)], "a double"
    )
    assert extra(df) == df.count() - df.distinct().count() == 2


def test_hash_collisions_do_not_count(spark, monkeypatch):
    """With one hash for all rows the full comparison alone must be right."""
    monkeypatch.setattr(profiling, "row_hash", lambda df: F.lit(1).cast("bigint"))
    monkeypatch.setattr(profiling, "NARROW_BYTES", 0)
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "a int")
    assert extra(df) == 1


@pytest.mark.parametrize("narrow_bytes", [0, 40])
def test_third_of_rows_is_one_copy(spark, monkeypatch, narrow_bytes):
    monkeypatch.setattr(profiling, "NARROW_BYTES", narrow_bytes)
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    assert extra(df.toDF("a")) == 2999


def test_only_few_fixed_width_columns_are_narrow(spark):
    def narrow(ddl):
        return profiling._is_narrow(spark.createDataFrame([], ddl).schema)

    assert narrow("a bigint, b bigint, c int, d int, e decimal(10,2)")
    assert not narrow("a int, b string")
    assert not narrow("a bigint, b bigint, c bigint, d bigint, e bigint, f int")
    assert not narrow("a decimal(30,2)")


def test_maps_are_refused(spark):
    df = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    with pytest.raises(TypeError, match="m"):
        profiling.duplicate_count(df)


def test_schema_summary_keeps_order(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    rows = [tuple(r) for r in profiling.schema_summary(df).collect()]
    assert rows == [(1, "b", "int", 1), (2, "a", "string", 1)]


def test_column_names_with_dots(spark):
    from tributary.operators import cleaning, quality

    df = spark.createDataFrame([(" x ", None), (None, 1)], "`a.b` string, `c.d` int")
    assert [r["null_count"] for r in profiling.null_counts(df).collect()] == [1, 1]
    assert profiling.duplicate_count(df).first()["duplicate_rows"] == 0
    assert [r[0] for r in cleaning.clean(df).collect()] == ["x", None]
    valid, bad = quality.split(df, [quality.NotNull("a.b")])
    assert valid.count() == 1 and bad.count() == 1
