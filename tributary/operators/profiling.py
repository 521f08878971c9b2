"""Table profiles: row, NULL and duplicate counts, column types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import hashable, named, row_hash
from ..session import stage


def null_metrics(df: DataFrame) -> list[Column]:
    """Row count and NULLs per column as aggregates, for ``agg`` or ``observe``."""
    return [F.count(F.lit(1)).alias("total_rows")] + [
        F.count_if(named(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)
    ]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def column_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, row count, NULL count.

    All counts come from one global aggregate; its single row is then unfolded.
    """
    lines = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(data_type).alias("data_type"),
            F.col("total_rows").alias("total_rows"),
            F.col(f"null_{i}").alias("null_count"),
        )
        for i, (name, data_type) in enumerate(df.dtypes)
    ]
    return df.agg(*null_metrics(df)).select(F.inline(F.array(*lines)))


def null_counts(df: DataFrame) -> DataFrame:
    return column_report(df).select("column_name", "null_count")


def null_columns(df: DataFrame) -> DataFrame:
    """Only the columns that hold NULLs."""
    return null_counts(df).filter("null_count > 0")


def schema_summary(df: DataFrame) -> DataFrame:
    return column_report(df).select("position", "column_name", "data_type", "total_rows")


NARROW_BYTES = 40  # rows up to this width are shuffled whole
_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def _is_narrow(schema: T.StructType) -> bool:
    """Few fixed-width columns only, so that a hash would hardly be smaller."""
    widths = []
    for f in schema:
        if isinstance(f.dataType, T.DecimalType) and f.dataType.precision <= 18:
            widths.append(8)
        else:
            widths.append(_WIDTHS.get(type(f.dataType), NARROW_BYTES + 1))
    return sum(widths) <= NARROW_BYTES


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows (NULLs are equal).

    Copies collapse before a shuffle, so a large group of them costs little.
    Narrow rows are compared directly. For others only 8-byte hashes of the whole
    table are shuffled: rows whose hash is unique have no copy, and just the rest
    is compared in full, so hash collisions cannot change the result. The repeated
    hashes are written first; from the size of their files Spark knows whether to
    broadcast them before it would shuffle the rows. Tables with a map column are
    not supported, as with ``distinct``.
    """
    unsupported = [f.name for f in df.schema if not hashable(f.dataType)]
    if unsupported:
        raise TypeError(f"columns that cannot be compared: {unsupported}")
    candidates = df
    if not _is_narrow(df.schema):
        hashed = df.withColumn("_hash", row_hash(df))
        repeated = hashed.groupBy("_hash").count().filter("count > 1").select("_hash")
        candidates = hashed.join(stage(repeated, "repeated"), "_hash", "left_semi")
    groups = candidates.groupBy(*[named(c) for c in df.columns])
    copies = groups.agg(F.count(F.lit(1)).alias("_copies"))
    extra = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint")
    return copies.agg(extra.alias("duplicate_rows"))
