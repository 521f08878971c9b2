"""Type-1 dimensions and the date dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_parts
from ..session import stage
from .keys import continue_key, dense_key


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Select ``target name -> source column or expression``."""
    return df.select(
        *[(F.col(s) if isinstance(s, str) else s).alias(t) for t, s in mapping.items()]
    )


def _single(df: DataFrame, column: str, *values: Column) -> DataFrame:
    """The values of a column that just one row has, with other values of that row."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"), *values)
    return counted.filter("_rows = 1").drop("_rows")


def build(
    df: DataFrame,
    mapping: Mapping[str, str | Column],
    natural_key: str,
    key: str,
    present: DataFrame | None = None,
) -> DataFrame:
    """Project a source table and number its rows by natural key.

    The key depends on the data alone. With ``present``, the dimension as it is, known
    ids keep their keys and only new ones are numbered, after its highest key, so that
    a new id moves no other. A row whose id is NULL, or repeats on either side, cannot be
    told from others and is numbered anew.
    """
    rows = project(df, mapping)
    if present is None:
        return dense_key(rows, key, natural_key).select(key, *mapping)
    known = _single(present, natural_key, F.max(key).alias(key)).join(
        _single(rows, natural_key), natural_key
    )
    rows = stage(rows.join(known, natural_key, "left").select(key, *mapping), "matched")
    kept = rows.filter(F.col(key).isNotNull())
    new = rows.filter(F.col(key).isNull()).drop(key)
    numbered = continue_key(new, present, key, natural_key)
    return kept.unionByName(numbered.select(key, *mapping))


def date_dimension(df: DataFrame, moment: str) -> DataFrame:
    """One row per date that occurs in ``moment``."""
    days = df.select(F.to_date(F.col(moment)).alias("full_date")).distinct()
    parts = date_parts("full_date")
    return days.select(
        parts.pop("date_key").alias("date_key"),
        "full_date",
        *[c.alias(n) for n, c in parts.items()],
    )
