"""Column expressions shared by the operators; all built in, none a UDF."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(column: str) -> Column:
    """The column of just this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def any_of(conditions: Iterable[Column]) -> Column:
    """OR over the conditions; false when there are none."""
    conditions = list(conditions)
    return reduce(or_, conditions) if conditions else F.lit(False)


def differs(columns: Iterable[str], left: str, right: str, null_safe: bool = True) -> Column:
    """Does any column differ between two join sides?

    ``null_safe`` counts a change from or to NULL; without it such a change
    compares as NULL and goes unseen.
    """
    pairs = [(F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in columns]
    if null_safe:
        return any_of(~a.eqNullSafe(b) for a, b in pairs)
    return F.coalesce(any_of(a != b for a, b in pairs), F.lit(False))


def row_json(columns: Iterable[str]) -> Column:
    """The row as a JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*[named(c) for c in columns]))


def hashable(data_type: T.DataType) -> bool:
    """Maps and variants can be neither hashed nor grouped."""
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return hashable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(hashable(f.dataType) for f in data_type)
    return True


def row_hash(df: DataFrame, without: Iterable[str] = ()) -> Column:
    """64-bit hash over the hashable columns; equal rows have equal hashes."""
    skip = set(without)
    names = [f.name for f in df.schema if f.name not in skip and hashable(f.dataType)]
    return F.xxhash64(*[named(n) for n in names]) if names else F.lit(0).cast("long")


def date_parts(day: str) -> dict[str, Column]:
    """Calendar attributes of a date column (weeks start on Sunday = 1)."""
    d = F.col(day)
    return {
        "date_key": F.date_format(d, "yyyyMMdd").cast("int"),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }
