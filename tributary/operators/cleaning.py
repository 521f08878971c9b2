"""Cleaning steps: each takes a frame and returns it with columns rewritten."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named

Step = Callable[[DataFrame], DataFrame]


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip outer spaces from every string column in one projection."""
    return df.select(
        *[
            F.trim(named(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else named(f.name)
            for f in df.schema
        ]
    )


def lower(*columns: str) -> Step:
    return lambda df: df.withColumns({c: F.lower(named(c)) for c in columns})


def defaults(values: Mapping[str, object]) -> Step:
    """Replace NULLs; blank text stays as it is."""
    return lambda df: df.fillna(dict(values))


def to_timestamps(*columns: str, strict: bool = True) -> Step:
    """Read columns as timestamps. Malformed text raises, or becomes NULL if not strict."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return lambda df: df.withColumns({c: parse(named(c)) for c in columns})


def clean(df: DataFrame, steps: Iterable[Step] = ()) -> DataFrame:
    """Trim, then apply the table's own steps in order."""
    df = df.transform(trim_strings)
    for step in steps:
        df = df.transform(step)
    return df
