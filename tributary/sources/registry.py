"""The registry of source tables: one row per table with an active flag."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# The columns of the registry.
SCHEMA = (
    "table_name string, file_name string, active_flag string, "
    "created_date date, modified_date date"
)


def entries(spark: SparkSession, tables: Iterable[tuple[str, str]], day: dt.date) -> DataFrame:
    """Active registry rows for ``(table name, file name)`` pairs."""
    return spark.createDataFrame([(t, f, "Y", day, day) for t, f in tables], SCHEMA)


def missing(seed: DataFrame, existing: DataFrame, key: str = "table_name") -> DataFrame:
    """Seed rows whose key is not there yet."""
    return seed.join(existing.select(key), key, "left_anti").select(*seed.columns)


def insert_if_absent(existing: DataFrame, seed: DataFrame, key: str = "table_name") -> DataFrame:
    """Existing rows and the missing seed rows; applying it again adds nothing."""
    return existing.unionByName(missing(seed, existing, key))


def active(registry: DataFrame) -> DataFrame:
    return registry.filter("active_flag = 'Y'").select("table_name", "file_name")
