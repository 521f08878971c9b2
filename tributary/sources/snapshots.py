"""Immutable, run-stamped Parquet snapshots of source tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import comparison

FORMAT = "parquet"


class CountMismatch(ValueError):
    """A snapshot does not hold the rows that were read from its source."""

    def __init__(self, source_rows: int, target_rows: int):
        super().__init__(f"row counts differ: source {source_rows}, target {target_rows}")
        self.source_rows, self.target_rows = source_rows, target_rows


class ContentMismatch(ValueError):
    """A snapshot holds as many rows as were read from its source, but not the same."""

    def __init__(self, source: comparison.Fingerprint, target: comparison.Fingerprint):
        columns = source.differing(target) or ["values moved between rows"]
        super().__init__(f"contents differ: {', '.join(columns)}")
        self.source, self.target = source, target


def location(base: str, table: str, run_at: dt.datetime) -> str:
    """``base/table/yyyy/MM/dd/table_yyyyMMdd_HHmmss.parquet``, the stamp in UTC."""
    if run_at.tzinfo is not None:
        run_at = run_at.astimezone(dt.timezone.utc)
    name = table.lower()
    return f"{base.rstrip('/')}/{name}/{run_at:%Y/%m/%d}/{name}_{run_at:%Y%m%d_%H%M%S}.parquet"


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write(df: DataFrame, path: str) -> int:
    """Write a snapshot, never over an old one; returns the rows read from the source.

    The rows are counted while they are written: the source is read once.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    return seen.get["rows"]


def reconcile(df: DataFrame, path: str) -> tuple[int, int]:
    """Write a snapshot and count it back; raises if rows were lost or gained."""
    source_rows = write(df, path)
    target_rows = read(df.sparkSession, path).count()  # Parquet footers only
    if source_rows != target_rows:
        raise CountMismatch(source_rows, target_rows)
    return source_rows, target_rows


def write_fingerprinted(df: DataFrame, path: str) -> comparison.Fingerprint:
    """As ``write``, but returns the fingerprint of the rows as they were read from the source."""
    seen = Observation()
    metrics = comparison.fingerprint_metrics(df)
    df.observe(seen, *metrics).write.mode("errorifexists").parquet(path)
    return comparison.as_fingerprint(df, seen.get)


def reconcile_content(df: DataFrame, path: str) -> comparison.Fingerprint:
    """Write a snapshot and compare what a reader finds with what was written, value by value.

    The source is read once and the snapshot once; raises if a row is lost, gained or other.
    """
    source = write_fingerprinted(df, path)
    target = comparison.fingerprint(read(df.sparkSession, path).select(*df.columns))
    if source.rows != target.rows:
        raise CountMismatch(source.rows, target.rows)
    if source != target:
        raise ContentMismatch(source, target)
    return source
