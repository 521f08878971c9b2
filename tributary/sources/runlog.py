"""The log of snapshot runs: one row per table and run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUCCESS, FAILED = "SUCCESS", "FAILED"
SCHEMA = (
    "table_name string, execution_time timestamp, status string, source_row_count bigint, "
    "target_row_count bigint, file_location string, created_date date"
)


@dataclass(frozen=True)
class Run:
    table_name: str
    execution_time: dt.datetime
    status: str
    source_row_count: int
    target_row_count: int
    file_location: str
    created_date: dt.date


def to_frame(spark: SparkSession, runs: Iterable[Run]) -> DataFrame:
    return spark.createDataFrame([astuple(r) for r in runs], SCHEMA)


def latest_success(log: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """Location of the newest good snapshot per table; equal times go by location.

    With ``active`` only the tables listed there are considered.
    """
    good = log.filter(F.col("status") == SUCCESS)
    if active is not None:
        good = good.join(active.select("table_name"), "table_name", "left_semi")
    newest = F.max_by("file_location", F.struct("execution_time", "file_location"))
    return good.groupBy("table_name").agg(newest.alias("file_location"))


def reconcile(log: DataFrame) -> DataFrame:
    """Runs and row counts per table, and the runs whose counts disagree."""
    differ = F.col("source_row_count") != F.col("target_row_count")
    return log.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("source_row_count").alias("source_rows"),
        F.sum("target_row_count").alias("target_rows"),
        F.count_if(differ).alias("mismatched_runs"),
    )


def raise_on_failure(runs: Iterable[Run]) -> None:
    """Stop the load, naming the failed tables, once all have been tried."""
    failed = [r.table_name for r in runs if r.status == FAILED]
    if failed:
        raise RuntimeError(f"raw load failed for tables: {failed}")
