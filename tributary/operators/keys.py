"""Surrogate keys without a single-task window."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import row_hash
from ..session import stage, stage_counted

ROWS_PER_SLICE = 500_000  # rows sorted by one task
_SLOT_BITS = 33  # monotonically_increasing_id: partition above, row position below


def unique_key(df: DataFrame, key: str) -> DataFrame:
    """A unique but sparse key that changes when the frame is rebuilt."""
    return df.withColumn(key, F.monotonically_increasing_id())


#: Parts of a plan behind which rows may come in another order, or be others, when a task runs again.
_UNSETTLED = re.compile(
    r"Exchange|Python|Pandas|Arrow|JDBC|BatchScan|ExistingRDD|InMemory(Relation|TableScan)|uuid\(|shuffle\("
)


def settled(df: DataFrame) -> bool:
    """Does every run of a task see the same rows in the same order, as a scan of files does?"""
    return not _UNSETTLED.search(df._jdf.queryExecution().executedPlan().toString())


def dense_key(
    df: DataFrame,
    key: str,
    order_by: str | list[str],
    start: int = 0,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number the rows ``start+1 .. start+N`` in the order of ``order_by``.

    The frame is range-partitioned and sorted slice by slice; a row's number is
    the size of the slices before its own plus its position. Rows that tie on
    ``order_by`` are ordered by a hash of their other columns and exact copies
    by a row id, so neither a hot key nor a hot group of copies ends up in one
    slice. Slices are written before they are read twice, and so are the rows with
    their ids unless the frame is ``settled``: a lost executor cannot move a row between the
    count and the numbering. So rows that come straight from files are moved once and written
    once, or not at all if one slice holds them. The driver
    adds up one size a slice, which is 16 bytes for ``rows_per_slice`` rows.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = df.columns
    rows = df.withColumn("_tie", row_hash(df, order_by)).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    if settled(df):
        count = df.count()
    else:
        rows, count = stage_counted(rows, "rows")
    slices = max(1, math.ceil(count / rows_per_slice))
    order = [*order_by, "_tie", "_row"]
    ranked = (
        rows.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .select(*columns, F.monotonically_increasing_id().alias("_slot"))
    )
    if slices == 1:
        return ranked.withColumn(key, F.col("_slot") + F.lit(start + 1)).select(*columns, key)

    ranked = stage(ranked, "slices").withColumn("_slice", F.shiftright("_slot", _SLOT_BITS))
    offsets, before = [], start
    for row in sorted(ranked.groupBy("_slice").count().collect()):  # one row per slice
        offsets.append((row["_slice"], before))
        before += row["count"]
    lookup = df.sparkSession.createDataFrame(offsets, "_slice bigint, _before bigint")
    position = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (
        ranked.join(lookup, "_slice")
        .withColumn(key, F.col("_before") + position + F.lit(1))
        .select(*columns, key)
    )


def max_key(df: DataFrame, key: str) -> int:
    """The highest key handed out so far; 0 for an empty table."""
    return int(df.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"])


def continue_key(
    df: DataFrame, existing: DataFrame, key: str, order_by: str | list[str]
) -> DataFrame:
    """Number new rows after the keys of all existing ones."""
    return dense_key(df, key, order_by, start=max_key(existing, key))
