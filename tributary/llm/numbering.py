"""Gapless numbers inside groups, without one task for a group."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLICE = 200_000  # rows that one window sorts


def positions(
    rows: DataFrame,
    group: str,
    count: int,
    row: str = "_row",
    name: str = "_pos",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number the rows of each group 0, 1, 2 ... in an order given by their row ids.

    ``rows`` must be written already, with unique ``row`` ids, and ``group`` must not
    be NULL. Each group is cut into slices by a hash of the row id, so a group that
    holds all rows is numbered by as many tasks as any other; a number is the size of
    the earlier slices plus the place in the own one. ``count`` is about the number
    of rows and only decides how many slices there are.
    """
    slices = max(1, math.ceil(count / rows_per_slice))
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(row), F.lit(slices)))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sliced.groupBy(group, "_slice")
        .count()
        .withColumn("_before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .drop("count")
    )
    own = Window.partitionBy(group, "_slice").orderBy(row)
    return (
        sliced.withColumn("_at", F.row_number().over(own) - 1)
        .join(before, [group, "_slice"])
        .withColumn(name, (F.col("_before") + F.col("_at")).cast("long"))
        .drop("_slice", "_before", "_at")
    )
