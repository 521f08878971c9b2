"""Rows joined with the version that was valid at their time, and the shape of a history.

A version is valid from its start (inclusive) to its end (exclusive); an open end is NULL, and
a version that ends where it starts was never valid.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .scd2 import CURRENT, END, START, Versioned

MOMENTS_PER_SLICE = 500_000  # moments of one id that a task sorts


def _order(moment: str) -> Column:
    """A date or timestamp as a number, to the microsecond."""
    return F.unix_micros(F.col(moment).cast("timestamp"))


def _cuts(moments: DataFrame, rows_per_slice: int) -> DataFrame | None:
    """``_id``, ``_cuts``: where the time of ids with very many moments is cut, or None.

    The cuts are quantiles from a sketch of the id's moments. There are as many for each such
    id as the largest one needs, so that the number is a literal.
    """
    counts = moments.groupBy("_id").agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n").alias("n")).first()["n"] or 0
    if most <= rows_per_slice:
        return None
    slices = math.ceil(most / rows_per_slice)
    shares = [i / slices for i in range(1, slices)]
    hot = counts.filter(F.col("n") > rows_per_slice).select("_id")
    accuracy = F.lit(max(10_000, 20 * slices))
    cuts = F.array_distinct(F.percentile_approx(_order("_at"), shares, accuracy))
    return moments.join(hot, "_id", "left_semi").groupBy("_id").agg(cuts.alias("_cuts"))


def _slice(cuts: str, at: Column) -> Column:
    """How many cuts lie at or before a moment; ids without cuts have one slice."""
    passed = F.size(F.filter(cuts, lambda c: c <= at))
    return F.when(F.col(cuts).isNull(), F.lit(0)).otherwise(passed)


def valid_versions(
    moments: DataFrame,
    versions: DataFrame,
    start: str,
    end: str,
    payload: list[str],
    rows_per_slice: int = MOMENTS_PER_SLICE,
) -> DataFrame:
    """``_id``, ``_at`` and the payload of the version valid then, for distinct moments.

    Starts of versions and moments are sorted together and the last start is carried on, so no
    range is joined. The ids with very many moments are cut by ranges of time; a version is
    present in each range it reaches into.
    """
    known = versions.select(
        "_id", F.col(start).alias("_from"), F.col(end).alias("_to"), *payload
    ).filter(F.col("_from").isNotNull() & (F.col("_to").isNull() | (F.col("_from") < F.col("_to"))))
    cuts = _cuts(moments, rows_per_slice)
    if cuts is None:
        moments, known = (df.withColumn("_slice", F.lit(0)) for df in (moments, known))
    else:
        moments = moments.join(cuts, "_id", "left").withColumn("_slice", _slice("_cuts", _order("_at")))
        known = known.join(cuts, "_id", "left")
        last = F.when(F.col("_to").isNull(), F.coalesce(F.size("_cuts"), F.lit(0))).otherwise(
            _slice("_cuts", _order("_to"))
        )
        last = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(last)
        known = known.withColumn("_slice", F.explode(F.sequence(_slice("_cuts", _order("_from")), last)))
    held = F.struct("_to", *payload)
    sorted_in = Window.partitionBy("_id", "_slice").orderBy("_at", "_is_moment", *payload)
    carried = F.last("_version", ignorenulls=True).over(
        sorted_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    no_version = F.lit(None).cast(known.select(held.alias("v")).schema["v"].dataType)
    nothing = [F.lit(None).cast(known.schema[c].dataType).alias(c) for c in payload]
    both = known.select(
        "_id", "_slice", F.col("_from").alias("_at"), F.lit(0).alias("_is_moment"), held.alias("_version"), *payload
    ).unionByName(
        moments.select("_id", "_slice", "_at", F.lit(1).alias("_is_moment"), no_version.alias("_version"), *nothing)
    )
    found = both.select("_id", "_at", "_is_moment", carried.alias("_version")).filter("_is_moment = 1")
    holds = F.col("_version._to").isNull() | (F.col("_at") < F.col("_version._to"))
    return found.filter(F.col("_version").isNotNull() & holds).select(
        "_id", "_at", *(F.col(f"_version.{c}").alias(c) for c in payload)
    )


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    on: tuple[str, str],
    at: Column,
    columns: list[str],
    start: str = START,
    end: str = END,
    rows_per_slice: int = MOMENTS_PER_SLICE,
) -> DataFrame:
    """All rows with ``columns`` of the version of their id that was valid ``at`` their time.

    ``on`` names the id in the rows and in the versions. ``at`` must have the type of
    ``start``. Rows without an id, a time or a valid version get NULLs. If versions of an id overlap,
    the one that started last counts, and of those the one with the greatest columns.

    Rows are reduced to their distinct ids and times before any sorting; the rows themselves
    are moved once, by id and time, with the large side on the left, which AQE can split.
    """
    mine, theirs = on
    timed = rows.withColumn("_at", at)
    moments = stage(
        timed.select(F.col(mine).alias("_id"), "_at").filter("_id is not null and _at is not null").distinct(),
        "moments",
    )
    known = versions.withColumnRenamed(theirs, "_id").filter("_id is not null")
    named = {c: f"_v_{c}" for c in columns}
    known = known.withColumnsRenamed(named)
    found = valid_versions(moments, known, start, end, list(named.values()), rows_per_slice)
    found = found.withColumnsRenamed({"_id": "_known_id", "_at": "_known_at"})
    same = (F.col(mine) == F.col("_known_id")) & (F.col("_at") == F.col("_known_at"))
    return timed.join(found, same, "left").select(
        *rows.columns, *(F.col(v).alias(c) for c, v in named.items())
    )


def history_faults(dim: DataFrame, spec: Versioned) -> DataFrame:
    """What is wrong with the shape of a history: natural key, ``fault``, ``from_date``, ``to_date``, ``versions``.

    * ``overlap``: a stretch in which ``versions`` of them are valid at once;
    * ``gap``: a stretch between two versions in which none is;
    * ``reversed``: a version that ends before it starts; it counts for nothing else;
    * ``several_current``: more than one row flagged as current, with their number;
    * ``flag``: rows of one start and end whose flag does not say whether the end is open.

    Stretches reach from one start or end to the next. Starts and ends are added up by id and
    day before the sweep, so a window holds the days of an id, however many its versions.
    Rows without an id or a start are not part of a history.
    """
    key = spec.natural_key
    rows = dim.select(F.col(key), F.col(START), F.col(END), F.col(CURRENT)).filter(
        F.col(key).isNotNull() & F.col(START).isNotNull()
    )
    is_reversed = F.coalesce(F.col(END) < F.col(START), F.lit(False))
    events = rows.filter(~is_reversed).select(
        key,
        F.inline(
            F.array(
                F.struct(F.col(START).alias("day"), F.lit(1).alias("step")),
                F.struct(F.col(END).alias("day"), F.lit(-1).alias("step")),
            )
        ),
    )
    steps = (
        events.filter("day is not null")
        .groupBy(key, "day")
        .agg(F.sum("step").alias("step"))
        .filter("step <> 0")
    )
    by_day = Window.partitionBy(key).orderBy("day")
    swept = steps.select(
        key,
        F.col("day").alias("from_date"),
        F.lead("day").over(by_day).alias("to_date"),
        F.sum("step").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("versions"),
    )
    stretches = swept.filter("versions > 1 or (versions = 0 and to_date is not null)").select(
        key, F.when(F.col("versions") > 1, "overlap").otherwise("gap").alias("fault"),
        "from_date", "to_date", "versions",
    )
    is_current = F.coalesce(F.col(CURRENT), F.lit(False))
    no_day = F.lit(None).cast(dim.schema[START].dataType)
    current = (
        rows.filter(is_current)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("versions"))
        .filter("versions > 1")
        .select(key, F.lit("several_current").alias("fault"), no_day.alias("from_date"),
                no_day.alias("to_date"), "versions")
    )
    wrong_flag = is_current != F.col(END).isNull()
    single = (
        rows.filter(is_reversed | wrong_flag)
        .select(key, F.explode(F.array_compact(F.array(
            F.when(is_reversed, "reversed"), F.when(wrong_flag, "flag")))).alias("fault"),
            F.col(START).alias("from_date"), F.col(END).alias("to_date"))
        .groupBy(key, "fault", "from_date", "to_date")
        .agg(F.count(F.lit(1)).alias("versions"))
    )
    return stretches.unionByName(current).unionByName(single)
