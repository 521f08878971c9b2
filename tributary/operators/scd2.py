"""Type-2 slowly changing dimension as a function from image to image.

A version is valid from its start date (inclusive) to its end date (exclusive);
an open end is NULL. Nothing is updated in place: ``apply`` returns the whole
new image, to be written and swapped in one step.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import differs
from ..session import stage_counted
from . import comparison
from .contracts import require_unique
from .keys import continue_key, dense_key

START, END, CURRENT = "effective_start_date", "effective_end_date", "is_current"


@dataclass(frozen=True)
class Versioned:
    """Which columns identify a row and which, when changed, open a new version."""

    surrogate_key: str
    natural_key: str
    tracked: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate_key, self.natural_key, *self.tracked, START, END, CURRENT]

    @property
    def incoming_columns(self) -> list[str]:
        return [self.natural_key, *self.tracked]


def _opened(df: DataFrame, spec: Versioned, run_date: dt.date, *extra: str) -> DataFrame:
    """Numbered rows as versions valid from the run date on."""
    return df.withColumns(
        {START: F.lit(run_date), END: F.lit(None).cast("date"), CURRENT: F.lit(True)}
    ).select(*spec.columns, *extra)


def initial(
    incoming: DataFrame, spec: Versioned, run_date: dt.date, check_unique: bool = True
) -> DataFrame:
    """First load: every row with an id becomes a current version, keys 1..N by id."""
    incoming = incoming.filter(F.col(spec.natural_key).isNotNull())
    if check_unique:
        require_unique(incoming, [spec.natural_key])
    rows = incoming.select(*spec.incoming_columns)
    return _opened(dense_key(rows, spec.surrogate_key, spec.natural_key), spec, run_date)


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(CURRENT))


def as_of(dim: DataFrame, day: dt.date) -> DataFrame:
    """The versions valid on a date; versions that never held for a day match none."""
    at = F.lit(day)
    return dim.filter((F.col(START) <= at) & (F.col(END).isNull() | (at < F.col(END))))


def changed_rows(
    dim: DataFrame, incoming: DataFrame, spec: Versioned, null_safe: bool = True
) -> DataFrame:
    """Incoming rows that differ from a current version (semi join, no fan-out)."""
    old = current(dim).select(*spec.incoming_columns).alias("old")
    same_id = F.col(f"new.{spec.natural_key}") == F.col(f"old.{spec.natural_key}")
    moved = differs(spec.tracked, "new", "old", null_safe)
    return incoming.alias("new").join(old, same_id & moved, "left_semi")


def changed(
    dim: DataFrame, incoming: DataFrame, spec: Versioned, null_safe: bool = True
) -> DataFrame:
    """Natural keys whose tracked attributes changed."""
    rows = changed_rows(dim, incoming, spec, null_safe)
    return rows.select(spec.natural_key).distinct()


def new_rows(dim: DataFrame, incoming: DataFrame, spec: Versioned) -> DataFrame:
    """Incoming rows whose natural key has no version at all."""
    return incoming.join(dim.select(spec.natural_key), spec.natural_key, "left_anti")


def arrivals(
    dim: DataFrame,
    incoming: DataFrame,
    spec: Versioned,
    run_date: dt.date,
    null_safe: bool = True,
) -> DataFrame:
    """The versions a snapshot opens, with ``_is_new`` for ids seen for the first time.

    Keys continue after the highest of all versions: changed ids first, then new
    ones, each in natural-key order. Rows without an id cannot be versioned and
    open none; filtering them up front also gives both joins the same input, so
    that they share one exchange of the snapshot.
    """
    incoming = incoming.select(*spec.incoming_columns).filter(
        F.col(spec.natural_key).isNotNull()
    )
    again = changed_rows(dim, incoming, spec, null_safe).withColumn("_is_new", F.lit(False))
    first = new_rows(dim, incoming, spec).withColumn("_is_new", F.lit(True))
    numbered = continue_key(
        again.unionByName(first), dim, spec.surrogate_key, ["_is_new", spec.natural_key]
    )
    return _opened(numbered, spec, run_date, "_is_new")


def expire(dim: DataFrame, ids: DataFrame, spec: Versioned, run_date: dt.date) -> DataFrame:
    """The current rows of these ids, closed at the run date."""
    return (
        current(dim)
        .join(ids.select(spec.natural_key), spec.natural_key, "left_semi")
        .withColumns({END: F.lit(run_date), CURRENT: F.lit(False)})
        .select(*spec.columns)
    )


def touched(
    dim: DataFrame,
    incoming: DataFrame,
    spec: Versioned,
    run_date: dt.date,
    null_safe: bool = True,
    check_unique: bool = True,
) -> DataFrame:
    """The current rows of ``dim`` after a snapshot: kept, closed now, and opened.

    What was closed before is not among them and need not be written again. Of closed rows only
    the id is read, to tell new ids from those that were seen once.
    """
    incoming = incoming.filter(F.col(spec.natural_key).isNotNull())
    if check_unique:
        require_unique(incoming, [spec.natural_key])
    opened = arrivals(dim, incoming, spec, run_date, null_safe)
    ids = opened.filter(~F.col("_is_new")).select(F.col(spec.natural_key).alias("_changed"))
    is_changed = F.col("_changed").isNotNull()
    kept = (
        current(dim)
        .join(ids.distinct(), F.col(spec.natural_key) == F.col("_changed"), "left")
        .withColumns(
            {END: F.when(is_changed, F.lit(run_date)).otherwise(F.col(END)), CURRENT: ~is_changed}
        )
    )
    return kept.select(*spec.columns).unionByName(opened.drop("_is_new"))


def touched_since(
    dim: DataFrame,
    before: DataFrame,
    incoming: DataFrame,
    spec: Versioned,
    run_date: dt.date,
    null_safe: bool = True,
) -> DataFrame:
    """As ``touched``, fed by the difference to ``before``, the snapshot merged last.

    Two snapshots are compared by hashes of their rows, and only rows of ids that are new or
    other meet the dimension, so attributes are joined for those alone, and not at all
    if nothing has changed. Ids that ``before`` holds must have been merged.
    """
    columns = spec.incoming_columns
    present = [df.select(*columns).filter(F.col(spec.natural_key).isNotNull()) for df in (before, incoming)]
    require_unique(present[1], [spec.natural_key])
    moved = comparison.differences(*present, spec.natural_key, with_unchanged=False)
    moved, count = stage_counted(
        moved.filter(F.col("change") != comparison.REMOVED).select(spec.natural_key), "moved"
    )
    if not count:
        return current(dim).select(*spec.columns)
    news = present[1].join(moved, spec.natural_key, "left_semi")
    return touched(dim, news, spec, run_date, null_safe, check_unique=False)


def closed(dim: DataFrame) -> DataFrame:
    """The rows that no snapshot changes any more."""
    return dim.filter(F.col(CURRENT).isNull() | ~F.col(CURRENT))


def apply(
    dim: DataFrame,
    incoming: DataFrame,
    spec: Versioned,
    run_date: dt.date,
    null_safe: bool = True,
    check_unique: bool = True,
) -> DataFrame:
    """The dimension after a snapshot: changed ids get a new version, new ids one.

    Ids missing from the snapshot stay current. Closed history only passes
    through, so it is never shuffled; current rows are joined with the changed
    ids alone, which Catalyst broadcasts when their files are small. Rows without an
    id open no version and count as no repetition. A table with closed rows in partitions of
    their own takes ``touched`` instead and leaves those as they lie (``Lake.part_image``).
    """
    now = touched(dim, incoming, spec, run_date, null_safe, check_unique)
    return closed(dim).select(*spec.columns).unionByName(now)
