"""Contents compared without order: fingerprints of tables, and differences of snapshots.

A row is two 64-bit hashes that tell NULL from a value in each column. Rows are added up, so a
fingerprint does not depend on their order or on files, and is combined like any sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.columns import hashable, named

ADDED, REMOVED, CHANGED, UNCHANGED = "added", "removed", "changed", "unchanged"


def _hashed(df: DataFrame, column: str) -> list[Column]:
    """What a column adds to a hash; its NULL differs from every value."""
    value = named(column)
    if not hashable(df.schema[column].dataType):
        value = F.to_json(F.struct(value))
    return [value, value.isNull()]


def row_hashes(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Two independent hashes of a row, over the columns in their order."""
    parts = [p for c in columns or df.columns for p in _hashed(df, c)]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (0, 1)]


def _total(hash_: Column) -> Column:
    return F.coalesce(F.sum(hash_.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


@dataclass(frozen=True)
class Fingerprint:
    """Of a multiset of rows: their number, the sums of both hashes, and one sum per column."""

    rows: int
    sums: tuple[Decimal, Decimal]
    columns: dict[str, Decimal] = field(default_factory=dict)

    def differing(self, other: Fingerprint) -> list[str]:
        """Columns that one side lacks or whose values, taken by themselves, differ."""
        names = [*self.columns, *(c for c in other.columns if c not in self.columns)]
        return [c for c in names if self.columns.get(c) != other.columns.get(c)]


def fingerprint_metrics(df: DataFrame) -> list[Column]:
    """The aggregates behind a fingerprint, for ``observe`` or ``agg``."""
    one, two = row_hashes(df)
    each = [
        _total(F.xxhash64(*_hashed(df, c))).alias(f"column_{i}") for i, c in enumerate(df.columns)
    ]
    return [F.count(F.lit(1)).alias("rows"), _total(one).alias("one"), _total(two).alias("two"), *each]


def as_fingerprint(df: DataFrame, found: Row | dict) -> Fingerprint:
    """The fingerprint from the values of ``fingerprint_metrics``."""
    columns = {c: found[f"column_{i}"] for i, c in enumerate(df.columns)}
    return Fingerprint(found["rows"], (found["one"], found["two"]), columns)


def fingerprint(df: DataFrame) -> Fingerprint:
    return as_fingerprint(df, df.agg(*fingerprint_metrics(df)).first())


def differences(before: DataFrame, after: DataFrame, key: str, with_unchanged: bool = True) -> DataFrame:
    """``key``, ``change``, ``rows_before``, ``rows_after`` for every id of two snapshots.

    Only ids and hashes are moved, whatever the width of the rows, and rows of an id are added up
    before that, so a hot id is no burden. An id that repeats is unchanged if both sides have the
    same rows of it, in any order; NULL is an id like others. Columns are matched by name,
    and one that a side lacks changes every id that both have.
    """
    shared = sorted(set(before.columns) | set(after.columns))

    def reduced(df: DataFrame, side: str) -> DataFrame:
        same = df.select(*(named(c) if c in df.columns else F.lit(f"no {side}").alias(c) for c in shared))
        one, two = row_hashes(same, shared)
        return same.groupBy(named(key).alias(f"_key_{side}")).agg(
            F.count(F.lit(1)).alias(f"rows_{side}"), _total(one).alias(f"_one_{side}"), _total(two).alias(f"_two_{side}")
        )

    both = reduced(before, "before").join(
        reduced(after, "after"), F.col("_key_before").eqNullSafe(F.col("_key_after")), "full"
    )
    equal = [F.col(f"{c}_before") == F.col(f"{c}_after") for c in ("rows", "_one", "_two")]
    change = (
        F.when(F.col("rows_before").isNull(), ADDED)
        .when(F.col("rows_after").isNull(), REMOVED)
        .when(equal[0] & equal[1] & equal[2], UNCHANGED)
        .otherwise(CHANGED)
    )
    found = both.select(
        F.coalesce("_key_before", "_key_after").alias(key),
        change.alias("change"),
        *(F.coalesce(f"rows_{side}", F.lit(0).cast("long")).alias(f"rows_{side}") for side in ("before", "after")),
    )
    return found if with_unchanged else found.filter(F.col("change") != UNCHANGED)
