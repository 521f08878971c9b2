"""Keyed changes to a table: insert rows, patch columns by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import require_unique
from .keys import continue_key


def insert_rows(
    table: DataFrame, rows: DataFrame, identity: str, order_by: str | list[str]
) -> DataFrame:
    """Append rows that come without an id; ids continue after the highest one.

    Columns the rows lack are NULL. ``order_by`` fixes which row gets which id.
    """
    unknown = set(rows.columns) - set(table.columns)
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    id_type = table.schema[identity].dataType
    numbered = continue_key(rows, table, identity, order_by)
    numbered = numbered.withColumn(identity, F.col(identity).cast(id_type))
    return table.unionByName(numbered, allowMissingColumns=True)


def patch(
    table: DataFrame,
    changes: DataFrame,
    key: str,
    columns: Sequence[str],
    check_unique: bool = True,
) -> DataFrame:
    """Overwrite columns of the rows whose key occurs in ``changes``.

    A boolean ``set_<column>`` in ``changes`` says whether that column is
    assigned, so that NULL can be; without one every matching row is assigned.
    """
    if check_unique:
        require_unique(changes, [key])
    flags = {c: f"set_{c}" for c in columns if f"set_{c}" in changes.columns}
    side = changes.select(
        F.col(key).alias("_key"),
        *[F.col(c).alias(f"_new_{c}") for c in columns],
        *[F.col(flag).alias(f"_set_{c}") for c, flag in flags.items()],
    )
    matched = F.col("_key").isNotNull()

    def value(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        assigned = matched & F.col(f"_set_{name}") if name in flags else matched
        return F.when(assigned, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    joined = table.join(side, F.col(key) == F.col("_key"), "left")
    return joined.select(*[value(c) for c in table.columns])


def patch_in(
    table: DataFrame, keys: DataFrame, key: str, values: Mapping[str, object]
) -> DataFrame:
    """Set columns to constants on the rows whose key is in ``keys``."""
    types = {c: table.schema[c].dataType for c in values}
    changes = keys.select(key).distinct()
    changes = changes.withColumns({c: F.lit(v).cast(types[c]) for c, v in values.items()})
    return patch(table, changes, key, list(values), check_unique=False)
