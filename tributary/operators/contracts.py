"""Table contracts: types, required columns, keys, references, text lengths.

Spark does not enforce these on Parquet tables, so they are distributed checks
that return the violations as rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import any_of


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    max_lengths: dict[str, int] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns in contract order and type; a value that does not fit raises.

    The cast is the ANSI one whatever the session says: it raises on overflow
    where a legacy cast would store NULL. NULLs in required columns are left to
    ``not_null``, which reports them.
    """
    missing = [f.name for f in contract.schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{contract.name} lacks columns {missing}")
    columns = []
    for f in contract.schema:
        column = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            cast = column.try_cast(f.dataType)
            fits = column.isNull() | cast.isNotNull()
            message = F.concat(
                F.lit(f"{contract.name}.{f.name} cannot hold "), column.cast("string")
            )
            column = F.when(fits, cast).otherwise(F.raise_error(message).cast(f.dataType))
        columns.append(column.alias(f.name))
    return df.select(*columns)


Test = tuple[str, str, Column]  # column, check, and the number of rows that fail it


def _counts(df: DataFrame, contract: Contract, tests: Sequence[Test]) -> DataFrame:
    """Violations per test, all from one global aggregate."""
    if not tests:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, check string, violations bigint"
        )
    counted = df.agg(*[number.alias(f"v{i}") for i, (_, _, number) in enumerate(tests)])
    lines = [
        F.struct(
            F.lit(contract.name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(check).alias("check"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, (column, check, _) in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*lines)))


def _nulls(contract: Contract) -> list[Test]:
    return [(c, "not_null", F.count_if(F.col(c).isNull())) for c in contract.required]


def _too_long(contract: Contract) -> list[Test]:
    return [
        (c, "max_length", F.count_if(F.length(F.col(c)) > n))
        for c, n in contract.max_lengths.items()
    ]


def _misfits(df: DataFrame, contract: Contract) -> list[Test]:
    return [
        (f.name, "type", F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()))
        for f in contract.schema
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    ]


def not_null(df: DataFrame, contract: Contract) -> DataFrame:
    """NULLs per required column."""
    return _counts(df, contract, _nulls(contract))


def max_length(df: DataFrame, contract: Contract) -> DataFrame:
    """Values longer than declared, per text column."""
    return _counts(df, contract, _too_long(contract))


def fits(df: DataFrame, contract: Contract) -> DataFrame:
    """Values that the contract's type cannot hold, per column of another type."""
    return _counts(df, contract, _misfits(df, contract))


def values(df: DataFrame, contract: Contract) -> DataFrame:
    """NULLs, lengths and types, all from one scan."""
    tests = [*_nulls(contract), *_too_long(contract), *_misfits(df, contract)]
    return _counts(df, contract, tests)


BITMAP_KEYS = 1 << 25  # widest range of keys that is kept as bitmaps: 1,024 of them, 4 KB each
BITMAP_ROWS = 100_000  # of a table whose keys are looked for twice; fewer are soon counted
BITMAP_SPARSE = 64  # places in the range for each row that has a key


def _range(df: DataFrame, column: str, least_rows: int = 1) -> tuple[int, int] | None:
    """The least and greatest key if bitmaps over them are small and not almost empty."""
    if not isinstance(df.schema[column].dataType, T.IntegralType):
        return None
    key = F.col(column).cast("bigint")
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if n < least_rows or high - low >= min(BITMAP_KEYS, BITMAP_SPARSE * n):
        return None
    return low, high


def _bits(column: str) -> tuple[Column, Column]:
    """Which bitmap of 32,768 keys a key belongs to, and where."""
    return F.bitmap_bucket_number(column), F.bitmap_bit_position(column)


def _suspects(df: DataFrame, column: str) -> DataFrame | None:
    """The rows among which a key can repeat, by bitmaps; None if that takes more than it saves.

    A bitmap with fewer bits than rows has repetitions, and only its rows are counted by key.
    """
    if _range(df, column, BITMAP_ROWS) is None:
        return None
    bucket, bit = _bits("_key")
    keyed = df.withColumn("_key", F.col(column).cast("bigint"))
    maps = keyed.groupBy(bucket.alias("_bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(bit)).alias("_bits"), F.count(F.lit(1)).alias("_rows")
    )
    dirty = [r["_bucket"] for r in maps.filter("_bits < _rows").collect()]  # one row a bitmap
    return keyed.filter(_in(bucket, dirty)).drop("_key")


def _in(value: Column, found: Sequence[int | None]) -> Column:
    """Is the value among these, of which one may be NULL?"""
    known = F.coalesce(value.isin([v for v in found if v is not None]), F.lit(False))
    return known | value.isNull() if None in found else known


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts.

    Keys that are dense whole numbers are first marked in bitmaps, so that only
    rows near a repetition are moved by key.
    """
    suspects = _suspects(df, columns[0]) if len(columns) == 1 else None
    rows = df if suspects is None else suspects
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def primary_key(df: DataFrame, contract: Contract) -> DataFrame:
    return duplicates(df, contract.primary_key)


def key_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """The number of rows whose primary key repeats, as a line of the report."""
    number = F.coalesce(F.sum("rows"), F.lit(0))
    test = (contract.primary_key[0], "primary_key", number)
    return _counts(primary_key(df, contract), contract, [test])


def require_unique(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise, naming some of the repeated keys, unless ``columns`` identify a row."""
    repeated = duplicates(df, columns).limit(5).collect()
    if repeated:
        raise ValueError(f"rows repeat on {list(columns)}: {[tuple(r) for r in repeated]}")


def foreign_key(child: DataFrame, parent: DataFrame, reference: Reference) -> DataFrame:
    """Child keys without a parent row, with their row counts; NULL keys are allowed.

    Keys are counted before the join, so a hot key meets it as a single row.
    """
    keys = (
        child.filter(F.col(reference.column).isNotNull())
        .groupBy(F.col(reference.column).alias(reference.parent_column))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    orphans = keys.join(
        parent.select(reference.parent_column), reference.parent_column, "left_anti"
    )
    return orphans.select(F.col(reference.parent_column).alias("missing_key"), "rows")


def foreign_keys(
    child: DataFrame, contract: Contract, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """``column_name``, ``missing_key``, ``rows``: ``foreign_key`` for all references of a table.

    References to dense whole numbers go by bitmaps (``_near_orphans``), which move no keys unless
    some have no parent. For the others the child is scanned and shuffled once, whatever their
    number: the keys of all columns are counted together and meet those of all parents in
    one join. Keys are BIGINT, or text if a column of the references is no integer.
    """
    ranges = [_range(parents[r.parent], r.parent_column) for r in contract.references]
    whole = [isinstance(child.schema[r.column].dataType, T.IntegralType) for r in contract.references]
    marked = {r: b for r, b, w in zip(contract.references, ranges, whole) if b and w}
    rest = [r for r in contract.references if r not in marked]
    parts = []
    if marked:
        parts.append(_missing(_near_orphans(child, marked, parents), list(marked), parents, "bigint"))
    if rest:
        kinds = [child.schema[r.column].dataType for r in rest]
        kinds += [parents[r.parent].schema[r.parent_column].dataType for r in rest]
        kind = "bigint" if all(isinstance(k, T.IntegralType) for k in kinds) else "string"
        parts.append(_missing(_keys(child, rest, kind), rest, parents, kind))
    if len(parts) == 2 and parts[1].schema["missing_key"].dataType == T.StringType():
        parts[0] = parts[0].withColumn("missing_key", F.col("missing_key").cast("string"))
    return reduce(DataFrame.unionByName, parts)


def _keys(child: DataFrame, references: Sequence[Reference], kind: str) -> DataFrame:
    """``column_name``, ``missing_key``: the keys of all references, without NULLs."""
    keys = [
        F.struct(F.lit(r.column).alias("column_name"), F.col(r.column).cast(kind).alias("missing_key"))
        for r in references
    ]
    return child.select(F.inline(F.array(*keys))).filter("missing_key is not null")


def _missing(
    keys: DataFrame, references: Sequence[Reference], parents: Mapping[str, DataFrame], kind: str
) -> DataFrame:
    """Keys without a parent, counted before they meet the parents' keys."""
    counted = keys.groupBy("column_name", "missing_key").agg(F.count(F.lit(1)).alias("rows"))
    known = [
        parents[r.parent].select(
            F.lit(r.column).alias("column_name"),
            F.col(r.parent_column).cast(kind).alias("missing_key"),
        )
        for r in references
    ]
    return counted.join(
        reduce(DataFrame.unionByName, known), ["column_name", "missing_key"], "left_anti"
    )


def _near_orphans(
    child: DataFrame,
    ranges: Mapping[Reference, tuple[int, int]],
    parents: Mapping[str, DataFrame],
) -> DataFrame:
    """Keys that lie outside their parent's range, or share a bitmap with one that has no parent.

    Both sides are marked in bitmaps, and only those are moved. Where the child's bits add none to
    the parent's, no key of theirs is looked at again; if that is so for all, the child is
    read once.
    """
    bucket, bit = _bits("missing_key")
    inside = F.lit(False)
    for r, (low, high) in ranges.items():
        inside |= (F.col("column_name") == r.column) & F.col("missing_key").between(low, high)
    place = F.when(inside, bucket)  # NULL is outside
    keys = _keys(child, list(ranges), "bigint")
    bits = F.bitmap_construct_agg(F.when(inside, bit))
    mine = keys.groupBy("column_name", place.alias("_bucket")).agg(bits.alias("_mine"))
    nothing = F.lit(None).cast("binary")
    maps = mine.withColumn("_theirs", nothing)
    for r in ranges:
        own = parents[r.parent].select(F.col(r.parent_column).cast("bigint").alias("missing_key"))
        own = own.filter("missing_key is not null").groupBy(bucket.alias("_bucket"))
        theirs = own.agg(F.bitmap_construct_agg(bit).alias("_theirs"))
        maps = maps.unionByName(
            theirs.select(F.lit(r.column).alias("column_name"), "_bucket", nothing.alias("_mine"), "_theirs")
        )
    both = maps.groupBy("column_name", "_bucket").agg(
        F.bitmap_count(F.bitmap_or_agg(F.coalesce("_mine", "_theirs"))).alias("_both"),
        F.bitmap_count(F.bitmap_or_agg("_theirs")).alias("_known"),
    )
    dirty = defaultdict(list)
    for row in both.filter("_bucket is null or _both > _known").collect():  # one row a bitmap
        dirty[row["column_name"]].append(row["_bucket"])
    near = [(F.col("column_name") == c) & _in(place, found) for c, found in dirty.items()]
    return keys.filter(any_of(near))


def reference_counts(
    child: DataFrame, contract: Contract, parents: Mapping[str, DataFrame]
) -> DataFrame:
    """The number of rows without a parent, per reference, as lines of the report."""
    mine = lambda r: F.when(F.col("column_name") == r.column, F.col("rows"))
    tests = [
        (r.column, "foreign_key", F.coalesce(F.sum(mine(r)), F.lit(0)))
        for r in contract.references
    ]
    return _counts(foreign_keys(child, contract, parents), contract, tests)
