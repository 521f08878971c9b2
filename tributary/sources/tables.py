"""Catalog tables: ensure, read, append, replace.

Tables of plain files are replaced by writing the new image beside the old one
and pointing the table at it, so readers see either image, a failed write
changes nothing and a table can be rewritten from itself. Formats with their own
transaction log replace in place. A table can also consist of partitions that lie where
they were first written: then a new image holds only the partitions that change,
and the table that takes the old one's place points at the others as they are.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


LOGGED_FORMATS = {"delta"}  # overwritten in place, which their log makes atomic


NEXT = "__next"  # behind the name of a table that is about to take its place


@dataclass(frozen=True)
class Image:
    """The whole new content of a table: written, but not yet what the table shows."""

    df: DataFrame
    path: str
    rows: int


Values = tuple  # of the partition columns, as text; None for NULL


@dataclass(frozen=True)
class PartImage:
    """The whole new content of a table in partitions: some written now, some as they were."""

    df: DataFrame
    by: tuple[str, ...]
    parts: dict[Values, str]  # where each partition lies
    rows: int  # of those written now


@dataclass(frozen=True)
class Lake:
    """Where the tables of all layers live."""

    spark: SparkSession
    root: str
    table_format: str = "parquet"
    raw: str = "raw_zone"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    @property
    def plain_files(self) -> bool:
        return self.table_format not in LOGGED_FORMATS

    def location(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name.replace('.', '/')}"

    def ensure_schemas(self) -> None:
        for schema in (self.raw, self.bronze, self.silver, self.gold):
            self.spark.sql(
                f"create schema if not exists {schema} location '{self.location(schema)}'"
            )

    def exists(self, name: str) -> bool:
        """Is there such a table? One that a broken run left half swapped is put in place."""
        if self.spark.catalog.tableExists(name):
            return True
        if not self.spark.catalog.tableExists(name + NEXT):
            return False
        self.spark.sql(f"alter table {name}{NEXT} rename to {name}")
        return True

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def ensure(self, name: str, columns: str) -> None:
        """Create an empty table with these columns unless it exists."""
        self.spark.sql(
            f"create table if not exists {name} ({columns}) "
            f"using {self.table_format} location '{self.location(name)}/{uuid.uuid4().hex}'"
        )

    def append(self, df: DataFrame, name: str) -> None:
        df.write.format(self.table_format).mode("append").saveAsTable(name)

    def image(self, df: DataFrame, name: str) -> Image:
        """Write what will be the whole content and schema of a table."""
        seen = Observation()
        kind = self.table_format if self.plain_files else "parquet"
        path = f"{self.location(name)}/{uuid.uuid4().hex}"
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(kind).save(path)
        written = self.spark.read.format(kind).schema(df.schema).load(path)
        return Image(written, path, seen.get["rows"])

    def swap(self, image: Image, name: str) -> int:
        """Make an image what the table shows; returns its rows."""
        if self.plain_files:
            self._point(name, image.path, image.df.schema)
        else:
            image.df.write.format(self.table_format).mode("overwrite").option(
                "overwriteSchema", "true"
            ).saveAsTable(name)
        return image.rows

    def replace(self, df: DataFrame, name: str) -> int:
        """Make ``df`` the whole content and schema of a table; returns its rows."""
        return self.swap(self.image(df, name), name)

    def image_unflagged(
        self, df: DataFrame, name: str, flag: str, columns: list[str]
    ) -> tuple[Image, DataFrame | None]:
        """The image of the rows without the flag, in one pass over ``df``.

        Both kinds of rows are written, as partitions of the boolean flag; the
        image is one of them and has just the given columns. Also returns the
        other columns of the flagged rows, or None if there are no such rows.
        """
        path = f"{self.location(name)}/{uuid.uuid4().hex}"
        seen = Observation()
        flagged = F.col(flag)
        df = df.observe(
            seen,
            F.count_if(flagged).alias("flagged"),
            F.count_if(~flagged).alias("kept"),
        )
        df.write.format(self.table_format).partitionBy(flag).save(path)
        kept = T.StructType([df.schema[c] for c in columns])
        if not seen.get["kept"]:
            empty = self.spark.createDataFrame([], kept)
            empty.write.format(self.table_format).save(f"{path}/{flag}=false")
        read = self.spark.read.format(self.table_format)
        good = f"{path}/{flag}=false"
        image = Image(read.schema(kept).load(good), good, seen.get["kept"])
        if not seen.get["flagged"]:
            return image, None
        rest = T.StructType([f for f in df.schema if f.name not in (flag, *columns)])
        read = self.spark.read.format(self.table_format)
        return image, read.schema(rest).load(f"{path}/{flag}=true")

    def parts(self, name: str) -> dict[Values, str]:
        """Partition values and places of a table; none if it is not in partitions."""
        if not self.exists(name) or not self._partitioned_by(name):
            return {}
        found = {}
        for row in self.spark.sql(f"show partitions {name}").collect():  # catalog entries
            values = tuple(_value(v) for v in row["partition"].split("/"))
            spec = _spec(self._partitioned_by(name), values)
            told = self.spark.sql(f"describe table extended {name} partition ({spec})").collect()
            found[values] = next(r["data_type"] for r in told if r["col_name"] == "Location")
        return found

    def _partitioned_by(self, name: str) -> tuple[str, ...]:
        return tuple(c.name for c in self.spark.catalog.listColumns(name) if c.isPartition)

    def part_image(
        self, df: DataFrame, name: str, by: tuple[str, ...], kept: dict[Values, str] | None = None
    ) -> PartImage:
        """Write ``df`` as partitions; ``kept`` are partitions of the present table to go on as they are.

        A kept partition whose values occur in ``df`` as well is read and written together
        with them. ``by`` are the last columns of ``df``, so their order does not change.
        """
        if not self.plain_files:
            raise ValueError(f"tables of {self.table_format} keep their own partitions")
        if tuple(df.columns[-len(by) :]) != tuple(by):
            raise ValueError(f"{by} must be the last columns")
        kept = dict(kept or {})
        path = f"{self.location(name)}/{uuid.uuid4().hex}"
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.format(self.table_format).partitionBy(*by).save(path)
        written = self._folders(path, len(by))
        meeting = {v: place for v, place in kept.items() if v in written}
        data = T.StructType([f for f in df.schema if f.name not in by])
        for number, (values, place) in enumerate(meeting.items()):
            both = [self.spark.read.format(self.table_format).schema(data).load(p) for p in (place, written[values])]
            merged = f"{path}-{number}"
            both[0].unionByName(both[1]).write.format(self.table_format).save(merged)
            written[values] = merged
            del kept[values]
        frames = [
            self.spark.read.format(self.table_format).schema(data).load(place).select(
                *data.names, *(F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(by, values))
            )
            for values, place in written.items()
        ]
        if kept:
            gone = [
                reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v).cast(df.schema[c].dataType)) for c, v in zip(by, values)))
                for values in self.parts(name)
                if values not in kept
            ]
            stays = ~reduce(Column.__or__, gone) if gone else F.lit(True)
            frames.append(self.read(name).filter(stays).select(*df.columns))
        whole = reduce(DataFrame.unionByName, frames) if frames else df.limit(0)
        parts = kept | written
        return PartImage(whole, tuple(by), parts, seen.get["rows"])

    def swap_parts(self, image: PartImage, name: str) -> int:
        """Make the partitions what the table shows; at any moment one table is whole (see ``exists``)."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in image.df.schema)
        self.spark.sql(f"drop table if exists {name}{NEXT}")  # external: files stay
        self.spark.sql(
            f"create table {name}{NEXT} ({columns}) using {self.table_format} partitioned by "
            f"({', '.join(f'`{c}`' for c in image.by)}) location '{self.location(name)}/{uuid.uuid4().hex}'"
        )
        if image.parts:
            added = " ".join(
                f"partition ({_spec(image.by, values)}) location '{place}'" for values, place in image.parts.items()
            )
            self.spark.sql(f"alter table {name}{NEXT} add {added}")
        self.spark.sql(f"drop table if exists {name}")
        self.spark.sql(f"alter table {name}{NEXT} rename to {name}")
        self.spark.catalog.refreshTable(name)
        return image.rows

    def _folders(self, path: str, depth: int) -> dict[Values, str]:
        """The partition folders that a write has left, by their values."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(path)
        files = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        pattern = jvm.org.apache.hadoop.fs.Path(path + "/*=*" * depth)
        found = {}
        for status in files.globStatus(pattern) or []:
            place = status.getPath().toString()
            found[tuple(_value(v) for v in place.split("/")[-depth:])] = place
        return found

    def _point(self, name: str, path: str, schema: T.StructType) -> None:
        if self.exists(name) and _shape(self.read(name).schema) == _shape(schema):
            self.spark.sql(f"alter table {name} set location '{path}'")
        else:
            # at any moment one of the two names stands for a whole image (see ``exists``)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"drop table if exists {name}{NEXT}")  # external: files stay
            self.spark.sql(
                f"create table {name}{NEXT} ({columns}) using {self.table_format} "
                f"location '{path}'"
            )
            self.spark.sql(f"drop table if exists {name}")
            self.spark.sql(f"alter table {name}{NEXT} rename to {name}")
        self.spark.catalog.refreshTable(name)


def _value(folder: str) -> str | None:
    """The value in a folder name such as ``day=2024-01-01``."""
    value = unquote(folder.split("=", 1)[1])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def _spec(by: tuple[str, ...], values: Values) -> str:
    quoted = [
        "null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values
    ]
    return ", ".join(f"`{c}` = {v}" for c, v in zip(by, quoted))


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]
