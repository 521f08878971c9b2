"""Source tables, read through a Spark catalog or over JDBC."""

from __future__ import annotations

import math
from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Source(Protocol):
    def read(self, spark: SparkSession, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class CatalogSource:
    """Tables of a catalog schema, e.g. a federated ``catalog.schema``."""

    schema: str

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.table(f"{self.schema}.{table}" if self.schema else table)


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database.

    A table named in ``split_on`` is read in even ranges of that integer column, each of
    ``range_per_task`` values, so that the number of tasks follows the table; one in
    ``predicates`` by a task for each of the conditions, which must cut it into disjoint parts
    that cover it. Tables in ``whole`` are read by a single task. Any other table raises:
    how it is to be read is for the user to say.
    """

    url: str
    schema: str
    properties: Mapping[str, str] = field(default_factory=dict)
    split_on: Mapping[str, str] = field(default_factory=dict)
    predicates: Mapping[str, Sequence[str]] = field(default_factory=dict)
    whole: Collection[str] = ()
    range_per_task: int = 1_000_000
    fetch_size: int = 10_000

    def options(self, table: str, bounds: tuple[int, int] | None = None) -> dict[str, str]:
        options = {
            **self.properties,
            "url": self.url,
            "dbtable": f"{self.schema}.{table}",
            "fetchsize": str(self.fetch_size),
        }
        if bounds:
            options |= {
                "partitionColumn": self.split_on[table],
                "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1] + 1),
                "numPartitions": str(math.ceil((bounds[1] - bounds[0] + 1) / self.range_per_task)),
            }
        return options

    def bounds_query(self, table: str) -> str:
        column = self.split_on[table]
        return f"select min({column}) as lo, max({column}) as hi from {self.schema}.{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        bounds = None
        if table in self.predicates:
            options = self.options(table)
            name, url = options.pop("dbtable"), options.pop("url")
            parts = list(self.predicates[table])
            return spark.read.jdbc(url, name, predicates=parts, properties=options)
        if table not in self.split_on and table not in self.whole:
            raise ValueError(f"{table} needs a split column or predicates, or to be read whole")
        if table in self.split_on:
            options = self.options(table)
            options["query"] = self.bounds_query(table)
            del options["dbtable"]
            low, high = spark.read.format("jdbc").options(**options).load().first()
            if low is not None:
                bounds = (int(low), int(high))
        return spark.read.format("jdbc").options(**self.options(table, bounds)).load()


def check_ready(spark: SparkSession, source: Source, tables: Iterable[str]) -> list[str]:
    """Ask every table for one row; raises naming all tables that do not answer."""
    tables = list(tables)
    if not tables:
        raise RuntimeError("no active tables in the registry")
    failed = {}
    for table in tables:
        try:
            source.read(spark, table).limit(1).count()
        except Exception as error:  # any cause means the table is not ready
            failed[table] = str(error).splitlines()[0]
    if failed:
        raise RuntimeError(f"source tables not ready: {failed}")
    return tables
