"""The run from source to star schema, as four steps called in order.

Tables of one step do not depend on each other and are worked on from a few
driver threads, so that small tables do not wait for the cluster one by one.
Only counts and table names come back to the driver.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import cleaning, contracts, dimensions, facts, profiling, quality, scd2
from ..session import qualified
from ..sources import registry, relational, runlog, snapshots
from ..sources.tables import Image, Lake, PartImage
from . import settings

# The bookkeeping tables.
REGISTRY_TABLE = "pipeline_metadata_parent"
RUN_TABLE = "pipeline_metadata_child"
QUALITY_TABLE = "dqx_execution_log"
QUARANTINE_TABLE = "quarantine"

QUALITY_COLUMNS = (
    "table_name string, run_timestamp timestamp, total_records bigint, "
    "passed_records bigint, failed_records bigint, created_date date, status string"
)

RULE_TABLE = "quality_rule_log"  # a log of this package's own
RULE_COLUMNS = (
    "table_name string, run_timestamp timestamp, rule string, level string, "
    "failed_records bigint"
)
QUARANTINE_COLUMNS = (
    "table_name string, run_timestamp timestamp, _error_details string, _row_data string"
)

log = logging.getLogger(__name__)
Item, Result = TypeVar("Item"), TypeVar("Result")


@dataclass(frozen=True)
class Report:
    """What a quality run found in one table."""

    table: str
    status: str
    total: int = 0
    passed: int = 0
    failed: int = 0
    nulls: dict[str, int] = field(default_factory=dict)
    rules: list[tuple[str, str, int]] = field(default_factory=list)
    duplicates: int | None = None
    schema: list[tuple[str, str]] = field(default_factory=list)


class TablesFailed(RuntimeError):
    """Some tables of a step failed; the others are done and logged."""


def _each(work: Callable[[Item], Result], items: Iterable[Item], threads: int) -> list[Result]:
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(work, items))


def setup(
    lake: Lake, day: dt.date, tables: Iterable[tuple[str, str]] | None = None
) -> None:
    """Create schemas and bookkeeping tables and seed the registry; safe to repeat.

    ``tables`` are pairs of a source table and its file name.
    """
    if tables is None:
        tables = settings.registry_entries()
    lake.ensure_schemas()
    lake.ensure(f"{lake.raw}.{REGISTRY_TABLE}", registry.SCHEMA)
    lake.ensure(f"{lake.raw}.{RUN_TABLE}", runlog.SCHEMA)
    lake.ensure(f"{lake.silver}.{QUALITY_TABLE}", QUALITY_COLUMNS)
    lake.ensure(f"{lake.silver}.{RULE_TABLE}", RULE_COLUMNS)
    lake.ensure(f"{lake.silver}.{QUARANTINE_TABLE}", QUARANTINE_COLUMNS)
    seed = registry.entries(lake.spark, tables, day)
    known = lake.read(f"{lake.raw}.{REGISTRY_TABLE}")
    lake.append(registry.missing(seed, known), f"{lake.raw}.{REGISTRY_TABLE}")


def active_tables(lake: Lake) -> list[str]:
    """Names from the registry, which has one row per source table."""
    active = registry.active(lake.read(f"{lake.raw}.{REGISTRY_TABLE}"))
    return sorted(row["table_name"] for row in active.collect())


def check_sources(lake: Lake, source: relational.Source) -> list[str]:
    """Raise unless every active source table answers."""
    return relational.check_ready(lake.spark, source, active_tables(lake))


def load_raw(
    lake: Lake,
    source: relational.Source,
    base: str,
    run_at: dt.datetime,
    threads: int = 4,
    content: bool = False,
) -> list[runlog.Run]:
    """Snapshot every active table and log each run; raises at the end if any failed.

    Counts are compared with the written files; with ``content`` every value is.
    """

    def load(table: str) -> runlog.Run:
        path, status, counts = "", runlog.FAILED, (0, 0)
        try:
            df = source.read(lake.spark, table)
            path = snapshots.location(base, table, run_at)
            if content:
                counts = (snapshots.reconcile_content(df, path).rows,) * 2
            else:
                counts = snapshots.reconcile(df, path)
            status = runlog.SUCCESS
        except snapshots.CountMismatch as error:
            log.error("snapshot of %s: %s", table, error)
            counts = (error.source_rows, error.target_rows)
        except snapshots.ContentMismatch as error:
            log.error("snapshot of %s: %s", table, error)
            counts = (error.source.rows, error.target.rows)
        except Exception:  # one bad table must not stop the others
            log.exception("snapshot of %s failed", table)
        return runlog.Run(table, run_at, status, *counts, path, run_at.date())

    runs = _each(load, active_tables(lake), threads)
    lake.append(runlog.to_frame(lake.spark, runs), f"{lake.raw}.{RUN_TABLE}")
    runlog.raise_on_failure(runs)
    return runs


def promote(lake: Lake, active_only: bool = True, threads: int = 4) -> dict[str, int]:
    """Replace each Bronze table by its newest good snapshot; returns row counts.

    Snapshots are immutable Parquet files, so a table of such files points at them
    and nothing is copied; for other formats the rows are written again.
    """
    active = registry.active(lake.read(f"{lake.raw}.{REGISTRY_TABLE}")) if active_only else None
    newest = runlog.latest_success(lake.read(f"{lake.raw}.{RUN_TABLE}"), active).collect()

    def copy(row) -> tuple[str, int]:
        table = row["table_name"].lower()
        df = snapshots.read(lake.spark, row["file_location"])
        name = f"{lake.bronze}.{table}"
        if lake.table_format != snapshots.FORMAT:
            return table, lake.replace(df, name)
        return table, lake.swap(Image(df, qualified(lake.spark, row["file_location"]), df.count()), name)

    return dict(_each(copy, newest, threads))


def refine(
    lake: Lake,
    run_at: dt.datetime,
    count_duplicates: bool = True,
    threads: int = 4,
    rules: Callable[[str], Sequence[quality.Rule]] = settings.rules,
    steps: Mapping[str, Sequence[cleaning.Step]] = settings.CLEANING,
) -> list[Report]:
    """Profile, validate and clean every Bronze table into Silver.

    ``rules`` and ``steps`` give the quality rules and the cleaning of a table by
    its lower-case name. Each new Silver image is written first; then the failing
    rows of all tables go to the quarantine, in one append, as concurrent ones to a Parquet
    table would get in each other's way; then the logs are written; and only then
    the images are swapped in. So a failing rule or table loses no row: its Silver table
    stays, it is logged as FAILED, and it is named in the error raised at the end. Quarantine and logs
    take the rows of a table and run stamp once, so a run cut off by a crash can be repeated.
    """

    def work(table: str) -> tuple[Report, DataFrame | None, Image | None]:
        name = table.lower()
        try:
            return _refine_table(lake, name, rules(name), steps.get(name, ()), count_duplicates)
        except Exception as error:  # one bad table must not stop the others
            log.exception("table %s failed", name)
            errors[name] = error
            return Report(name, "FAILED"), None, None

    errors: dict[str, Exception] = {}
    results = _each(work, active_tables(lake), threads)
    failed = [
        rows.select(
            F.lit(report.table).alias("table_name"),
            F.lit(run_at).cast("timestamp").alias("run_timestamp"),
            quality.DETAILS,
            quality.DATA,
        )
        for report, rows, _ in results
        if rows is not None
    ]
    if failed:
        _append_once(lake, reduce(DataFrame.unionByName, failed), QUARANTINE_TABLE, run_at)

    reports, day = [report for report, *_ in results], run_at.date()
    quality_rows = [
        (r.table, run_at, r.total, r.passed, r.failed, day, r.status) for r in reports
    ]
    rule_rows = [(r.table, run_at, *counted) for r in reports for counted in r.rules]
    spark = lake.spark
    quality_log = spark.createDataFrame(quality_rows, QUALITY_COLUMNS)
    _append_once(lake, quality_log, QUALITY_TABLE, run_at, "status")
    rule_log = spark.createDataFrame(rule_rows, RULE_COLUMNS)
    _append_once(lake, rule_log, RULE_TABLE, run_at, "rule")
    for report, _, image in results:
        if image is not None:
            lake.swap(image, f"{lake.silver}.{report.table}")
    if errors:
        reasons = "; ".join(f"{name}: {error}" for name, error in sorted(errors.items()))
        raise TablesFailed(f"not refined: {reasons}")
    return reports


def _append_once(lake: Lake, rows: DataFrame, table: str, run_at: dt.datetime, *keys: str) -> None:
    """Append to a log what it does not hold of this run yet, table by table.

    A run that is repeated with its stamp after a crash adds only what was not written.
    """
    name = f"{lake.silver}.{table}"
    stamped = lake.read(name).filter(F.col("run_timestamp") == F.lit(run_at).cast("timestamp"))
    known = stamped.select("table_name", *keys).distinct().collect()  # a few rows for each table
    if known:
        held = lake.spark.createDataFrame(known, rows.select("table_name", *keys).schema)
        rows = rows.join(held, ["table_name", *keys], "left_anti").select(*rows.columns)
    lake.append(rows, name)


def _refine_table(
    lake: Lake,
    table: str,
    rules: Sequence[quality.Rule],
    steps: Sequence[cleaning.Step],
    count_duplicates: bool,
) -> tuple[Report, DataFrame | None, Image | None]:
    """Write one Silver image; returns what was found, the failing rows, if any, and the image.

    One scan does it all: profile, quality and rule counts are observed on the
    way, and valid and failing rows are written side by side. Only the duplicate
    count takes a scan of its own.
    """
    if not lake.exists(f"{lake.bronze}.{table}"):
        return Report(table, "MISSING"), None, None
    df = lake.read(f"{lake.bronze}.{table}")
    quality.check_columns(df, rules)
    seen = Observation()
    metrics = (
        *profiling.null_metrics(df),
        *quality.run_metrics(rules),
        *quality.rule_metrics(rules),
    )
    routed = quality.route(df.observe(seen, *metrics), rules)
    if lake.plain_files:
        cleaned = cleaning.clean(routed, steps)
        image, failed = lake.image_unflagged(
            cleaned, f"{lake.silver}.{table}", quality.FAILED, df.columns
        )
    else:
        valid = routed.filter(~F.col(quality.FAILED)).select(*df.columns)
        image = lake.image(cleaning.clean(valid, steps), f"{lake.silver}.{table}")
        failed = quality.route(df.filter(quality.failed(rules)), rules)
    counts = seen.get
    duplicates = None
    if count_duplicates:
        duplicates = profiling.duplicate_count(df).first()["duplicate_rows"]
    report = Report(
        table,
        "DONE",
        counts["total_records"],
        counts["passed_records"],
        counts["failed_records"],
        {c: counts[f"null_{i}"] for i, c in enumerate(df.columns) if counts[f"null_{i}"]},
        [(r.label, r.level, counts[f"rule_{i}"]) for i, r in enumerate(rules)],
        duplicates,
        df.dtypes,
    )
    return report, failed if report.failed else None, image


def publish(
    lake: Lake, run_date: dt.date, threads: int = 4, conform: bool = False
) -> dict[str, int]:
    """Build the Gold tables from Silver; returns row counts.

    Every table is written whole as an image, and the images are swapped in when all
    are there, so a failure leaves all Gold tables as they were. The versions of customers lie in
    partitions by end date: closed ones stay where they were written, and a merge
    writes current and newly closed rows alone. Known ids keep the keys
    they have in the present dimensions. The fact books on
    the current customer versions; its aggregate reads the written fact. The types
    are those that Spark derives, which are wide enough for any total; ``violations``
    counts what does not fit its contract. With ``conform`` the types are those of the
    contract, and a value beyond its type stops the run.
    """
    known = settings.contracts()

    def silver(name: str) -> DataFrame:
        return lake.read(f"{lake.silver}.{name}")

    images: dict[str, Image | PartImage] = {}

    def gold(name: str) -> DataFrame:
        return images[name].df

    def put(name: str, df: DataFrame) -> None:
        if conform:
            df = contracts.conform(df, known[name])
        images[name] = lake.image(df, f"{lake.gold}.{name}")

    def dimension(d: settings.Dimension) -> None:
        name = f"{lake.gold}.{d.name}"
        present = lake.read(name) if lake.exists(name) else None
        put(d.name, dimensions.build(silver(d.source), d.mapping, d.natural_key, d.key, present))

    def dates(_) -> None:
        put("dim_date", dimensions.date_dimension(silver("invoice"), "InvoiceDate"))

    def customers(d: settings.Dimension) -> None:
        spec = settings.customer_versions()
        incoming = dimensions.project(silver(d.source), d.mapping)
        name, parts = f"{lake.gold}.{d.name}", {}
        if not lake.exists(name):
            rows = scd2.initial(incoming, spec, run_date)
        else:
            present = lake.read(name)
            parts = lake.parts(name)
            merge = scd2.touched if parts else scd2.apply
            rows = merge(present, incoming, spec, run_date)
        if conform:
            rows = contracts.conform(rows, known[d.name])
        if not lake.plain_files:
            images[d.name] = lake.image(rows, name)
            return
        if parts and rows.dtypes != present.dtypes:  # other types: nothing can stay where it is
            whole = scd2.apply(present, incoming, spec, run_date)
            rows, parts = contracts.conform(whole, known[d.name]) if conform else whole, {}
        past = {values: place for values, place in parts.items() if values[1] != "true"}
        images[d.name] = lake.part_image(rows, name, (scd2.END, scd2.CURRENT), past)

    work = [(dates, None)] + [
        (customers if name == "dim_customer" else dimension, d)
        for name, d in settings.dimensions().items()
    ]
    _each(lambda job: job[0](job[1]), work, threads)
    current = scd2.current(gold("dim_customer"))
    fact = facts.sales(
        silver("invoiceline"),
        silver("invoice"),
        current,
        gold("dim_track"),
        gold("dim_date"),
        gold("dim_employee"),
    )
    put("fact_sales", fact)
    by_customer = facts.sales_by_customer(gold("fact_sales"), current)
    put("fact_sales_customer_agg", by_customer)
    return {name: _swap(lake, image, f"{lake.gold}.{name}") for name, image in images.items()}


def _swap(lake: Lake, image: Image | PartImage, name: str) -> int:
    """Show an image; returns the rows of the whole table."""
    if isinstance(image, PartImage):
        lake.swap_parts(image, name)
        return lake.read(name).count()  # from the footers of the files
    return lake.swap(image, name)


def violations(lake: Lake) -> DataFrame:
    """How often the Gold tables break their contracts, per table, column and check."""
    parts = []
    for name, contract in settings.contracts().items():
        df = lake.read(f"{lake.gold}.{name}")
        parts.append(contracts.values(df, contract))
        parts.append(contracts.key_counts(df, contract))
        if contract.references:
            parents = {r.parent: lake.read(f"{lake.gold}.{r.parent}") for r in contract.references}
            parts.append(contracts.reference_counts(df, contract, parents))
    return reduce(DataFrame.unionByName, parts)


def run(
    lake: Lake,
    source: relational.Source,
    base: str,
    run_at: dt.datetime,
    threads: int = 4,
    conform: bool = False,
) -> dict[str, int]:
    """All steps in order; a failing step stops the run."""
    setup(lake, run_at.date())
    check_sources(lake, source)
    load_raw(lake, source, base, run_at, threads)
    promote(lake, threads=threads)
    refine(lake, run_at, threads=threads)
    return publish(lake, run_at.date(), threads, conform)
