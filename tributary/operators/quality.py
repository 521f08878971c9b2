"""Declarative quality rules: tag, split, quarantine, count."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_of, named, row_json

ERROR, WARN = "error", "warn"
ERRORS = "_dq_errors"
FAILED, DETAILS, DATA = "_failed", "_error_details", "_row_data"


@dataclass(frozen=True)
class Rule:
    """A check on one column. Errors quarantine the row, warnings are counted."""

    column: str
    level: str = ERROR
    check = ""

    def fails(self) -> Column:
        raise NotImplementedError

    @property
    def label(self) -> str:
        return f"{self.column}:{self.check}"


@dataclass(frozen=True)
class NotNull(Rule):
    check = "not_null"

    def fails(self) -> Column:
        return named(self.column).isNull()


@dataclass(frozen=True)
class NotEmpty(Rule):
    """Fails on NULL and on text of nothing but spaces."""

    check = "not_null_and_not_empty"

    def fails(self) -> Column:
        return named(self.column).isNull() | (F.trim(named(self.column)) == "")


@dataclass(frozen=True)
class MinValue(Rule):
    """Fails on NULL and below the bound."""

    bound: float = 0
    check = "min_value"

    def fails(self) -> Column:
        return named(self.column).isNull() | (named(self.column) < F.lit(self.bound))


@dataclass(frozen=True)
class IsTimestamp(Rule):
    """Fails on text that is no timestamp, which strict parsing would raise for later."""

    check = "is_timestamp"

    def fails(self) -> Column:
        text = named(self.column)
        return text.isNotNull() & F.try_to_timestamp(text).isNull()


CHECKS = {rule.check: rule for rule in (NotNull, NotEmpty, MinValue, IsTimestamp)}


def make_rule(column: str, check: str, level: str = ERROR, bound: float | None = None) -> Rule:
    if check not in CHECKS:
        raise ValueError(f"unknown check {check!r} on column {column!r}")
    if level not in (ERROR, WARN):
        raise ValueError(f"unknown level {level!r} on {column}:{check}")
    if bound is not None:
        if check != MinValue.check:
            raise ValueError(f"{column}:{check} takes no bound")
        return MinValue(column, level, bound)
    return CHECKS[check](column, level)


def make_rules(entries: Iterable[Mapping]) -> list[Rule]:
    """Rules from dicts with ``col``, ``check``, ``criticality`` and maybe ``min_val``."""
    return [
        make_rule(e["col"], e["check"], e.get("criticality", ERROR), e.get("min_val"))
        for e in entries
    ]


def check_columns(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raise for rules on columns the frame lacks, naming them."""
    missing = [r.label for r in rules if r.column not in df.columns]
    if missing:
        raise ValueError(f"rules on missing columns: {missing}")


def errors(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.level == ERROR]


def failing(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows that break one rule."""
    check_columns(df, [rule])
    return df.filter(rule.fails())


def failed(rules: Sequence[Rule]) -> Column:
    """Does the row break an error rule? Never NULL."""
    return any_of(r.fails() for r in errors(rules))


def _broken(rules: Sequence[Rule]) -> Column:
    """The JSON array of the broken error rules, in rule order."""
    labels = [F.when(r.fails(), F.lit(r.label)) for r in errors(rules)]
    return F.to_json(F.array_compact(F.array(*labels))) if labels else F.lit("[]")


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the JSON array of the broken error rules."""
    check_columns(df, rules)
    return df.withColumn(ERRORS, _broken(rules))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)``; only quarantined rows carry their errors.

    Both sides filter on the plain conditions rather than on the tag, so the
    quarantine side skips Parquet row groups whose statistics rule out a failure.
    """
    check_columns(df, rules)
    bad = failed(rules)
    return df.filter(~bad), tag(df.filter(bad), rules)


def route(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Both sides of a split in one frame, to be written from a single scan.

    ``_failed`` tells the sides apart. Failing rows carry their errors and
    themselves as JSON; their data columns are NULL, as later steps are only
    meant for rows that passed.
    """
    check_columns(df, rules)
    bad = failed(rules)
    data = [c for c in df.columns if not c.startswith("_")]
    return df.select(
        *[F.when(~bad, named(c)).alias(c) for c in df.columns],
        F.when(bad, _broken(rules)).alias(DETAILS),
        F.when(bad, row_json(data)).alias(DATA),
        bad.alias(FAILED),
    )


def to_quarantine(quarantine: DataFrame, table: str, run_at: dt.datetime) -> DataFrame:
    """Quarantined rows in the common layout; the row itself becomes JSON."""
    data = [c for c in quarantine.columns if not c.startswith("_")]
    return quarantine.select(
        F.lit(table).alias("table_name"),
        F.lit(run_at).cast("timestamp").alias("run_timestamp"),
        F.col(ERRORS).alias(DETAILS),
        row_json(data).alias(DATA),
    )


def run_metrics(rules: Sequence[Rule]) -> list[Column]:
    """Total, passed and failed rows as aggregates, for ``agg`` or ``observe``."""
    bad = failed(rules)
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(~bad).alias("passed_records"),
        F.count_if(bad).alias("failed_records"),
    ]


def summarize(
    df: DataFrame, rules: Sequence[Rule], table: str, run_at: dt.datetime
) -> DataFrame:
    """The quality log line of a table, from one pass."""
    check_columns(df, rules)
    return df.agg(*run_metrics(rules)).select(
        F.lit(table).alias("table_name"),
        F.lit(run_at).cast("timestamp").alias("run_timestamp"),
        "total_records",
        "passed_records",
        "failed_records",
        F.lit(run_at.date()).alias("created_date"),
    )


def rule_metrics(rules: Sequence[Rule]) -> list[Column]:
    return [F.count_if(r.fails()).alias(f"rule_{i}") for i, r in enumerate(rules)]


def rule_counts(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Failing rows per rule, warnings included, from one pass."""
    check_columns(df, rules)
    if not rules:
        raise ValueError(f"no rules for {table}")
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(r.label).alias("rule"),
            F.lit(r.level).alias("level"),
            F.col(f"rule_{i}").alias("failed_records"),
        )
        for i, r in enumerate(rules)
    ]
    return df.agg(*rule_metrics(rules)).select(F.inline(F.array(*lines)))
