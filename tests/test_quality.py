import datetime as dt
import json
import random

import pytest

from tributary.operators import quality
from tributary.operators.quality import MinValue, NotEmpty, NotNull, make_rule
from tributary.plans import settings

RUN_AT = dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def sample(spark):
    rows = [(1, "a", 5), (None, "b", 0), (3, "  ", None), (4, None, -1), (5, "\t", 1)]
    return spark.createDataFrame(rows, "id int, name string, amount int").cache()


def ids(df):
    return [r["id"] for r in df.collect()]


def test_single_rules(sample):
    assert ids(quality.failing(sample, NotNull("id"))) == [None]
    assert ids(quality.failing(sample, NotEmpty("name"))) == [3, 4]  # a tab is text
    assert ids(quality.failing(sample, MinValue("amount"))) == [3, 4]
    assert ids(quality.failing(sample, MinValue("amount", bound=1))) == [None, 3, 4]


def test_timestamp_rule(spark):
    df = spark.createDataFrame([("2024-01-02",), ("soon",), (None,)], "at string")
    failing = quality.failing(df, make_rule("at", "is_timestamp"))
    assert [r["at"] for r in failing.collect()] == ["soon"]


def test_tags_keep_rule_order(sample):
    rules = [MinValue("amount", bound=1), NotNull("id")]
    tags = {r["id"]: json.loads(r["_dq_errors"]) for r in quality.tag(sample, rules).collect()}
    assert tags[None] == ["amount:min_value", "id:not_null"]
    assert tags[1] == []


def test_split_is_complete(sample):
    valid, quarantine = quality.split(sample, [NotNull("id"), MinValue("amount", bound=1)])
    assert sorted(ids(valid)) == [1, 5]
    assert valid.columns == sample.columns
    assert valid.count() + quarantine.count() == sample.count()


@pytest.mark.parametrize("rules", [[], [NotNull("id", "warn"), NotEmpty("name", "warn")]])
def test_warnings_quarantine_nothing(sample, rules):
    valid, quarantine = quality.split(sample, rules)
    assert valid.count() == sample.count()
    assert quarantine.count() == 0
    assert quarantine.columns == [*sample.columns, "_dq_errors"]


def test_bad_rules_raise(sample):
    with pytest.raises(ValueError, match="looks_nice"):
        make_rule("id", "looks_nice")
    with pytest.raises(ValueError, match="fatal"):
        make_rule("id", "not_null", "fatal")
    with pytest.raises(ValueError, match="bound"):
        make_rule("id", "not_null", "error", 3)
    with pytest.raises(ValueError, match="missing:not_null"):
        quality.split(sample, [NotNull("missing")])


def test_quarantine_layout(sample):
    _, quarantine = quality.split(sample, [NotNull("id"), MinValue("amount", bound=1)])
    rows = quality.to_quarantine(quarantine, "things", RUN_AT).collect()
    assert {r["table_name"] for r in rows} == {"things"}
    assert {r["run_timestamp"] for r in rows} == {RUN_AT.astimezone().replace(tzinfo=None)}
    data = [json.loads(r["_row_data"]) for r in rows]
    assert {"name": "b", "amount": 0} in data  # NULL fields are left out


def test_log_line_and_rule_counts(sample):
    rules = [NotNull("id"), NotEmpty("name", "warn")]
    line = quality.summarize(sample, rules, "things", RUN_AT).first()
    assert (line["total_records"], line["passed_records"], line["failed_records"]) == (5, 4, 1)
    assert line["created_date"] == RUN_AT.date()
    counts = [tuple(r) for r in quality.rule_counts(sample, rules, "things").collect()]
    assert counts == [
        ("things", "id:not_null", "error", 1),
        ("things", "name:not_null_and_not_empty", "warn", 2),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_every_row_lands_on_one_side(spark, seed):
    pick = random.Random(seed).choice
    rows = [(n, pick([None, 1, 2]), pick([None, -1, 0, 3])) for n in range(200)]
    df = spark.createDataFrame(rows, "n int, id int, amount int")
    valid, quarantine = quality.split(df, [NotNull("id"), MinValue("amount")])
    both = valid.unionByName(quarantine.drop("_dq_errors"))
    assert sorted(r["n"] for r in both.collect()) == list(range(200))


def test_catalogue():
    tables = [name.lower() for name, _ in settings.registry_entries()]
    catalogue = [r for t in tables for r in settings.rules(t)]
    assert len(tables) == 11
    assert sum(r.level == "error" for r in catalogue) == 20
    assert sum(r.level == "warn" for r in catalogue) == 3
    assert settings.rules("unknown") == []


def test_quarantine_scan_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(100).selectExpr("id", "int(id) quantity").write.parquet(path)
    rules = [NotNull("id"), MinValue("quantity", bound=1)]
    _, quarantine = quality.split(spark.read.parquet(path), rules)
    plan = quarantine._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(IsNull(id),Or(IsNull(quantity),LessThan(quantity,1)))" in plan or (
        "PushedFilters: [Or(Or(IsNull(id),IsNull(quantity)),LessThan(quantity,1))" in plan
    )


def test_rules_from_dicts():
    entries = [
        {"col": "id", "check": "not_null", "criticality": "error"},
        {"col": "n", "check": "min_value", "min_val": 2, "criticality": "warn"},
        {"col": "n", "check": "min_value"},
    ]
    assert quality.make_rules(entries) == [
        NotNull("id"),
        MinValue("n", "warn", 2),
        MinValue("n", bound=0),
    ]


def test_route_matches_split(sample):
    rules = [NotNull("id"), MinValue("amount", bound=1)]
    valid, quarantine = quality.split(sample, rules)
    routed = quality.route(sample, rules)
    kept = routed.filter("not _failed").select(*sample.columns)
    assert kept.exceptAll(valid).count() == valid.exceptAll(kept).count() == 0
    failed = routed.filter("_failed").select("_error_details", "_row_data")
    expected = quality.to_quarantine(quarantine, "t", RUN_AT).select(*failed.columns)
    assert failed.exceptAll(expected).count() == expected.exceptAll(failed).count() == 0
    assert routed.filter("_failed and (id is not null or name is not null)").count() == 0
