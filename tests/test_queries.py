"""Every query against DuckDB on the same tables."""

import re

import pytest

import __spark_entry__ as entry_points
from compare import database, differences
from tributary.operators import contracts
from tributary.plans import oracle, queries as catalogue


@pytest.fixture(scope="module")
def connection(folder):
    return database(folder)


def test_every_query_has_sql():
    assert catalogue.all_queries().keys() == oracle.all_statements().keys()
    assert catalogue.all_queries().keys() <= entry_points.queries().keys()


def test_entry(spark):
    result = entry_points.entry(spark)
    assert "total_revenue" in result.columns
    assert result.count() > 0


# One-task windows, all-pairs joins and Python row functions have no place in a plan.
UNWANTED = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"]


def one_task_windows(plan):
    """Windows that are not dealt out by a key right below."""
    lines = plan.splitlines()
    at = [i for i, line in enumerate(lines) if re.search(r"\bWindow\b", line)]
    return [lines[i] for i in at if "hashpartitioning" not in " ".join(lines[i + 1 : i + 4])]


@pytest.mark.parametrize("name", catalogue.all_queries())
def test_query(spark, folder, connection, name):
    result = entry_points.queries()[name](spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert [word for word in UNWANTED if word in plan] == []
    assert one_task_windows(plan) == []
    assert differences(result, connection, entry_points.oracle_sql()[name]) == []


def scans(result, column):
    """The columns read by each scan that reads this one."""
    plan = result._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    columns = [{re.sub(r"#\d+L?$", "", c) for c in text.split(",")} for text in found]
    return [c for c in columns if column in c]


def test_fact_reads_each_input_once_and_only_what_it_needs(spark, folder):
    fact = entry_points.queries()["fact_sales"](spark, folder)
    assert scans(fact, "l_orderkey") == [
        {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"}
    ]
    assert scans(fact, "o_orderkey") == [{"o_orderkey", "o_custkey", "o_orderdate"}]
    assert scans(fact, "customer_key") == [
        {"customer_key", "customer_id", "support_rep_id", "is_current"}
    ]


def test_aggregate_is_combined_before_each_shuffle(spark, folder):
    plan = entry_points.queries()["fact_sales_customer_agg"](spark, folder)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and "partial_count(distinct" in text
    # not in one plan with the invoice join, whose partitioning it would reuse
    assert "InvoiceId" not in text


def test_references_are_checked_in_one_scan_of_the_fact(spark, folder, monkeypatch):
    """By bitmaps: the scan for all references is over when the query is built, and no row needs another."""
    looked_at = []
    plain = contracts._keys
    monkeypatch.setattr(
        contracts, "_keys", lambda child, references, kind: looked_at.append(plain(child, references, kind)) or looked_at[-1]
    )
    result = entry_points.queries()["contract_fk"](spark, folder)
    (fact,) = [s for s in (scans(keys, "support_rep_key") for keys in looked_at) if s]
    assert fact == [{"customer_key", "track_key", "date_key", "support_rep_key"}]
    assert scans(result, "support_rep_key") == []
