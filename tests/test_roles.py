"""The roles over tables whose keys are larger than those of the given ones."""

import shutil

import pytest

import __spark_entry__ as entry_points
from compare import database, differences
from tributary.plans.roles import Roles

LINE = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double"
BEHIND = {"custkey": 1_000_000, "suppkey": 20_000, "partkey": 150_000, "orderkey": 10_000_000}
KEYS = {
    "customer": {"c_custkey"},
    "supplier": {"s_suppkey"},
    "part": {"p_partkey"},
    "orders": {"o_orderkey", "o_custkey"},
    "lineitem": {"l_orderkey", "l_partkey", "l_suppkey"},
}
# queries that read the lines
OVER_LINES = [
    "changes_patch_in",
    "conform_fact",
    "contract_fk",
    "contract_length",
    "contract_not_null",
    "contract_pk",
    "dense_key",
    "dq_min_value",
    "dq_rule_counts",
    "dq_run_summary",
    "dq_tag_errors",
    "dq_valid",
    "fact_sales",
    "fact_sales_as_of",
    "fact_sales_customer_agg",
    "fact_sales_customer_agg_refresh",
    "join_inner",
    "profile_schema",
    "quarantine_rows",
    "scan_snapshot",
]


def lines(spark, folder, *keys):
    rows = [(*k, 5.0, 1.25) for k in keys]
    spark.createDataFrame(rows, LINE).write.parquet(f"{folder}/lineitem.parquet")
    return Roles(spark, str(folder)).invoiceline()


def test_line_ids_of_large_keys(spark, tmp_path):
    keys = [(1, 7, 99_999, 9_999), (1, 2, 100_003, 12_345), (8_999_999, 7, 1_199_999, 59_999), (1_152_921_504, 3, 9_999, 9)]
    found = lines(spark, tmp_path, *keys).select("InvoiceLineId").collect()
    assert {r.InvoiceLineId for r in found} == {((o * 8 + n) * 100_000 + p) * 10_000 + s for o, n, p, s in keys}


def test_line_ids_of_missing_keys(spark, tmp_path):
    keys = [(None, 1, 1, 1), (1, None, 1, 1), (1, 1, None, 1), (1, 1, 1, None)]
    found = lines(spark, tmp_path, *keys).select("InvoiceLineId").collect()
    assert [r.InvoiceLineId for r in found] == [None] * 4


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_line_ids_without_room_raise(spark, tmp_path, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="keys too large for a line id"):
            lines(spark, tmp_path, (1_152_921_505, 1, 1, 1)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="module")
def large_keys(folder, tmp_path_factory):
    """The tables, and behind them their rows again under larger keys."""
    target = tmp_path_factory.mktemp("large_keys")
    given = database(folder)
    once = "qualify count(*) over (partition by l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1"
    for table, keys in KEYS.items():
        some = f"(from lineitem {once})" if table == "lineitem" else table  # no ties of line ids
        moved = ", ".join(f"{k} + {BEHIND[k[2:]]} as {k}" for k in keys)
        given.execute(
            f"copy (select * from {some} union all select * replace ({moved}) from {some}) "
            f"to '{target}/{table}.parquet' (format parquet)"
        )
    for table in ("nation", "region"):
        shutil.copy(f"{folder}/{table}.parquet", f"{target}/{table}.parquet")
    return str(target)


@pytest.mark.parametrize("name", OVER_LINES)
def test_query_over_large_keys(spark, large_keys, name):
    result = entry_points.queries()[name](spark, large_keys)
    assert differences(result, database(large_keys), entry_points.oracle_sql()[name]) == []
