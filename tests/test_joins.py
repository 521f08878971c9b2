"""Joins with heavy keys, and aggregates that are brought up to date."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tributary.operators import facts, joins


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def sides(spark, n=3000):
    """A third of the rows on one key, some on NULL, others spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 700)
    left = spark.range(n).select(key.cast("int").alias("k"), "id")
    right = spark.range(600).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("r"), "id").alias("name"))
    return left, right.unionByName(right.filter("k = 7").withColumn("name", F.lit("second")))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [100_000, 1])
def test_same_as_the_plain_join(spark, how, limit):
    left, right = sides(spark)
    assert 7 in joins.heavy_keys(left, "k")
    found = joins.split_join(left, right, "k", how, right_rows=limit)
    assert rows(found) == rows(left.join(right, "k", how))
    assert found.columns == ["k", "id", "name"]


def test_without_heavy_keys_or_rows(spark):
    left, right = sides(spark)
    even = left.filter("k <> 7")
    assert joins.heavy_keys(even, "k", share=0.2) == []
    assert rows(joins.split_join(even, right, "k", share=0.2)) == rows(even.join(right, "k"))
    for a, b in ((left.limit(0), right), (left, right.limit(0)), (left.filter("k is null"), right)):
        assert rows(joins.split_join(a, b, "k", "left")) == rows(a.join(b, "k", "left"))
    with pytest.raises(ValueError):
        joins.split_join(left, right, "k", "full")


def test_aggregate_behind_it_is_not_one_task(spark):
    """Behind a plain join the hot key is one task of the aggregate; here all tasks combine it first."""
    left, right = sides(spark, 60_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.split_join(left.repartition(6), right, "k")
        heavy = joined.filter("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(heavy) == 6
        assert max(r["count"] for r in heavy) <= 3 * sorted(r["count"] for r in heavy)[3]
        plain = left.join(right, "k").filter("k = 7").groupBy(F.spark_partition_id().alias("p")).count()
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert plain.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


FACT = "customer_key long, invoice_id int, quantity int, line_total decimal(21,2), date_key int"


def customers(spark):
    made = [(k, k * 10, f"f{k}", "l", "c", None) for k in range(1, 6)]
    return spark.createDataFrame(
        made, "customer_key long, customer_id int, first_name string, last_name string, country string, email string"
    )


def fact(spark, lines):
    return spark.createDataFrame([(k, i, q, t and Decimal(t), d) for k, i, q, t, d in lines], FACT)


DAY_1 = [(1, 1, 2, "1.00", 20240101), (1, 2, 1, "0.05", 20240102), (2, 3, 1, "-0.10", 20240103), (4, 9, 1, None, None),
         (None, 4, 1, "3.00", 20240101)]
DAY_2 = [(1, 1, 1, "0.06", 20240101), (1, 5, 1, "7.77", 20240105), (3, 6, None, "1.01", 20240103), (2, 3, 1, "-0.01", None),
         (2, 7, 1, "-0.02", 20240101), (None, 4, 2, "1.00", 20240107)]


def test_refresh_is_the_full_rebuild(spark):
    first, news, known = fact(spark, DAY_1), fact(spark, DAY_2), customers(spark)
    state = facts.customer_state(first)
    totals = facts.totals_of(state, known)
    assert rows(totals) == rows(facts.sales_by_customer(first, known))
    new_totals, new_state = facts.refresh_totals(totals, state, news, known)
    whole = fact(spark, DAY_1 + DAY_2)
    assert new_totals.dtypes == facts.sales_by_customer(whole, known).dtypes
    assert rows(new_totals) == rows(facts.sales_by_customer(whole, known))
    assert rows(new_state) == rows(facts.customer_state(whole))
    again, _ = facts.refresh_totals(new_totals, new_state, news.limit(0), known)
    assert rows(again) == rows(new_totals)


def test_untouched_customers_pass_through(spark):
    """Their totals are taken as they are, even if a state could not give them."""
    first, known = fact(spark, DAY_1), customers(spark)
    totals = facts.totals_of(facts.customer_state(first), known).withColumn("email", F.lit("kept"))
    state = facts.customer_state(first).filter("customer_key = 1 or customer_key is null")
    found, _ = facts.refresh_totals(totals, state, fact(spark, [(1, 8, 1, "1.00", 20240109)]), known)
    by_key = {r.customer_key: r for r in found.collect()}
    assert by_key[2].email == "kept" and by_key[1].email is None
    assert by_key[1].total_invoices == 3
