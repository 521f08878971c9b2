"""Joins with the version valid at a time, and faults of histories."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import facts, temporal
from tributary.operators.scd2 import Versioned
from test_queries import one_task_windows

SPEC = Versioned("key", "id", ("city",))
DAY = dt.date(2024, 1, 1)
VERSION = "key long, id int, city string, effective_start_date date, effective_end_date date, is_current boolean"


def day(n):
    return DAY + dt.timedelta(days=n)


def history(spark, rows):
    """Rows of key, id, start, end by day number; an end of None is open."""
    made = [(k, i, f"c{k}", day(s), None if e is None else day(e), e is None) for k, i, s, e in rows]
    return spark.createDataFrame(made, VERSION)


def plain(rows, versions):
    """The valid version by a search through all."""
    out = []
    for number, id_, at in rows:
        fits = [v for v in versions if id_ is not None and at is not None and v[1] == id_
                and v[2] <= at and (v[3] is None or at < v[3])]
        out.append((number, fits[0][0] if fits else None))
    return sorted(out)


def joined(spark, rows, versions, **options):
    facts_ = spark.createDataFrame(
        [(n, i, None if a is None else day(a)) for n, i, a in rows], "n int, who int, on date"
    )
    found = temporal.as_of_join(
        facts_, history(spark, versions), ("who", "id"), F.col("on"), ["key", "city"], **options
    )
    assert found.columns == ["n", "who", "on", "key", "city"]
    return sorted((r.n, r.key) for r in found.collect())


VERSIONS = [
    (1, 1, 0, 10), (2, 1, 10, 20), (3, 1, 25, None),  # a gap from 20 to 25
    (4, 2, 5, 5), (5, 2, 5, 8), (6, 2, 8, None),  # one that never held
    (7, 3, 3, None), (8, None, 0, None), (9, 5, 0, 4),
]
ROWS = [(n, id_, at) for n, (id_, at) in enumerate(
    [(i, a) for i in (1, 2, 3, 4, 5, None) for a in (*range(-1, 30), None)] + [(1, 10)] * 40
)]


@pytest.mark.parametrize("limit", [500_000, 4])
def test_against_a_search(spark, limit):
    assert joined(spark, ROWS, VERSIONS, rows_per_slice=limit) == plain(ROWS, VERSIONS)


def test_hot_id_is_cut_by_time(spark):
    """Half of the rows are of one id with many versions; no task sorts more than a slice."""
    some, versions, key = random.Random(3), [], 0
    for id_, count in ((1, 60), (2, 3), (3, 1)):
        bounds = sorted(some.sample(range(2000), count + 1))
        for s, e in zip(bounds, bounds[1:]):
            versions.append((key := key + 1, id_, s, e))
        versions.append((key := key + 1, id_, bounds[-1], None))
    rows = [(n, some.choice([1, 1, 2, 3]), some.randrange(2100)) for n in range(3000)]
    assert joined(spark, rows, versions, rows_per_slice=100) == plain(rows, versions)

    moments = spark.createDataFrame([(i, day(a)) for _, i, a in rows], "_id int, _at date").distinct()
    cuts = temporal._cuts(moments, 100)
    sliced = moments.join(cuts, "_id", "left").withColumn(
        "_slice", temporal._slice("_cuts", temporal._order("_at"))
    )
    sizes = sliced.groupBy("_id", "_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 130
    assert sizes.filter("_id = 1").count() >= 10


def test_timestamps_and_empty_sides(spark):
    at = dt.datetime(2024, 1, 1, 12)
    rows = spark.createDataFrame([(1, at), (1, at + dt.timedelta(seconds=5))], "who int, at timestamp")
    versions = spark.createDataFrame(
        [(1, 7, at, at + dt.timedelta(seconds=5)), (1, 8, at + dt.timedelta(seconds=5), None)],
        "id int, key int, s timestamp, e timestamp",
    )
    found = temporal.as_of_join(rows, versions, ("who", "id"), F.col("at"), ["key"], "s", "e")
    assert sorted(r.key for r in found.collect()) == [7, 8]
    found = temporal.as_of_join(rows, versions.limit(0), ("who", "id"), F.col("at"), ["key"], "s", "e")
    assert [r.key for r in found.collect()] == [None, None]
    found = temporal.as_of_join(rows.limit(0), versions, ("who", "id"), F.col("at"), ["key"], "s", "e")
    assert found.count() == 0


def test_plan_has_no_range_join(spark):
    versions = history(spark, VERSIONS)
    rows = spark.createDataFrame([(1, 1, DAY)], "n int, who int, on date")
    found = temporal.as_of_join(rows, versions, ("who", "id"), F.col("on"), ["key"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert one_task_windows(plan) == []


def test_history_faults(spark):
    rows = [
        (1, 1, 0, 10), (2, 1, 10, None),  # sound
        (3, 2, 0, 10), (4, 2, 12, None),  # gap 10-12
        (5, 3, 0, 10), (6, 3, 8, None),  # overlap 8-10
        (7, 4, 0, None), (8, 4, 5, None),  # overlap from 5, two current rows
        (9, 5, 4, 2), (10, 5, 4, 4), (11, 5, 4, None),  # reversed, empty, sound
        (12, 6, 0, 10), (13, 6, 0, 10), (14, 6, 0, 10), (15, 6, 20, 30),  # three at once, a gap
        (16, None, 0, 3),
    ]
    dim = history(spark, rows).withColumn(
        "is_current", F.when(F.col("key") == 15, F.lit(None)).when(F.col("key") == 2, False).otherwise(F.col("is_current"))
    )
    found = {tuple(r) for r in temporal.history_faults(dim, SPEC).collect()}
    assert found == {
        (1, "flag", day(10), None, 1),
        (2, "gap", day(10), day(12), 0),
        (3, "overlap", day(8), day(10), 2),
        (4, "overlap", day(5), None, 2),
        (4, "several_current", None, None, 2),
        (5, "reversed", day(4), day(2), 1),
        (6, "overlap", day(0), day(10), 3),
        (6, "gap", day(10), day(20), 0),
    }
    assert temporal.history_faults(dim.limit(0), SPEC).count() == 0


def test_sales_book_on_the_version_of_their_day(spark):
    at = lambda n: dt.datetime.combine(day(n), dt.time(9))
    invoices = spark.createDataFrame(
        [(100, 1, at(5), "C", "c"), (101, 1, at(12), "C", "c"), (102, 1, at(-3), "C", "c"), (103, None, at(5), "C", "c")],
        "InvoiceId int, CustomerId int, InvoiceDate timestamp, BillingCountry string, BillingCity string",
    )
    lines = invoices.selectExpr("InvoiceId * 10 as InvoiceLineId", "InvoiceId", "7 as TrackId", "1 as Quantity",
                                "cast(2 as decimal(10,2)) as UnitPrice")
    customers = history(spark, [(11, 1, 0, 10), (12, 1, 10, None)]).selectExpr(
        "key as customer_key", "id as customer_id", "cast(key - 10 as int) as support_rep_id",
        "effective_start_date", "effective_end_date", "is_current")
    employees = spark.createDataFrame([(31, 1), (32, 2)], "employee_key long, employee_id int")
    tracks = spark.createDataFrame([(21, 7)], "track_key long, track_id int")
    dates = spark.createDataFrame([(20240106, day(5))], "date_key int, full_date date")
    fact = facts.sales_as_of(lines, invoices, customers, tracks, dates, employees)
    found = {r.invoice_id: (r.customer_key, r.support_rep_key, r.date_key, r.track_key) for r in fact.collect()}
    assert found == {
        100: (11, 31, 20240106, 21),
        101: (12, 32, None, 21),
        102: (None, None, None, 21),
        103: (None, None, 20240106, 21),
    }
