import datetime as dt
from decimal import Decimal

import pytest

from tributary.operators import facts
from tributary.operators.dimensions import date_dimension

AT = dt.datetime(2024, 3, 9, 15, 30)


@pytest.fixture(scope="module")
def star(spark):
    lines = spark.createDataFrame(
        [
            (1, 100, 7, 2, Decimal("0.99")),
            (2, 100, 8, 1, Decimal("1.99")),
            (3, 200, 7, 5, Decimal("2.00")),
            (4, 999, 7, 1, Decimal("1.00")),  # no such invoice
            (5, 300, 7, 1, Decimal("3.00")),
        ],
        "InvoiceLineId int, InvoiceId int, TrackId int, Quantity int, UnitPrice decimal(10,2)",
    )
    invoices = spark.createDataFrame(
        [(100, 1, AT, "C", "c"), (200, 1, AT, "D", "d"), (300, 9, AT, "E", None)],
        "InvoiceId int, CustomerId int, InvoiceDate timestamp, BillingCountry string,"
        " BillingCity string",
    )
    customers = spark.createDataFrame(
        [(11, 1, "Ann", "Lee", "C", "a@b", 4)],
        "customer_key bigint, customer_id int, first_name string, last_name string,"
        " country string, email string, support_rep_id int",
    )
    tracks = spark.createDataFrame([(21, 7)], "track_key bigint, track_id int")
    employees = spark.createDataFrame([(31, 4)], "employee_key bigint, employee_id int")
    dates = date_dimension(invoices, "InvoiceDate")
    fact = facts.sales(lines, invoices, customers, tracks, dates, employees)
    return fact, customers


def test_unmatched_sides_give_null_keys(star):
    rows = {r["invoice_line_id"]: r for r in star[0].collect()}
    assert sorted(rows) == [1, 2, 3, 5]
    assert rows[1]["line_total"] == Decimal("1.98")
    assert (rows[1]["customer_key"], rows[1]["support_rep_key"]) == (11, 31)
    assert rows[1]["date_key"] == 20240309
    assert rows[2]["track_key"] is None
    assert (rows[5]["customer_key"], rows[5]["support_rep_key"]) == (None, None)


def test_totals_per_customer(star):
    fact, customers = star
    rows = {r["customer_key"]: r for r in facts.sales_by_customer(fact, customers).collect()}
    assert sorted(rows, key=str) == [11, None]
    ann = rows[11]
    assert (ann["total_invoices"], ann["total_quantity"]) == (2, 8)
    assert ann["total_revenue"] == Decimal("13.97")
    assert ann["avg_line_total"] == Decimal("4.656667")
    assert (ann["first_name"], ann["last_purchase_date_key"]) == ("Ann", 20240309)
    assert rows[None]["total_revenue"] == Decimal("3.00")
    assert rows[None]["first_name"] is None


def test_date_attributes(star, spark):
    df = spark.createDataFrame([(AT,), (AT,), (dt.datetime(2024, 12, 31),)], "at timestamp")
    rows = {r["date_key"]: r for r in date_dimension(df, "at").collect()}
    assert sorted(rows) == [20240309, 20241231]
    saturday = rows[20240309].asDict()
    assert saturday == {
        "date_key": 20240309,
        "full_date": dt.date(2024, 3, 9),
        "year": 2024,
        "quarter": 1,
        "month": 3,
        "month_name": "March",
        "day_of_month": 9,
        "day_of_week": 7,
        "day_name": "Saturday",
        "is_weekend": True,
    }
    assert rows[20241231]["is_weekend"] is False


def test_hot_invoice_is_split(spark, star, tmp_path):
    """A third of the lines on one invoice: AQE splits its side of the join."""
    path = str(tmp_path / "lines")
    spark.range(80_000).repartition(8).selectExpr(
        "int(id) InvoiceLineId", "int(if(id % 3 = 0, 1, id)) InvoiceId", "7 TrackId",
        "1 Quantity", "cast(rand(1) * 90 as decimal(10,2)) UnitPrice",
    ).write.parquet(path)
    lines = spark.read.parquet(path)
    invoices = spark.range(80_000).selectExpr(
        "int(id) InvoiceId", "1 CustomerId", "timestamp'2024-03-09' InvoiceDate",
        "'C' BillingCountry", "'c' BillingCity",
    )
    tracks = spark.createDataFrame([(21, 7)], "track_key bigint, track_id int")
    employees = spark.createDataFrame([(31, 4)], "employee_key bigint, employee_id int")
    dates = date_dimension(invoices, "InvoiceDate")
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        fact = facts.sales(lines, invoices, star[1], tracks, dates, employees)
        assert len(fact.select("invoice_line_id").collect()) == 80_000
        fact = fact.select("invoice_line_id", "unit_price", "customer_key")
        assert fact.collect()
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true) [InvoiceId" in plan
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
