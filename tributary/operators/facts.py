"""The sales fact and its per-customer aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .temporal import as_of_join

# The columns of the fact, and the invoice, line or key each comes from.
FACT_COLUMNS = {
    "invoice_line_id": "InvoiceLineId",
    "invoice_id": "InvoiceId",
    "customer_key": "customer_key",
    "track_key": "track_key",
    "date_key": "date_key",
    "support_rep_key": "support_rep_key",
    "quantity": "Quantity",
    "unit_price": "UnitPrice",
    "line_total": "Quantity * UnitPrice",
    "billing_country": "BillingCountry",
    "billing_city": "BillingCity",
}

# The totals per customer, and the attributes of the customer beside them.
CUSTOMER_TOTALS = {
    "total_invoices": "count(distinct invoice_id)",
    "total_quantity": "sum(quantity)",
    "total_revenue": "sum(line_total)",
    "avg_line_total": "avg(line_total)",
    "last_purchase_date_key": "max(date_key)",
}
CUSTOMER_ATTRIBUTES = ["customer_id", "first_name", "last_name", "country", "email"]


def sales_headers(
    invoices: DataFrame, customers: DataFrame, dates: DataFrame, employees: DataFrame
) -> DataFrame:
    """Invoices with the keys of their customer, date and support representative.

    A representative belongs to a customer, so the two dimensions are joined first and the
    invoices are not moved by a column of a few values. All joins are left joins with the
    invoices on the left, so they can run before the lines come in.
    """
    agents = employees.select(
        F.col("employee_id").alias("_agent"), F.col("employee_key").alias("support_rep_key")
    )
    buyers = customers.join(agents, F.col("support_rep_id") == F.col("_agent"), "left").select(
        F.col("customer_id").alias("_buyer"), "customer_key", "support_rep_key"
    )
    days = dates.select(F.col("full_date").alias("_day"), "date_key")
    wanted = ["InvoiceId", "BillingCountry", "BillingCity"]
    return (
        invoices.join(buyers, F.col("CustomerId") == F.col("_buyer"), "left")
        .join(days, F.to_date("InvoiceDate") == F.col("_day"), "left")
        .select(*wanted, "customer_key", "date_key", "support_rep_key")
    )


def sales(
    lines: DataFrame,
    invoices: DataFrame,
    customers: DataFrame,
    tracks: DataFrame,
    dates: DataFrame,
    employees: DataFrame,
) -> DataFrame:
    """One row per invoice line that has an invoice; unmatched dimensions give NULL keys.

    ``customers`` holds the versions to book on, normally the current ones.
    Headers are completed first: the lines, the largest input, are then moved
    once for the header join and once more only if tracks are too many to
    broadcast. Hot invoices, customers or tracks are left to AQE, which can split
    the left side of each of these joins.
    """
    return _booked(lines, sales_headers(invoices, customers, dates, employees), tracks)


def _booked(lines: DataFrame, headers: DataFrame, tracks: DataFrame) -> DataFrame:
    """The fact from lines and completed headers."""
    numbers = tracks.select(F.col("track_id").alias("_track"), "track_key")
    booked = lines.join(headers, "InvoiceId").join(
        numbers, F.col("TrackId") == F.col("_track"), "left"
    )
    return booked.select(*[F.expr(source).alias(name) for name, source in FACT_COLUMNS.items()])


def sales_as_of(
    lines: DataFrame,
    invoices: DataFrame,
    history: DataFrame,
    tracks: DataFrame,
    dates: DataFrame,
    employees: DataFrame,
) -> DataFrame:
    """As ``sales``, but each invoice books on the customer version valid on its day.

    ``history`` holds all versions. An invoice from before the first version, or in a gap, has
    a NULL customer key, and so has its representative, who is that of the version.
    """
    dated = as_of_join(
        invoices,
        history,
        ("CustomerId", "customer_id"),
        F.to_date("InvoiceDate"),
        ["customer_key", "support_rep_id"],
    )
    agents = employees.select(
        F.col("employee_id").alias("_agent"), F.col("employee_key").alias("support_rep_key")
    )
    days = dates.select(F.col("full_date").alias("_day"), "date_key")
    wanted = ["InvoiceId", "BillingCountry", "BillingCity"]
    headers = (
        dated.join(agents, F.col("support_rep_id") == F.col("_agent"), "left")
        .join(days, F.to_date("InvoiceDate") == F.col("_day"), "left")
        .select(*wanted, "customer_key", "date_key", "support_rep_key")
    )
    return _booked(lines, headers, tracks)


def sales_by_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Totals per customer key with the attributes of the current version.

    Spark counts the distinct invoices in two steps, by key and invoice and then
    by key, so a customer with a large share of the lines is spread over tasks.
    Pass the fact as written: behind its join by invoice, the first step would
    reuse that partitioning, which keeps AQE from splitting a hot invoice.
    """
    totals = [F.expr(total).alias(name) for name, total in CUSTOMER_TOTALS.items()]
    attributes = customers.select("customer_key", *CUSTOMER_ATTRIBUTES)
    return fact.groupBy("customer_key").agg(*totals).join(attributes, "customer_key", "left")


def customer_state(fact: DataFrame) -> DataFrame:
    """One row per customer key and invoice: what any later total of the customer needs.

    States of different days add up (``merge_states``); an invoice whose lines come on several
    days is still one invoice. A customer with a large share of the lines is spread
    by invoice.
    """
    return fact.groupBy("customer_key", "invoice_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("quantity").cast("long")).alias("quantity"),
        F.count("line_total").alias("priced"),
        F.sum(F.col("line_total").cast("decimal(31,2)")).cast("decimal(31,2)").alias("revenue"),
        F.max("date_key").alias("last_date_key"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """States of disjoint lines as one."""
    return (
        reduce(DataFrame.unionByName, states)
        .groupBy("customer_key", "invoice_id")
        .agg(
            *(F.sum(c).alias(c) for c in ("lines", "quantity", "priced")),
            F.sum("revenue").cast("decimal(31,2)").alias("revenue"),
            F.max("last_date_key").alias("last_date_key"),
        )
        .select("customer_key", "invoice_id", "lines", "quantity", "priced", "revenue", "last_date_key")
    )


def totals_of(state: DataFrame, customers: DataFrame) -> DataFrame:
    """As ``sales_by_customer``, from a state.

    The average is rounded half up to six digits, as the average of the lines is.
    """
    cents = F.abs(F.col("total_revenue") * 100).cast("decimal(33,0)")
    rounded = F.expr("(_cents * 20000 + priced) div (2 * priced)") * F.signum("total_revenue").cast("long")
    micros = F.lit("0.000001").cast("decimal(7,6)")
    summed = state.groupBy("customer_key").agg(
        F.count("invoice_id").alias("total_invoices"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("revenue").cast("decimal(31,2)").alias("total_revenue"),
        F.sum("priced").alias("priced"),
        F.max("last_date_key").alias("last_purchase_date_key"),
    )
    average = F.when(F.col("priced") > 0, (rounded.cast("decimal(30,0)") * micros).cast("decimal(25,6)"))
    attributes = customers.select("customer_key", *CUSTOMER_ATTRIBUTES)
    return (
        summed.withColumn("_cents", cents)
        .withColumn("avg_line_total", average)
        .join(attributes, "customer_key", "left")
        .select("customer_key", *CUSTOMER_TOTALS, *CUSTOMER_ATTRIBUTES)
    )


def refresh_totals(
    totals: DataFrame, state: DataFrame, news: DataFrame, customers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Totals and state after new lines: only customers who have some are computed again.

    ``news`` are fact rows that ``state`` does not hold yet. What others have passes through; their
    lines are not read, nor is the fact behind ``state``. ``customers`` gives the attributes
    beside the new totals.
    """
    added = stage(customer_state(news), "news")
    keys = added.select(F.col("customer_key").alias("_touched")).distinct()
    is_touched = F.col("customer_key").eqNullSafe(F.col("_touched"))
    mine = merge_states(state.join(keys, is_touched, "left_semi"), added)
    mine = stage(mine, "state")
    new_state = state.join(keys, is_touched, "left_anti").unionByName(mine)
    kept = totals.join(keys, is_touched, "left_anti")
    return kept.unionByName(totals_of(mine, customers)), new_state
