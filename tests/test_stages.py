"""The whole run: three days over a small music store."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tributary.operators import contracts, quality
from tributary.plans import settings, stages
from tributary.sources.relational import CatalogSource
from tributary.sources.tables import Lake

DAYS = [dt.datetime(2024, 6, d, 5, tzinfo=dt.timezone.utc) for d in (1, 2, 3)]


def customer(id_, first, last, **changes):
    row = dict(
        CustomerId=id_, FirstName=first, LastName=last, Company=None, Address="1 Main",
        City="Rome", State=None, Country="Italy", PostalCode="00100", Phone="1", Fax=None,
        Email=f" {first}@Mail.COM ", SupportRepId=1,
    )
    return Row(**{**row, **changes})


SCHEMAS = {
    "Customer": "CustomerId int, FirstName string, LastName string, Company string,"
    " Address string, City string, State string, Country string, PostalCode string,"
    " Phone string, Fax string, Email string, SupportRepId int",
    "Invoice": "InvoiceId int, CustomerId int, InvoiceDate string, BillingCity string,"
    " BillingCountry string, Total decimal(10,2)",
    "InvoiceLine": "InvoiceLineId int, InvoiceId int, TrackId int, UnitPrice decimal(10,2),"
    " Quantity int",
    "Track": "TrackId int, Name string, AlbumId int, MediaTypeId int, GenreId int,"
    " Composer string, Milliseconds int, Bytes int, UnitPrice decimal(10,2)",
    "Album": "AlbumId int, Title string, ArtistId int",
    "Artist": "ArtistId int, Name string",
    "Genre": "GenreId int, Name string",
    "MediaType": "MediaTypeId int, Name string",
    "Employee": "EmployeeId int, FirstName string, LastName string, Title string,"
    " ReportsTo int, BirthDate string, HireDate string, City string, Country string,"
    " Email string",
    "Playlist": "PlaylistId int, Name string",
    "PlaylistTrack": "PlaylistId int, TrackId int",
}


def first_day():
    price = Decimal("0.99")
    return {
        "Customer": [
            customer(1, "Ann", "Lee"),
            customer(2, "Bob", "May", Email="  "),  # a warning
            customer(3, "Cy", "Ray", Company="Acme", SupportRepId=None),
        ],
        "Invoice": [
            (1, 1, "2024-05-30 10:00:00", "Rome", "Italy", Decimal("2.97")),
            (2, 2, "2024-06-01 00:00:00", "Bonn", "Germany", Decimal("-1.00")),  # a warning
            (3, None, "2024-06-01 00:00:00", "Nice", "France", price),  # an error
        ],
        "InvoiceLine": [
            (1, 1, 1, price, 2), (2, 1, 2, price, 1), (3, 2, 1, price, 1),
            (4, 2, 2, price, 0),  # an error
            (5, 3, 1, price, 1),  # its invoice is quarantined
        ],
        "Track": [(1, " Song ", 1, 1, 1, None, 10, 20, price), (2, "Air", 1, 1, 1, "X", 1, 2, price),
                  (3, None, 1, 1, 1, "X", 1, 2, price)],
        "Album": [(1, "First", 1)],
        "Artist": [(1, "Band")],
        "Genre": [(1, "Rock")],
        "MediaType": [(1, "File")],
        "Employee": [(1, "Eve", None, "Agent", None, "1980-01-01 00:00:00", None, "x", "y", "e")],
        "Playlist": [(1, "All"), (1, "All")],
        "PlaylistTrack": [(1, 1), (1, 2)],
    }


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    lake = Lake(spark, root)

    def day(at, tables):
        for name, rows in tables.items():
            df = spark.createDataFrame(rows, SCHEMAS[name])
            df.createOrReplaceTempView(name)
        return stages.run(lake, CatalogSource(""), f"{root}/raw", at)

    return lake, day


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_day_one(run):
    lake, day = run
    counts = day(DAYS[0], first_day())
    assert counts["fact_sales"] == 3
    assert counts["dim_customer"] == 3
    assert counts["dim_date"] == 2
    gold = lambda name: lake.read(f"gold.{name}")
    assert values(gold("dim_customer"), "customer_key", "email", "company", "fax") == [
        (1, "ann@mail.com", "Individual", "N/A"),
        (2, "", "Individual", "N/A"),
        (3, "cy@mail.com", "Acme", "N/A"),
    ]
    assert values(gold("dim_track"), "track_key", "track_name") == [(1, "Song"), (2, "Air")]
    assert values(gold("dim_employee"), "employee_name") == [("Eve",)]
    assert values(gold("fact_sales"), "invoice_line_id", "customer_key", "track_key",
                  "date_key", "support_rep_key", "line_total") == [
        (1, 1, 1, 20240530, 1, Decimal("1.98")),
        (2, 1, 2, 20240530, 1, Decimal("0.99")),
        (3, 2, 1, 20240601, 1, Decimal("0.99")),
    ]
    assert values(gold("fact_sales_customer_agg"), "customer_key", "total_invoices",
                  "total_quantity", "total_revenue", "avg_line_total") == [
        (1, 1, 3, Decimal("2.97"), Decimal("1.4850")),
        (2, 1, 1, Decimal("0.99"), Decimal("0.9900")),
    ]
    for name, contract in settings.contracts().items():
        assert [(f.name, f.dataType) for f in contracts.conform(gold(name), contract).schema] == [
            (f.name, f.dataType) for f in contract.schema
        ]
        assert contracts.primary_key(gold(name), contract).count() == 0 


def test_logs_and_quarantine(run):
    lake, _ = run
    log = lake.read("raw_zone.pipeline_metadata_child")
    assert values(log.filter("table_name = 'Track'"), "status", "source_row_count",
                  "target_row_count") == [("SUCCESS", 3, 3)]
    quality = lake.read("silver.dqx_execution_log")
    assert values(quality.filter("failed_records > 0"), "table_name", "total_records",
                  "passed_records", "failed_records", "status") == [
        ("invoice", 3, 2, 1, "DONE"), ("invoiceline", 5, 4, 1, "DONE"), ("track", 3, 2, 1, "DONE"),
    ]
    rules = lake.read("silver.quality_rule_log")
    assert values(rules.filter("failed_records > 0 and level = 'warn'"), "rule") == [
        ("Email:not_null_and_not_empty",), ("Total:min_value",),
    ]
    rows = lake.read("silver.quarantine").collect()
    found = {r["table_name"]: (r["_error_details"], json.loads(r["_row_data"])) for r in rows}
    assert found["invoice"][0] == '["CustomerId:not_null"]'
    assert found["invoiceline"][1]["InvoiceLineId"] == 4
    assert "Name" not in found["track"][1]


def test_day_two_versions_the_customers(run):
    lake, day = run
    tables = first_day()
    tables["Customer"] = [
        customer(1, "Ann", "Lee", City="Oslo", State="N"),
        customer(3, "Cy", "Ray", Company="Acme", SupportRepId=1),
        customer(0, "Di", "New"),
    ]
    counts = day(DAYS[1], tables)
    assert counts["dim_customer"] == 6
    start, end = DAYS[0].date(), DAYS[1].date()
    dim = lake.read("gold.dim_customer")
    assert [tuple(r) for r in dim.select(
        "customer_key", "customer_id", "city", "effective_start_date", "effective_end_date",
        "is_current").orderBy("customer_key").collect()] == [
        (1, 1, "Rome", start, end, False),
        (2, 2, "Rome", start, None, True),
        (3, 3, "Rome", start, end, False),
        (4, 1, "Oslo", end, None, True),
        (5, 3, "Rome", end, None, True),
        (6, 0, "Rome", end, None, True),
    ]
    assert values(lake.read("gold.fact_sales"), "invoice_line_id", "customer_key") == [
        (1, 4), (2, 4), (3, 2),
    ]


def test_unchanged_day_keeps_the_dimensions(run):
    lake, _ = run
    before = {
        name: values(lake.read(f"gold.{name}"), *settings.contracts()[name].schema.names)
        for name in ("dim_track", "dim_artist")
    }
    versions = lake.read("gold.dim_customer").count()
    stages.run(lake, CatalogSource(""), f"{lake.root}/raw", DAYS[2])
    assert lake.read("gold.dim_customer").count() == versions
    for name, rows in before.items():
        assert values(lake.read(f"gold.{name}"), *settings.contracts()[name].schema.names) == rows
    assert lake.read("raw_zone.pipeline_metadata_parent").count() == 11
    assert lake.read("raw_zone.pipeline_metadata_child").count() == 33


def test_bronze_points_at_the_snapshots(run):
    """Nothing is copied from immutable Parquet files to a Parquet table."""
    lake, _ = run
    newest = lake.read("raw_zone.pipeline_metadata_child").filter("table_name = 'Track'")
    path = newest.orderBy(F.desc("execution_time")).first()["file_location"]
    files = lake.read("bronze.track").inputFiles()
    assert files and all(path in file for file in files)


def test_small_new_ids_move_no_track(run):
    lake, day = run
    before = dict(values(lake.read("gold.dim_track"), "track_id", "track_key"))
    tables = first_day()
    tables["Track"] = [(0, "Zero", 1, 1, 1, None, 1, 2, Decimal("0.99")), *tables["Track"]]
    day(dt.datetime(2024, 6, 3, 12, tzinfo=dt.timezone.utc), tables)
    after = dict(values(lake.read("gold.dim_track"), "track_id", "track_key"))
    assert after == {**before, 0: max(before.values()) + 1}
    tables = first_day()  # as the tests below expect it
    day(dt.datetime(2024, 6, 3, 13, tzinfo=dt.timezone.utc), tables)


def test_violations_report(run):
    lake, _ = run
    report = stages.violations(lake)
    assert values(report.filter("violations > 0"), "table_name", "column_name", "check") == []


def test_report_profiles_the_bronze_table(run):
    lake, _ = run
    reports = {r.table: r for r in stages.refine(lake, DAYS[2] + dt.timedelta(hours=1))}
    assert reports["playlist"].duplicates == 1
    assert reports["track"].nulls == {"Name": 1, "Composer": 1}
    assert reports["genre"].schema == [("GenreId", "int"), ("Name", "string")]


def test_a_run_repeated_after_a_crash_appends_nothing_twice(run, monkeypatch):
    """Quarantine and logs are written, then the run dies before any table is swapped."""
    lake, _ = run
    at = DAYS[2] + dt.timedelta(minutes=90)
    monkeypatch.setattr(Lake, "swap", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        stages.refine(lake, at)
    monkeypatch.undo()

    def counted():
        tables = ("quarantine", "dqx_execution_log", "quality_rule_log")
        stamped = [lake.read(f"silver.{t}").filter(F.col("run_timestamp") == F.lit(at).cast("timestamp")) for t in tables]
        return [df.count() for df in stamped]

    first = counted()
    assert all(first)
    stages.refine(lake, at)
    assert counted() == first
    stages.refine(lake, at + dt.timedelta(minutes=1))  # another run adds its own
    assert counted() == first


def test_failed_table_is_logged_and_stops_the_load(run, spark):
    lake, _ = run
    spark.catalog.dropTempView("Genre")
    at = DAYS[2] + dt.timedelta(hours=2)
    with pytest.raises(RuntimeError, match="Genre"):
        stages.check_sources(lake, CatalogSource(""))
    with pytest.raises(RuntimeError, match=r"\['Genre'\]"):
        stages.load_raw(lake, CatalogSource(""), f"{lake.root}/raw", at)
    log = lake.read("raw_zone.pipeline_metadata_child").filter("status = 'FAILED'")
    assert values(log, "table_name", "source_row_count") == [("Genre", 0)]
    assert stages.promote(lake)["genre"] == 1  # the last good snapshot


def test_inactive_tables_are_left_out(run, spark):
    lake, _ = run
    name = "raw_zone.pipeline_metadata_parent"
    off = lake.read(name).selectExpr(
        "table_name", "file_name", "if(table_name = 'Genre', 'N', active_flag) active_flag",
        "created_date", "modified_date",
    )
    lake.replace(off, name)
    assert "genre" not in stages.promote(lake)
    assert "genre" in stages.promote(lake, active_only=False)


def test_own_rules_catch_what_would_stop_the_cleaning(run, spark):
    """Malformed dates raise, unless a rule quarantines them first."""
    lake, day = run
    tables = first_day()
    tables["Invoice"][1] = (2, 2, "soon", "Bonn", "Germany", Decimal("1.00"))
    at = dt.datetime(2024, 6, 5, tzinfo=dt.timezone.utc)
    with pytest.raises(Exception, match="soon"):
        day(at, tables)
    assert lake.read("silver.invoice").count() == 2  # still the old table
    # the other tables are done, and no row of theirs is lost
    log = lake.read("silver.dqx_execution_log").filter(F.col("run_timestamp") == F.lit(at))
    found = {r["table_name"]: r for r in log.collect()}
    assert found["invoice"]["status"] == "FAILED"
    away = lake.read("silver.quarantine").filter(F.col("run_timestamp") == F.lit(at))
    held = {r["table_name"]: r["count"] for r in away.groupBy("table_name").count().collect()}
    for table in ("invoiceline", "track", "customer"):
        silver = lake.read(f"silver.{table}").count()
        assert silver + held.get(table, 0) == lake.read(f"bronze.{table}").count()
        assert found[table]["failed_records"] == held.get(table, 0)
    assert held["invoiceline"] and "invoice" not in held

    def rules(table):
        extra = [quality.IsTimestamp("InvoiceDate")] if table == "invoice" else []
        return [*settings.rules(table), *extra]

    reports = {r.table: r for r in stages.refine(lake, at, rules=rules)}
    assert reports["invoice"].failed == 2
    assert lake.read("silver.invoice").count() == 1
    found = lake.read("silver.quarantine").filter("_error_details like '%is_timestamp%'")
    assert [json.loads(r["_row_data"])["InvoiceDate"] for r in found.collect()] == ["soon"]


def test_a_failing_fact_leaves_all_of_gold(run, monkeypatch):
    lake, _ = run
    names = settings.contracts()
    before = {n: lake.read(f"gold.{n}").inputFiles() for n in names}
    monkeypatch.setattr(stages.facts, "sales", lambda *_: lake.spark.sql("select raise_error('x') a"))
    with pytest.raises(Exception):
        stages.publish(lake, dt.date(2024, 6, 7))
    assert {n: lake.read(f"gold.{n}").inputFiles() for n in names} == before


@pytest.mark.parametrize("step", ["create", "drop", "rename"])
def test_a_crash_in_a_schema_change_loses_no_table(run, spark, monkeypatch, step):
    lake, _ = run
    name = f"silver.changing_{step}"
    lake.replace(spark.range(3), name)
    real, broken = type(spark).sql, []

    def sql(self, text, *rest, **more):
        if not broken and {"create": "create table", "drop": f"drop table if exists {name}\n",
                           "rename": "rename to"}[step] in text + "\n":
            broken.append(text)
            raise RuntimeError("lost")
        return real(self, text, *rest, **more)

    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError, match="lost"):
        lake.replace(spark.range(5).selectExpr("id", "'new' as more"), name)
    assert broken and lake.exists(name)
    assert lake.read(name).count() == (5 if step == "rename" else 3)
    lake.replace(spark.range(7).selectExpr("id", "1 as other"), name)
    assert lake.read(name).count() == 7
