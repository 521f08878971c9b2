"""Every operator as a query over the given tables, by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import date_parts
from ..operators import (
    changes,
    cleaning,
    comparison,
    contracts,
    dimensions,
    facts,
    joins,
    keys,
    profiling,
    quality,
    scd2,
    temporal,
)
from ..session import scratch, stage
from ..sources import registry, runlog, snapshots
from . import settings
from .roles import Roles

Query = Callable[[SparkSession, str], DataFrame]

RUN_AT = dt.datetime(2024, 1, 15, 6, 30, tzinfo=dt.timezone.utc)
DAY1, DAY2, DAY3 = dt.date(2024, 1, 15), dt.date(2024, 2, 15), dt.date(2024, 3, 15)
BETWEEN = dt.date(2024, 2, 1)
YEAR1, YEAR2, YEAR3 = dt.date(1996, 2, 1), dt.date(1998, 3, 1), dt.date(2000, 4, 1)

_queries: dict[str, Query] = {}


class Store:
    """The layers over one data folder, each frame built when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.roles = Roles(spark, folder)
        self.spec = settings.customer_versions()
        self._gold: dict[str, DataFrame] = {}

    def cleaned(self, role: str, table: str | None = None) -> DataFrame:
        """A role after its table's rules and cleaning steps."""
        table = table or role
        valid, _ = quality.split(self.roles[role], settings.rules(table))
        return cleaning.clean(valid, settings.CLEANING.get(table, []))

    def dimension(self, name: str) -> DataFrame:
        """A type-1 dimension."""
        d = settings.dimensions()[name]
        return dimensions.build(self.cleaned(d.source), d.mapping, d.natural_key, d.key)

    def dates(self) -> DataFrame:
        return dimensions.date_dimension(self.cleaned("invoice"), "InvoiceDate")

    def customers(self, role: str) -> DataFrame:
        """A customer snapshot under the names of the dimension."""
        mapping = settings.dimensions()["dim_customer"].mapping
        return dimensions.project(self.cleaned(role, "customer"), mapping)

    @cached_property
    def day1(self) -> DataFrame:
        """The customer dimension after the first snapshot."""
        return stage(scd2.initial(self.customers("customer_day1"), self.spec, DAY1), "dim")

    @cached_property
    def incoming(self) -> DataFrame:
        """The second snapshot, written as the Silver table it stands for."""
        return stage(self.customers("customer_day2"), "silver")

    def arrivals(self) -> DataFrame:
        return scd2.arrivals(self.day1, self.incoming, self.spec, DAY2)

    def day2(self) -> DataFrame:
        """The customer dimension after the second snapshot."""
        return scd2.apply(self.day1, self.incoming, self.spec, DAY2)

    @cached_property
    def history(self) -> DataFrame:
        """Customer versions over the years of the invoices, from three snapshots."""
        first = stage(scd2.initial(self.customers("customer_day1"), self.spec, YEAR1), "dim")
        second = stage(scd2.apply(first, self.incoming, self.spec, YEAR2), "dim")
        return stage(scd2.apply(second, self.customers("customer"), self.spec, YEAR3), "dim")

    def fact(self) -> DataFrame:
        """The sales fact over written dimensions, whose sizes Spark knows."""
        self.write_gold("dim_customer", "dim_track", "dim_date", "dim_employee")
        return facts.sales(
            self.cleaned("invoiceline"),
            self.cleaned("invoice"),
            scd2.current(self.gold("dim_customer")),
            self.gold("dim_track"),
            self.gold("dim_date"),
            self.gold("dim_employee"),
        )

    def gold(self, name: str) -> DataFrame:
        """A Gold table by name: conformed to its contract and written once."""
        if name not in self._gold:
            frame = self._gold_frame(name)
            self._gold[name] = stage(contracts.conform(frame, settings.contracts()[name]), name)
        return self._gold[name]

    def write_gold(self, *names: str) -> None:
        """Write Gold tables that do not depend on each other side by side."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(self.gold, names))

    def _gold_frame(self, name: str) -> DataFrame:
        if name == "dim_date":
            return self.dates()
        if name == "dim_customer":
            return self.day2()
        if name == "fact_sales":
            return self.fact()
        if name == "fact_sales_customer_agg":
            customers = scd2.current(self.gold("dim_customer"))
            return facts.sales_by_customer(self.gold("fact_sales"), customers)
        return self.dimension(name)


def query(function: Callable[[Store], DataFrame]) -> Callable[[Store], DataFrame]:
    """Register a function of the store under its own name."""
    _queries[function.__name__] = lambda spark, folder: function(Store(spark, folder))
    return function


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# --- scans, snapshots, registry and run log -------------------------------------


@query
def scan_snapshot(store: Store) -> DataFrame:
    """Write a counted snapshot of the invoice lines and read some columns back."""
    base = scratch(store.spark, "raw")
    path = snapshots.location(base, "InvoiceLine", RUN_AT)
    snapshots.reconcile(store.roles["invoiceline"], path)
    lines = snapshots.read(store.spark, path)
    return lines.select("InvoiceLineId", "InvoiceId", "Quantity", "UnitPrice")


@query
def snapshot_fingerprint(store: Store) -> DataFrame:
    """Snapshots against what was written, and against copies of equal counts with other contents."""
    base = scratch(store.spark, "raw")
    invoices, customers = store.roles["invoice"], store.roles["customer"]
    other = invoices.select((F.col("InvoiceId").bitwiseXOR(F.lit(1))).alias("InvoiceId"), F.col("Total").alias("_total"))
    copies = {
        ("invoice", "as written"): invoices,
        # totals change places between neighbours, so no column is other by itself
        ("invoice", "totals moved"): invoices.join(other, "InvoiceId").select(
            *[F.col("_total").alias(c) if c == "Total" else c for c in invoices.columns]
        ),
        ("customer", "as written"): customers,
        ("customer", "blank fax"): customers.fillna({"Fax": ""}),
        ("customer", "places changed"): customers.withColumns({"City": F.col("Country"), "Country": F.col("City")}),
    }
    written = {
        "invoice": snapshots.reconcile_content(invoices, snapshots.location(base, "Invoice", RUN_AT)),
        "customer": snapshots.reconcile_content(customers, snapshots.location(base, "Customer", RUN_AT)),
    }
    rows = []
    for (table, case), copy in copies.items():
        found, known = comparison.fingerprint(copy), written[table]
        rows.append((table, case, found.rows, found == known, ",".join(known.differing(found))))
    return store.spark.createDataFrame(
        rows, "table_name string, copy string, rows long, is_same boolean, columns string"
    )


@query
def snapshot_diff(store: Store) -> DataFrame:
    """What the second customer snapshot adds, removes and changes."""
    return comparison.differences(
        store.roles["customer_day1"], store.roles["customer_day2"], "CustomerId"
    )


@query
def row_count_reconcile(store: Store) -> DataFrame:
    return runlog.reconcile(store.roles["runlog"])


def _registry(store: Store) -> DataFrame:
    """A registry as the run log implies it: active if the newest run succeeded."""
    newest = F.max_by("status", F.struct("execution_time", "file_location"))
    day = F.to_date("execution_time")
    return (
        store.roles["runlog"]
        .groupBy("table_name")
        .agg(
            F.concat("table_name", F.lit(".csv")).alias("file_name"),
            F.when(newest == runlog.SUCCESS, "Y").otherwise("N").alias("active_flag"),
            F.min(day).alias("created_date"),
            F.max(day).alias("modified_date"),
        )
    )


@query
def insert_if_absent(store: Store) -> DataFrame:
    seed = registry.entries(store.spark, settings.registry_entries(), DAY1)
    known = stage(_registry(store), "registry")  # read twice below
    again = known.withColumn("active_flag", F.lit("N"))  # present already, so not added
    return registry.insert_if_absent(known, seed.unionByName(again))


@query
def active_entries(store: Store) -> DataFrame:
    return registry.active(_registry(store))


@query
def latest_success(store: Store) -> DataFrame:
    return runlog.latest_success(store.roles["runlog"])


# --- profiles --------------------------------------------------------------------


@query
def profile_rows(store: Store) -> DataFrame:
    return profiling.row_count(store.roles["customer_copies"])


@query
def profile_nulls(store: Store) -> DataFrame:
    return profiling.null_counts(store.roles["customer_copies"])


@query
def profile_null_columns(store: Store) -> DataFrame:
    return profiling.null_columns(store.roles["customer_copies"])


@query
def profile_duplicates(store: Store) -> DataFrame:
    return profiling.duplicate_count(store.roles["customer_copies"])


@query
def profile_schema(store: Store) -> DataFrame:
    return profiling.schema_summary(store.roles["invoiceline"])


# --- quality rules ---------------------------------------------------------------


@query
def dq_not_null(store: Store) -> DataFrame:
    return quality.failing(store.roles["invoice"], quality.NotNull("CustomerId"))


@query
def dq_not_empty(store: Store) -> DataFrame:
    return quality.failing(store.roles["customer"], quality.NotEmpty("Email"))


@query
def dq_min_value(store: Store) -> DataFrame:
    return quality.failing(store.roles["invoiceline"], quality.MinValue("Quantity", bound=1))


@query
def dq_warn_only(store: Store) -> DataFrame:
    """Rows pass although some break a warning."""
    rules = [r for r in settings.rules("customer") if r.level == quality.WARN]
    valid, quarantine = quality.split(store.roles["customer"], rules)
    return valid.withColumn("passed", F.lit(True)).unionByName(
        quarantine.drop(quality.ERRORS).withColumn("passed", F.lit(False))
    )


@query
def dq_tag_errors(store: Store) -> DataFrame:
    return quality.tag(store.roles["invoiceline"], settings.rules("invoiceline"))


@query
def dq_valid(store: Store) -> DataFrame:
    return quality.split(store.roles["invoiceline"], settings.rules("invoiceline"))[0]


@query
def dq_quarantine(store: Store) -> DataFrame:
    return quality.split(store.roles["invoice"], settings.rules("invoice"))[1]


@query
def dq_no_rules(store: Store) -> DataFrame:
    """A table without rules passes whole; its quarantine is empty."""
    valid, quarantine = quality.split(store.roles["track"], [])
    return valid.withColumn(quality.ERRORS, F.lit("[]")).unionByName(quarantine)


@query
def quarantine_rows(store: Store) -> DataFrame:
    """The quarantine of both sales tables in one layout."""
    parts = []
    for table in ("invoice", "invoiceline"):
        _, failed = quality.split(store.roles[table], settings.rules(table))
        parts.append(quality.to_quarantine(failed, table, RUN_AT))
    rows = parts[0].unionByName(parts[1])
    return rows.withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))


def _every_table(work: Callable[[str], DataFrame]) -> DataFrame:
    """The same work on each registered table, as one frame."""
    parts = [work(table.lower()) for table, _ in settings.registry_entries()]
    return reduce(DataFrame.unionByName, parts)


@query
def dq_rule_counts(store: Store) -> DataFrame:
    """Failing rows for all rules of all tables."""
    return _every_table(
        lambda table: quality.rule_counts(store.roles[table], settings.rules(table), table)
    )


@query
def dq_run_summary(store: Store) -> DataFrame:
    """The quality log of a run over all tables."""
    rows = _every_table(
        lambda table: quality.summarize(store.roles[table], settings.rules(table), table, RUN_AT)
    )
    return rows.withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))


# --- cleaning --------------------------------------------------------------------


@query
def clean_trim(store: Store) -> DataFrame:
    return cleaning.trim_strings(store.roles["customer"])


@query
def clean_lower(store: Store) -> DataFrame:
    return store.roles["customer"].transform(cleaning.lower("Email"))


@query
def clean_fillna(store: Store) -> DataFrame:
    fill = cleaning.defaults({"Company": "Individual", "Fax": "N/A"})
    return store.roles["customer"].transform(fill)


@query
def clean_timestamp(store: Store) -> DataFrame:
    """Employee dates as timestamps."""
    columns = ["BirthDate", "HireDate"]
    employees = store.roles["employee"].transform(cleaning.to_timestamps(*columns))
    return employees.select(
        "EmployeeId", *[F.col(c).cast("timestamp_ntz").alias(c) for c in columns]
    )


@query
def clean_timestamp_text(store: Store) -> DataFrame:
    """Dates in text, the lenient way: malformed text is NULL, and a rule would report it."""
    texts = quality.tag(store.roles["invoice_text"], [quality.IsTimestamp("InvoiceDate")])
    parsed = texts.transform(cleaning.to_timestamps("InvoiceDate", strict=False))
    return parsed.withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp_ntz"))


@query
def clean_timestamp_strict(store: Store) -> DataFrame:
    """Dates in text, the strict way, after a rule has taken out what would raise."""
    rules = [quality.IsTimestamp("InvoiceDate")]
    valid, _ = quality.split(store.roles["invoice_text"], rules)
    parsed = valid.transform(cleaning.to_timestamps("InvoiceDate"))
    return parsed.withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp_ntz"))


@query
def silver_customer(store: Store) -> DataFrame:
    return store.cleaned("customer")


# --- dimensions ------------------------------------------------------------------


@query
def dim_artist(store: Store) -> DataFrame:
    return store.dimension("dim_artist")


@query
def dim_genre(store: Store) -> DataFrame:
    return store.dimension("dim_genre")


@query
def dim_mediatype(store: Store) -> DataFrame:
    return store.dimension("dim_mediatype")


@query
def dim_album(store: Store) -> DataFrame:
    return store.dimension("dim_album")


@query
def dim_track(store: Store) -> DataFrame:
    return store.dimension("dim_track")


@query
def dim_track_second_run(store: Store) -> DataFrame:
    """Tracks without a composer come later; their small ids move no key of the first run."""
    d, tracks = settings.dimensions()["dim_track"], store.cleaned("track")
    known = tracks.filter(F.col("Composer").isNotNull())
    first = stage(dimensions.build(known, d.mapping, d.natural_key, d.key), "dim")
    return dimensions.build(tracks, d.mapping, d.natural_key, d.key, first)


@query
def dim_employee(store: Store) -> DataFrame:
    moments = ["birth_date", "hire_date"]
    return store.dimension("dim_employee").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in moments}
    )


@query
def dim_playlist(store: Store) -> DataFrame:
    return store.dimension("dim_playlist")


@query
def dim_date(store: Store) -> DataFrame:
    return store.dates()


# --- the versioned customer dimension --------------------------------------------


@query
def scd2_initial(store: Store) -> DataFrame:
    return scd2.initial(store.customers("customer"), store.spec, DAY1)


@query
def scd2_current(store: Store) -> DataFrame:
    return scd2.current(store.day2())


@query
def scd2_changed(store: Store) -> DataFrame:
    return scd2.changed(store.day1, store.incoming, store.spec)


@query
def scd2_changed_nullunsafe(store: Store) -> DataFrame:
    return scd2.changed(store.day1, store.incoming, store.spec, null_safe=False)


@query
def scd2_expired(store: Store) -> DataFrame:
    ids = scd2.changed(store.day1, store.incoming, store.spec)
    return scd2.expire(store.day1, ids, store.spec, DAY2)


@query
def scd2_new_versions(store: Store) -> DataFrame:
    return store.arrivals().filter(~F.col("_is_new")).drop("_is_new")


@query
def scd2_inserts(store: Store) -> DataFrame:
    return store.arrivals().filter(F.col("_is_new")).drop("_is_new")


@query
def scd2_merge(store: Store) -> DataFrame:
    return store.day2()


@query
def scd2_merge_again(store: Store) -> DataFrame:
    """A third snapshot over closed versions: changes are taken back, missing customers return."""
    present = stage(store.day2(), "dim")
    incoming = stage(store.customers("customer"), "silver")
    return scd2.apply(present, incoming, store.spec, DAY3)


@query
def scd2_merge_by_diff(store: Store) -> DataFrame:
    """The third merge again, fed by what differs from the second snapshot."""
    present = stage(store.day2(), "dim")
    incoming = stage(store.customers("customer"), "silver")
    now = scd2.touched_since(present, store.incoming, incoming, store.spec, DAY3)
    return scd2.closed(present).unionByName(now)


@query
def scd2_missing_kept(store: Store) -> DataFrame:
    """Customers that left the source are still current."""
    return scd2.current(store.day2()).join(
        store.incoming.select("customer_id"), "customer_id", "left_anti"
    )


@query
def scd2_as_of(store: Store) -> DataFrame:
    return scd2.as_of(store.day2(), BETWEEN)


@query
def scd2_history_shape(store: Store) -> DataFrame:
    """Faults of a history in which ends were moved, versions repeated and flags turned."""
    id_, end = F.col("customer_id"), F.col(scd2.END)
    moved = (
        F.when(id_ % 10 == 1, F.date_add(end, 20))  # into the next version
        .when(id_ % 10 == 3, F.date_add(end, -20))  # leaves a gap
        .when(id_ % 15 == 5, F.date_add(F.col(scd2.START), -1))  # before its start
        .otherwise(end)
    )
    turned = F.when(id_ % 37 == 0, ~F.col(scd2.CURRENT)).otherwise(F.col(scd2.CURRENT))
    rows = store.history.withColumns({scd2.END: moved, scd2.CURRENT: turned})
    again = rows.filter((id_ % 29 == 0) & F.col(scd2.CURRENT))
    return temporal.history_faults(rows.unionByName(again), store.spec)


# --- joins, fact and aggregate ---------------------------------------------------


@query
def join_inner(store: Store) -> DataFrame:
    lines, invoices = store.roles["invoiceline"], store.roles["invoice"]
    return lines.join(invoices, "InvoiceId", "inner").select(
        "InvoiceLineId", "InvoiceId", "CustomerId", "Quantity", "UnitPrice"
    )


@query
def join_left_scd2(store: Store) -> DataFrame:
    """Invoices with the current version of their customer, if there is one."""
    customer = scd2.current(store.gold("dim_customer")).select("customer_key", "customer_id", "support_rep_id")
    return (
        store.cleaned("invoice")
        .join(customer, F.col("CustomerId") == F.col("customer_id"), "left")
        .select("InvoiceId", "CustomerId", "customer_key", "support_rep_id")
    )


@query
def join_on_expression(store: Store) -> DataFrame:
    day = store.gold("dim_date").select("full_date", "date_key")
    return (
        store.cleaned("invoice")
        .join(day, F.to_date("InvoiceDate") == F.col("full_date"), "left")
        .select("InvoiceId", "date_key")
    )


@query
def semi_join_changed(store: Store) -> DataFrame:
    """Incoming customers with a changed attribute."""
    return scd2.changed_rows(store.day1, store.incoming, store.spec)


@query
def anti_join_new(store: Store) -> DataFrame:
    """Incoming customers the dimension has never seen."""
    return scd2.new_rows(store.day1, store.incoming, store.spec)


@query
def fact_sales(store: Store) -> DataFrame:
    return store.fact()


@query
def fact_sales_as_of(store: Store) -> DataFrame:
    """Each invoice on the customer version of its day, not on today's."""
    store.write_gold("dim_track", "dim_date", "dim_employee")
    return facts.sales_as_of(
        store.cleaned("invoiceline"),
        store.cleaned("invoice"),
        store.history,
        store.gold("dim_track"),
        store.gold("dim_date"),
        store.gold("dim_employee"),
    )


@query
def fact_sales_customer_agg(store: Store) -> DataFrame:
    """Totals over the written fact.

    On the unwritten one Spark would keep the partitioning of the invoice join
    for the aggregate, and then not split a hot invoice.
    """
    fact = stage(store.fact(), "fact")
    return facts.sales_by_customer(fact, scd2.current(store.gold("dim_customer")))


@query
def fact_sales_customer_agg_refresh(store: Store) -> DataFrame:
    """Totals of the small lines, brought up to date by the others; invoices have lines of both."""
    fact = stage(store.fact(), "fact")
    customers = scd2.current(store.gold("dim_customer"))
    first, news = fact.filter("quantity < 25"), fact.filter("quantity >= 25")
    state = stage(facts.customer_state(first), "state")
    totals = stage(facts.totals_of(state, customers), "totals")
    return facts.refresh_totals(totals, state, news, customers)[0]


@query
def join_heavy_keys(store: Store) -> DataFrame:
    """Pieces per album, where large orders are all booked on one track."""
    booked = F.when(F.col("Quantity") >= 40, F.lit(0)).otherwise(F.col("TrackId"))
    lines = store.roles["invoiceline"].select(booked.alias("TrackId"), "Quantity")
    tracks = store.roles["track"].select("TrackId", "AlbumId")
    joined = joins.split_join(lines, tracks, "TrackId", "left")
    return joined.groupBy("TrackId", "AlbumId").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("Quantity").alias("pieces")
    )


# --- surrogate keys --------------------------------------------------------------


@query
def surrogate_key(store: Store) -> DataFrame:
    """Album keys that do not depend on the order of the files."""
    return keys.dense_key(store.roles["album"], "album_key", "AlbumId")


@query
def row_number_key(store: Store) -> DataFrame:
    numbered = keys.dense_key(store.customers("customer"), "customer_key", "customer_id")
    return numbered.select("customer_key", "customer_id", "email")


@query
def key_continuation(store: Store) -> DataFrame:
    """All customers numbered after all keys of the first load."""
    incoming = store.customers("customer").select("customer_id", "phone")
    return keys.continue_key(incoming, store.day1, "customer_key", "customer_id")


@query
def dense_key(store: Store) -> DataFrame:
    """Invoice lines numbered in key order, in slices of a tenth of the default."""
    lines = store.roles["invoiceline"].select("InvoiceLineId", "TrackId", "Quantity")
    order = ["TrackId", "InvoiceLineId"]
    return keys.dense_key(lines, "line_key", order, rows_per_slice=keys.ROWS_PER_SLICE // 10)


# --- scalar functions ------------------------------------------------------------


@query
def scalar_dates(store: Store) -> DataFrame:
    shipped = store.roles.base("lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("full_date")
    )
    return shipped.withColumns(date_parts("full_date"))


@query
def scalar_strings(store: Store) -> DataFrame:
    return store.roles["customer"].select(
        "CustomerId",
        F.trim("Email").alias("trimmed"),
        F.lower("Email").alias("lowered"),
        F.concat_ws(" ", "FirstName", "Company", "State").alias("joined"),
    )


@query
def scalar_json(store: Store) -> DataFrame:
    """JSON of an array without its NULLs and of a struct."""
    parts = F.array_compact(F.array("Company", "State", "Fax"))
    return store.roles["customer"].select(
        "CustomerId",
        F.to_json(parts).alias("parts"),
        F.to_json(F.struct("CustomerId", "Address", "SupportRepId")).alias("record"),
    )


@query
def scalar_conditional(store: Store) -> DataFrame:
    total, customer = F.col("Total"), F.col("CustomerId")
    return store.roles["invoice"].select(
        "InvoiceId",
        customer.isNull().alias("is_anonymous"),
        F.coalesce(customer, F.lit(0)).alias("customer_or_zero"),
        F.when(total < 0, "credit").when(total == 0, "empty").otherwise("sale").alias("kind"),
        (total != 0).cast("int").alias("counts"),
        F.col("BillingCountry").isin("ASIA", "EUROPE").cast("boolean").alias("is_overseas"),
        F.col("InvoiceDate").cast("date").alias("invoice_day"),
        F.lit(None).cast("date").alias("closed_on"),
    )


# --- contracts -------------------------------------------------------------------


@query
def conform_fact(store: Store) -> DataFrame:
    return store.gold("fact_sales")


def _checks(store: Store, check: Callable) -> DataFrame:
    """One contract check over all Gold tables, as one frame."""
    known = settings.contracts()
    store.write_gold(*[n for n in known if n.startswith("dim")])
    return reduce(
        DataFrame.unionByName, [check(store.gold(name), known[name]) for name in known]
    )


@query
def contract_not_null(store: Store) -> DataFrame:
    return _checks(store, contracts.not_null)


@query
def contract_length(store: Store) -> DataFrame:
    return _checks(store, contracts.max_length)


@query
def contract_pk(store: Store) -> DataFrame:
    """Repeated primary keys; the line table is checked on its track to have some."""

    def repeated(df: DataFrame, name: str, key: str) -> DataFrame:
        return contracts.duplicates(df, [key]).select(
            F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key"), "rows"
        )

    gold = _checks(store, lambda df, contract: repeated(df, contract.name, *contract.primary_key))
    return gold.unionByName(repeated(store.roles["invoiceline"], "invoiceline", "TrackId"))


@query
def contract_fk(store: Store) -> DataFrame:
    """Keys without a parent row, over all references of the Gold tables."""
    known = settings.contracts()
    store.write_gold(*[n for n in known if n.startswith("dim")])
    parts = [
        contracts.foreign_keys(
            store.gold(name),
            contract,
            {r.parent: store.gold(r.parent) for r in contract.references},
        ).withColumn("table_name", F.lit(name))
        for name, contract in known.items()
        if contract.references
    ]
    # invoices of customers who have left the source, so that some rows are found
    left = contracts.Reference("CustomerId", "customer", "CustomerId")
    orphans = contracts.foreign_key(store.roles["invoice"], store.roles["customer_day2"], left)
    parts.append(
        orphans.select(
            F.lit("invoice").alias("table_name"),
            F.lit("CustomerId").alias("column_name"),
            F.col("missing_key").cast("bigint").alias("missing_key"),
            "rows",
        )
    )
    return reduce(DataFrame.unionByName, parts)


# --- keyed changes ---------------------------------------------------------------


@query
def changes_insert(store: Store) -> DataFrame:
    """Customers missing on day 1 sign up and are given the next ids."""
    table = store.roles["customer_day1"]
    rows = store.roles["customer_day2"].join(table.select("CustomerId"), "CustomerId", "left_anti")
    rows = rows.drop("CustomerId", "Fax")
    return changes.insert_rows(table, rows, "CustomerId", "Phone")


@query
def changes_patch(store: Store) -> DataFrame:
    """Customers take over company and state; a cleared state becomes NULL."""
    patches = store.roles["customer_day2"].select(
        "CustomerId",
        "Company",
        "State",
        (F.col("Company") == "Updated Corp").alias("set_Company"),
        (F.col("State").isNull() | (F.col("State") == "Filled")).alias("set_State"),
    )
    return changes.patch(
        store.roles["customer"], patches, "CustomerId", ["Company", "State"]
    )


@query
def changes_patch_in(store: Store) -> DataFrame:
    """Lines that sold nothing get a price and a quantity."""
    lines = store.roles["invoiceline"]
    empty = lines.filter("Quantity = 0").select("InvoiceLineId")
    return changes.patch_in(lines, empty, "InvoiceLineId", {"UnitPrice": 2.99, "Quantity": 2})


@query
def verify_dump(store: Store) -> DataFrame:
    return store.gold("dim_customer")


@query
def verify_count(store: Store) -> DataFrame:
    return store.gold("dim_customer").agg(F.count(F.lit(1)).alias("rows"))
