import os
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary import session
from tributary.sources import registry, relational, runlog, snapshots
from tributary.sources.tables import Lake

DAY = dt.date(2024, 1, 1)
AT = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


def test_registry_seed_is_idempotent(spark):
    seed = registry.entries(spark, [("A", "a.csv"), ("B", "b.csv")], DAY)
    old = registry.entries(spark, [("B", "old.csv")], DAY).withColumn("active_flag", F.lit("N"))
    once = registry.insert_if_absent(old, seed)
    assert sorted((r[0], r[1], r[2]) for r in once.collect()) == [
        ("A", "a.csv", "Y"),
        ("B", "old.csv", "N"),
    ]
    assert registry.missing(seed, once).count() == 0
    assert [tuple(r) for r in registry.active(once).collect()] == [("A", "a.csv")]


def runs(spark, rows):
    return runlog.to_frame(
        spark, [runlog.Run(t, at, s, 5, 5, loc, at.date()) for t, at, s, loc in rows]
    )


def test_latest_success(spark):
    late = AT + dt.timedelta(hours=1)
    log = runs(
        spark,
        [
            ("a", AT, "SUCCESS", "a1"),
            ("a", late, "FAILED", "a2"),
            ("b", late, "SUCCESS", "b2"),
            ("b", late, "SUCCESS", "b3"),
            ("b", AT, "SUCCESS", "b9"),
            ("c", AT, "FAILED", "c1"),
        ],
    )
    newest = {r["table_name"]: r["file_location"] for r in runlog.latest_success(log).collect()}
    assert newest == {"a": "a1", "b": "b3"}
    active = registry.entries(spark, [("b", "b.csv")], DAY)
    assert [r[0] for r in runlog.latest_success(log, active).collect()] == ["b"]


def test_failures_are_named():
    good = runlog.Run("a", AT, "SUCCESS", 1, 1, "", DAY)
    runlog.raise_on_failure([good])
    with pytest.raises(RuntimeError, match="'b', 'c'"):
        runlog.raise_on_failure(
            [runlog.Run(t, AT, "FAILED", 1, 0, "", DAY) for t in ("b", "c")] + [good]
        )


def test_snapshot_path_is_in_utc():
    berlin = dt.datetime(2024, 1, 1, 0, 30, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    assert (
        snapshots.location("/raw/", "InvoiceLine", berlin)
        == "/raw/invoiceline/2023/12/31/invoiceline_20231231_233000.parquet"
    )


def test_snapshots_are_never_overwritten(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert snapshots.reconcile(spark.range(10), path) == (10, 10)
    with pytest.raises(Exception, match="already exists"):
        snapshots.write(spark.range(3), path)
    assert snapshots.read(spark, path).count() == 10


def test_empty_snapshot(spark, tmp_path):
    empty = spark.createDataFrame([], "a int")
    assert snapshots.reconcile(empty, str(tmp_path / "e.parquet")) == (0, 0)


def test_lost_rows_are_noticed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "read", lambda spark, path: spark.range(9))
    with pytest.raises(snapshots.CountMismatch, match="source 10, target 9"):
        snapshots.reconcile(spark.range(10), str(tmp_path / "t.parquet"))


def test_readiness(spark):
    spark.range(3).createOrReplaceTempView("ready_table")
    source = relational.CatalogSource("")
    assert relational.check_ready(spark, source, ["ready_table"]) == ["ready_table"]
    with pytest.raises(RuntimeError, match="absent_a.*absent_b"):
        relational.check_ready(spark, source, ["absent_a", "ready_table", "absent_b"])
    with pytest.raises(RuntimeError, match="no active tables"):
        relational.check_ready(spark, source, [])


def test_jdbc_options():
    """Only the options: no database is started for a test."""
    source = relational.JdbcSource(
        "jdbc:x://host/db", "shop", {"user": "u"}, {"Invoice": "InvoiceId"}, range_per_task=125
    )
    assert source.options("Artist") == {
        "user": "u",
        "url": "jdbc:x://host/db",
        "dbtable": "shop.Artist",
        "fetchsize": "10000",
    }
    split = source.options("Invoice", (1, 1000))
    assert split["partitionColumn"] == "InvoiceId"
    assert (split["lowerBound"], split["upperBound"]) == ("1", "1001")
    assert split["numPartitions"] == "8"
    assert source.options("Invoice", (5, 5))["numPartitions"] == "1"
    assert source.options("Invoice", (1, 10_000_000))["numPartitions"] == "80000"
    assert source.bounds_query("Invoice") == (
        "select min(InvoiceId) as lo, max(InvoiceId) as hi from shop.Invoice"
    )


def test_jdbc_tables_are_never_read_by_one_task_unasked(spark):
    source = relational.JdbcSource("jdbc:x://host/db", "shop", split_on={"Invoice": "InvoiceId"})
    with pytest.raises(ValueError, match="Artist needs a split column"):
        source.read(spark, "Artist")


@pytest.fixture(params=["parquet", "orc"])
def lake(spark, tmp_path, request):
    lake = Lake(spark, str(tmp_path), request.param, gold="gold_test")
    spark.sql(f"create schema if not exists {lake.gold}")
    yield lake
    spark.sql(f"drop schema {lake.gold} cascade")


def test_table_can_be_replaced_by_a_query_on_itself(spark, lake):
    name = f"{lake.gold}.t"
    assert not lake.exists(name)
    assert lake.replace(spark.range(5), name) == 5
    assert lake.replace(lake.read(name).filter("id > 1"), name) == 3
    assert sorted(r["id"] for r in lake.read(name).collect()) == [2, 3, 4]


def test_failed_replace_changes_nothing(spark, lake):
    name = f"{lake.gold}.t"
    lake.replace(spark.range(5), name)
    with pytest.raises(Exception, match="boom"):
        lake.replace(spark.range(9).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), name)
    assert lake.read(name).count() == 5


def test_replace_takes_a_new_schema(spark, lake):
    name = f"{lake.gold}.t"
    lake.replace(spark.range(5), name)
    lake.replace(spark.sql("select 'x' a, cast(1 as decimal(5,2)) b"), name)
    assert lake.read(name).dtypes == [("a", "string"), ("b", "decimal(5,2)")]


def test_replace_with_nothing(spark, lake):
    name = f"{lake.gold}.t"
    assert lake.replace(spark.createDataFrame([], "a int"), name) == 0
    assert lake.read(name).count() == 0


def test_ensure_keeps_rows_and_append_adds(spark, lake):
    name = f"{lake.gold}.log"
    lake.ensure(name, "id bigint")
    lake.append(spark.range(2), name)
    lake.ensure(name, "id bigint")
    lake.append(spark.range(3), name)
    assert lake.read(name).count() == 5


def test_shared_folder(spark, monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, name, default):
            assert name == "spark.checkpoint.dir"
            return self.value

    class Context:
        applicationId = "app"

        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        def __init__(self, configured, master):
            self.conf, self.sparkContext = Conf(configured), Context(master)

    assert session.shared_dir(Session("hdfs://data/shared/", "yarn")) == "hdfs://data/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(None, "yarn"))
    own = session.shared_dir(Session(None, "local[2]"))
    assert own == session.shared_dir(Session(None, "local[2]"))


@pytest.mark.parametrize("condition", ["id < 3", "true", "false"])
def test_flagged_rows_are_kept_out_of_the_table(spark, lake, condition):
    name = f"{lake.gold}.t"
    df = spark.range(10).selectExpr("id", "concat('r', id) why", f"{condition} bad")
    image, flagged = lake.image_unflagged(df, name, "bad", ["id"])
    lake.swap(image, name)
    expected = df.filter(condition).count()
    assert lake.read(name).columns == ["id"]
    assert lake.read(name).count() == 10 - expected
    assert (flagged.count() if flagged else 0) == expected
    assert flagged is None or flagged.columns == ["why"]


def test_staged_folders_are_deleted_on_request(spark):
    from tributary import session

    session.drop_staged(spark)
    staged = session.stage(spark.range(3), "test")
    folder = staged.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    assert session.drop_staged(spark) == 1 and not os.path.exists(folder)
    assert session.drop_staged(spark) == 0
