"""Fingerprints and differences of snapshots."""

import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import comparison, scd2
from tributary.sources import snapshots
from test_scd2 import D1, D2, D3, SPEC, image, snapshot

ROWS = [(1, "a", 1.5, [1, None]), (2, None, None, None), (2, None, None, None), (3, "", -0.5, [])]
SCHEMA = "id int, name string, x double, list array<int>"


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def test_order_and_files_do_not_matter(spark):
    one = comparison.fingerprint(frame(spark))
    rows = list(ROWS)
    random.Random(1).shuffle(rows)
    assert comparison.fingerprint(frame(spark, rows).repartition(4)) == one
    assert comparison.fingerprint(frame(spark, [])).rows == 0


@pytest.mark.parametrize(
    "rows, columns",
    [
        (ROWS[:-1] + [(3, None, -0.5, [])], ["name"]),  # blank and NULL
        (ROWS[:1] + ROWS[2:] + [(2, None, None, [None])], ["list"]),
        ([(1, "", 1.5, [1, None]), *ROWS[1:3], (3, "a", -0.5, [])], []),  # values change places
        (ROWS[:2] + [ROWS[0], ROWS[3]], ["id", "name", "x", "list"]),  # another copy, as many rows
    ],
)
def test_every_other_value_shows(spark, rows, columns):
    one, two = comparison.fingerprint(frame(spark)), comparison.fingerprint(frame(spark, rows))
    assert one.rows == two.rows and one != two
    assert one.differing(two) == columns


def test_nulls_do_not_slide_between_columns(spark):
    left = spark.createDataFrame([("a", None)], "x string, y string")
    right = spark.createDataFrame([(None, "a")], "x string, y string")
    assert comparison.fingerprint(left) != comparison.fingerprint(right)


def test_snapshot_is_compared_by_content(spark, tmp_path, monkeypatch):
    df = frame(spark)
    assert snapshots.reconcile_content(df, str(tmp_path / "a.parquet")).rows == 4
    swapped = [(1, "", 1.5, [1, None]), *ROWS[1:3], (3, "a", -0.5, [])]
    monkeypatch.setattr(snapshots, "read", lambda spark, path: frame(spark, swapped))
    with pytest.raises(snapshots.ContentMismatch, match="moved between rows"):
        snapshots.reconcile_content(df, str(tmp_path / "b.parquet"))
    monkeypatch.setattr(snapshots, "read", lambda spark, path: df.withColumn("name", F.lit("z")))
    with pytest.raises(snapshots.ContentMismatch, match="name"):
        snapshots.reconcile_content(df, str(tmp_path / "c.parquet"))
    monkeypatch.setattr(snapshots, "read", lambda spark, path: df.limit(3))
    with pytest.raises(snapshots.CountMismatch):
        snapshots.reconcile_content(df, str(tmp_path / "d.parquet"))


def test_differences(spark):
    before = [(1, "a"), (2, "b"), (3, None), (4, "d"), (5, "x"), (5, "y"), (6, "x"), (6, "x"), (None, "n"), (7, "q")]
    after = [(1, "a"), (2, "c"), (3, ""), (8, "d"), (5, "y"), (5, "x"), (6, "x"), (None, "n"), (7, "q"), (7, "q")]
    one, two = (spark.createDataFrame(r, "id int, name string") for r in (before, after))
    found = {r.id: (r.change, r.rows_before, r.rows_after) for r in comparison.differences(one, two, "id").collect()}
    assert found == {
        1: ("unchanged", 1, 1), 2: ("changed", 1, 1), 3: ("changed", 1, 1), 4: ("removed", 1, 0),
        5: ("unchanged", 2, 2), 6: ("changed", 2, 1), 7: ("changed", 1, 2), 8: ("added", 0, 1), None: ("unchanged", 1, 1),
    }
    moved = comparison.differences(one, two.select("name", "id"), "id", with_unchanged=False)
    assert sorted(r.id for r in moved.collect()) == [2, 3, 4, 6, 7, 8]
    wider = comparison.differences(one, two.withColumn("more", F.lit(None).cast("int")), "id")
    assert {r.change for r in wider.filter("rows_before = 1 and rows_after = 1").collect()} == {"changed"}


def test_only_ids_and_hashes_are_moved(spark):
    wide = spark.range(10).select("id", *(F.lit("x").alias(f"c{i}") for i in range(9)))
    plan = comparison.differences(wide, wide, "id")._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        assert "Exchange" not in line or "c1" not in line


def test_merge_by_difference_is_the_merge(spark, monkeypatch):
    days = [
        [(10, "Rome", "a"), (20, None, "b"), (30, "Bonn", "c"), (None, "x", "y")],
        [(10, "Nice", "a"), (30, "Bonn", "c"), (5, "new", None)],
        [(10, "Nice", "a"), (20, None, "b"), (30, None, "c"), (5, "new", "x")],
    ]
    from tributary.session import stage

    dim = whole = stage(scd2.initial(snapshot(spark, days[0]), SPEC, D1), "test")
    for before, after, day in zip(days, days[1:], (D2, D3)):
        now = scd2.touched_since(dim, snapshot(spark, before), snapshot(spark, after), SPEC, day)
        dim = stage(scd2.closed(dim).unionByName(now), "test")
        whole = stage(scd2.apply(whole, snapshot(spark, after), SPEC, day), "test")
        assert image(dim) == image(whole)

    def no_join(*_, **__):
        raise AssertionError("attributes are joined")

    monkeypatch.setattr(scd2, "touched", no_join)
    again = scd2.touched_since(dim, snapshot(spark, days[2]), snapshot(spark, days[2]), SPEC, D3)
    assert image(scd2.closed(dim).unionByName(again)) == image(dim)
