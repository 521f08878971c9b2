"""Tables in partitions of their own places: what a merge writes, and what a crash leaves."""

import datetime as dt
import os
from pathlib import Path
from urllib.parse import urlparse

import pytest

from tributary.operators import scd2
from tributary.sources.tables import NEXT, Lake

D = [dt.date(2024, m, 1) for m in range(1, 7)]
SPEC = scd2.Versioned("key", "id", ("city",))
BY = (scd2.END, scd2.CURRENT)


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), gold="parts")
    spark.sql(f"create schema if not exists parts location '{tmp_path}/lake/parts'")
    yield lake
    spark.sql("drop schema parts cascade")


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "id int, city string")


def merge(lake, rows, day, name="parts.dim"):
    """One merge that leaves closed partitions as they lie."""
    incoming = snapshot(lake.spark, rows)
    parts = lake.parts(name)
    if not lake.exists(name):
        made = scd2.initial(incoming, SPEC, day)
    else:
        made = (scd2.touched if parts else scd2.apply)(lake.read(name), incoming, SPEC, day)
    past = {v: p for v, p in parts.items() if v[1] != "true"}
    image = lake.part_image(made, name, BY, past)
    assert sorted(map(tuple, image.df.collect()), key=str) == sorted(
        map(tuple, image.df.select(*SPEC.columns).collect()), key=str
    )
    return image


def shown(lake, name="parts.dim"):
    return sorted((tuple(r) for r in lake.read(name).collect()), key=lambda r: r[0])


def files(place):
    return {f: (os.stat(f).st_mtime_ns, os.stat(f).st_ino) for f in Path(urlparse(place).path).glob("*.parquet")}


DAYS = [
    [(1, "a"), (2, "b"), (3, "c")],
    [(1, "x"), (2, "b"), (3, "c"), (4, "d")],
    [(1, "x"), (2, "y"), (4, "d")],
    [(1, "z"), (2, "y"), (3, "q"), (4, "d")],
]


def whole(spark, days):
    """The same merges over whole images."""
    from tributary.session import stage

    dim = stage(scd2.initial(snapshot(spark, days[0]), SPEC, D[0]), "test")
    for rows, day in zip(days[1:], D[1:]):
        dim = stage(scd2.apply(dim, snapshot(spark, rows), SPEC, day), "test")
    return sorted((tuple(r) for r in dim.collect()), key=lambda r: r[0])


def test_closed_history_stays_where_it_is(spark, lake):
    seen = {}
    for number, (rows, day) in enumerate(zip(DAYS, D)):
        image = merge(lake, rows, day)
        lake.swap_parts(image, "parts.dim")
        assert shown(lake) == whole(spark, DAYS[: number + 1])
        assert lake.read("parts.dim").columns == SPEC.columns
        places = lake.parts("parts.dim")
        for values, (place, found) in seen.items():
            assert places[values] == place and files(place) == found  # name, time and inode
        seen = {v: (p, files(p)) for v, p in places.items() if v[1] == "false"}
    assert set(lake.parts("parts.dim")) == {
        (None, "true"), ("2024-02-01", "false"), ("2024-03-01", "false"), ("2024-04-01", "false"),
    }
    scan = scd2.current(lake.read("parts.dim"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in scan


def test_second_merge_of_a_day_joins_its_partition(spark, lake):
    for rows, day in ((DAYS[0], D[0]), (DAYS[1], D[1]), ([(1, "again"), (2, "late"), (3, "c"), (4, "d")], D[1])):
        lake.swap_parts(merge(lake, rows, day), "parts.dim")
    closed = [r for r in shown(lake) if not r[-1]]
    assert [(r[1], r[2], r[3], r[4]) for r in closed] == [
        (1, "a", D[0], D[1]), (2, "b", D[0], D[1]), (1, "x", D[1], D[1]),
    ]
    assert set(lake.parts("parts.dim")) == {(None, "true"), ("2024-02-01", "false")}


def test_plain_table_moves_into_partitions(spark, lake):
    lake.replace(scd2.initial(snapshot(spark, DAYS[0]), SPEC, D[0]), "parts.dim")
    assert lake.parts("parts.dim") == {}
    lake.swap_parts(merge(lake, DAYS[1], D[1]), "parts.dim")
    assert shown(lake) == whole(spark, DAYS[:2]) and len(lake.parts("parts.dim")) == 2


def test_empty_first_snapshot(spark, lake):
    lake.swap_parts(merge(lake, [], D[0]), "parts.dim")
    assert shown(lake) == []
    lake.swap_parts(merge(lake, DAYS[0], D[1]), "parts.dim")
    assert [r[:3] for r in shown(lake)] == [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]


@pytest.mark.parametrize("broken", ["create table", "alter table parts.dim__next add", "drop table if exists parts.dim", "alter table parts.dim__next rename"])
def test_a_crash_leaves_one_whole_table(spark, lake, monkeypatch, broken):
    lake.swap_parts(merge(lake, DAYS[0], D[0]), "parts.dim")
    before = shown(lake)
    image = merge(lake, DAYS[1], D[1])
    real = type(spark).sql

    def failing(self, text, *args, **options):
        if text.startswith(broken) and not text.startswith("drop table if exists parts.dim" + NEXT):
            raise RuntimeError("crash")
        return real(self, text, *args, **options)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        lake.swap_parts(image, "parts.dim")
    monkeypatch.undo()
    assert lake.exists("parts.dim")
    assert shown(lake) == (whole(spark, DAYS[:2]) if "rename" in broken else before)
    if "rename" not in broken:  # the run is repeated
        lake.swap_parts(merge(lake, DAYS[1], D[1]), "parts.dim")
        assert shown(lake) == whole(spark, DAYS[:2])


def test_odd_partition_values(spark, lake):
    rows = spark.createDataFrame([(1, "a/b='c'"), (2, None), (3, "x y%z\\")], "n int, kind string")
    lake.swap_parts(lake.part_image(rows, "parts.odd", ("kind",)), "parts.odd")
    assert sorted(map(tuple, lake.read("parts.odd").collect())) == sorted(map(tuple, rows.collect()))
    assert set(lake.parts("parts.odd")) == {("a/b='c'",), (None,), ("x y%z\\",)}
    kept = {v: p for v, p in lake.parts("parts.odd").items() if v != (None,)}
    image = lake.part_image(spark.createDataFrame([(9, None), (7, "x y%z\\")], rows.schema), "parts.odd", ("kind",), kept)
    lake.swap_parts(image, "parts.odd")
    found = sorted((r.n, r.kind) for r in lake.read("parts.odd").collect())
    assert found == [(1, "a/b='c'"), (3, "x y%z\\"), (7, "x y%z\\"), (9, None)]
    with pytest.raises(ValueError):
        lake.part_image(rows, "parts.odd", ("n",))
