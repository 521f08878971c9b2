import datetime as dt
import random

import pytest

from tributary.operators import scd2
from tributary.session import stage

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
SPEC = scd2.Versioned("key", "id", ("city", "mail"))


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "id int, city string, mail string")


def image(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def merged(spark, dim, rows, day, **options):
    return stage(scd2.apply(dim, snapshot(spark, rows), SPEC, day, **options), "test")


@pytest.fixture
def first(spark):
    rows = [(10, "Rome", "a"), (20, None, "b"), (30, "Bonn", "c"), (40, "Oslo", None)]
    return stage(scd2.initial(snapshot(spark, rows), SPEC, D1), "test")


def test_first_load(first):
    assert image(first) == [
        (1, 10, "Rome", "a", D1, None, True),
        (2, 20, None, "b", D1, None, True),
        (3, 30, "Bonn", "c", D1, None, True),
        (4, 40, "Oslo", None, D1, None, True),
    ]


def test_merge(spark, first):
    """10 changes, 20 gains a city, 30 leaves, 40 is the same, 5 and 50 are new."""
    rows = [(10, "Nice", "a"), (20, "Bern", "b"), (40, "Oslo", None), (50, "x", "x"), (5, "y", "y")]
    assert image(merged(spark, first, rows, D2)) == [
        (1, 10, "Rome", "a", D1, D2, False),
        (2, 20, None, "b", D1, D2, False),
        (3, 30, "Bonn", "c", D1, None, True),
        (4, 40, "Oslo", None, D1, None, True),
        (5, 10, "Nice", "a", D2, None, True),
        (6, 20, "Bern", "b", D2, None, True),
        (7, 5, "y", "y", D2, None, True),
        (8, 50, "x", "x", D2, None, True),
    ]


def test_without_null_safety_changes_from_null_go_unseen(spark, first):
    rows = [(10, "Nice", "a"), (20, "Bern", "b"), (30, None, "c"), (40, "Oslo", "d")]
    seen = scd2.changed(first, snapshot(spark, rows), SPEC, null_safe=False)
    assert [r["id"] for r in seen.collect()] == [10]
    seen = scd2.changed(first, snapshot(spark, rows), SPEC)
    assert sorted(r["id"] for r in seen.collect()) == [10, 20, 30, 40]


def test_same_snapshot_adds_nothing(spark, first):
    rows = [(10, "Nice", "a"), (60, "new", None)]
    once = merged(spark, first, rows, D2)
    assert image(merged(spark, once, rows, D3)) == image(once)


def test_closed_history_passes_through(spark, first):
    second = merged(spark, first, [(10, "Nice", "a")], D2)
    third = merged(spark, second, [(10, "Lyon", "a")], D3)
    versions = [r for r in image(third) if r[1] == 10]
    assert [(r[2], r[4], r[5], r[6]) for r in versions] == [
        ("Rome", D1, D2, False),
        ("Nice", D2, D3, False),
        ("Lyon", D3, None, True),
    ]
    assert [r["city"] for r in scd2.as_of(third, D2).filter("id = 10").collect()] == ["Nice"]
    assert scd2.as_of(third, dt.date(2023, 1, 1)).count() == 0


def test_two_changes_on_one_day_leave_an_empty_interval(spark, first):
    same_day = merged(spark, first, [(10, "Nice", "a")], D1)
    assert (1, 10, "Rome", "a", D1, D1, False) in image(same_day)
    at = scd2.as_of(same_day, D1).filter("id = 10").collect()
    assert [r["city"] for r in at] == ["Nice"]


def test_id_known_only_from_closed_versions_is_not_new(spark, first):
    closed = stage(scd2.expire(first, first.filter("id = 10"), SPEC, D2), "test")
    rows = scd2.new_rows(closed, snapshot(spark, [(10, "Rome", "a"), (11, "z", "z")]), SPEC)
    assert [r["id"] for r in rows.collect()] == [11]


def test_repeated_ids_raise(spark, first):
    twice = [(10, "Nice", "a"), (10, "Lyon", "a")]
    with pytest.raises(ValueError, match="10"):
        merged(spark, first, twice, D2)
    with pytest.raises(ValueError, match="10"):
        scd2.initial(snapshot(spark, twice), SPEC, D1)
    unchecked = merged(spark, first, twice, D2, check_unique=False)
    assert len([r for r in image(unchecked) if r[1] == 10 and r[6]]) == 2


def test_rows_without_id_open_no_version(spark, first):
    assert image(merged(spark, first, [(None, "x", "y")], D2)) == image(first)


@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_python_merge(spark, seed):
    """Four random days compared with a row-by-row replay."""
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, "a", "b"])
    replay, dim = [], None
    for day in (dt.date(2024, 1, d) for d in range(1, 5)):
        rows = [(i, pick(), pick()) for i in sorted(rng.sample(range(40), 20))]
        if dim is None:
            dim = scd2.initial(snapshot(spark, rows), SPEC, day)
        else:
            dim = scd2.apply(dim, snapshot(spark, rows), SPEC, day)
        dim = stage(dim, "test")
        open_rows = {r["id"]: r for r in replay if r["end"] is None}
        again = [r for r in rows if r[0] in open_rows and open_rows[r[0]]["data"] != r[1:]]
        known = {r["id"] for r in replay}
        for id_, *_ in again:
            open_rows[id_]["end"] = day
        for id_, *data in again + [r for r in rows if r[0] not in known]:
            key = len(replay) + 1
            replay.append(dict(key=key, id=id_, data=tuple(data), start=day, end=None))
    assert image(dim) == [
        (r["key"], r["id"], *r["data"], r["start"], r["end"], r["end"] is None) for r in replay
    ]
    current = scd2.current(dim)
    assert current.count() == current.select("id").distinct().count()


def test_snapshot_is_shuffled_once(spark, first):
    """Both joins of a merge read one exchange of the incoming rows."""
    rows = snapshot(spark, [(i, "x", "y") for i in range(100)])
    incoming = stage(rows, "test").filter("id is not null")
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = [spark.conf.get(s) for s in settings]
    spark.conf.set(settings[0], "-1")
    spark.conf.set(settings[1], "false")
    try:
        both = scd2.changed_rows(first, incoming, SPEC).unionByName(
            scd2.new_rows(first, incoming, SPEC)
        )
        assert "ReusedExchange" in both._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in zip(settings, before):
            spark.conf.set(name, value)


def test_rows_without_an_id_open_no_version(spark):
    rows = [(None, "Rome", "a"), (None, "Bonn", "b"), (10, "Rome", "a")]
    dim = stage(scd2.initial(snapshot(spark, rows), SPEC, D1), "test")
    assert [r[1] for r in image(dim)] == [10]
    assert image(merged(spark, dim, rows, D2)) == image(dim)
