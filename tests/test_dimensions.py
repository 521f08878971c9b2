"""Keys of a dimension that is built again."""

import pytest

from tributary.operators import dimensions

MAPPING = {"id": "Id", "name": "Name"}


def build(spark, rows, present=None):
    df = spark.createDataFrame(rows, "Id int, Name string")
    return dimensions.build(df, MAPPING, "id", "k", present)


def rows(df):
    return sorted(map(tuple, df.select("k", "id", "name").collect()), key=str)


def test_new_ids_move_no_key(spark):
    first = build(spark, [(5, "e"), (9, "i"), (7, "g")])
    assert rows(first) == [(1, 5, "e"), (2, 7, "g"), (3, 9, "i")]
    again = build(spark, [(9, "I"), (1, "a"), (6, "f"), (5, "e")], first)
    assert rows(again) == [(1, 5, "e"), (3, 9, "I"), (4, 1, "a"), (5, 6, "f")]
    assert again.columns == ["k", "id", "name"]


def test_unchanged_rows_keep_their_keys(spark):
    data = [(i * 3 % 50, str(i)) for i in range(50)]
    first = build(spark, data)
    assert rows(build(spark, data[::-1], first)) == rows(first)


@pytest.mark.parametrize("present", [[], [(None, "x")], [(1, "a"), (1, "b")]])
def test_ids_that_say_nothing_are_numbered_anew(spark, present):
    first = build(spark, present)
    again = build(spark, [(None, "x"), (None, "y"), (1, "a"), (1, "c")], first)
    keys = sorted(k for k, *_ in rows(again))
    assert keys == [len(present) + i for i in (1, 2, 3, 4)]


def test_of_nothing(spark):
    first = build(spark, [(1, "a")])
    assert rows(build(spark, [], first)) == []
