import pytest

from tributary.operators import changes


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "a", "x"), (2, "b", None), (7, "c", "z")]
    return spark.createDataFrame(rows, "id int, name string, city string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_continues_the_identity(spark, table):
    new = spark.createDataFrame([("n2",), ("n1",)], "name string")
    result = changes.insert_rows(table, new, "id", "name")
    assert result.schema == table.schema
    assert rows(result)[-2:] == [(8, "n1", None), (9, "n2", None)]


def test_insert_rejects_unknown_columns(spark, table):
    with pytest.raises(ValueError, match="colour"):
        changes.insert_rows(table, spark.createDataFrame([("r",)], "colour string"), "id", "colour")


def test_patch_sets_flagged_columns_even_to_null(spark, table):
    patch = spark.createDataFrame(
        [(1, "A", None, False, True), (2, None, "Y", True, True), (5, "no", "no", True, True)],
        "id int, name string, city string, set_name boolean, set_city boolean",
    )
    result = changes.patch(table, patch, "id", ["name", "city"])
    assert result.columns == table.columns
    assert rows(result) == [(1, "a", None), (2, None, "Y"), (7, "c", "z")]


def test_patch_without_flags_sets_every_match(spark, table):
    patch = spark.createDataFrame([(7, None)], "id int, city string")
    assert rows(changes.patch(table, patch, "id", ["city"]))[-1] == (7, "c", None)


def test_patch_with_repeated_keys_raises(spark, table):
    patch = spark.createDataFrame([(7, "a"), (7, "b")], "id int, city string")
    with pytest.raises(ValueError, match="7"):
        changes.patch(table, patch, "id", ["city"])


def test_patch_in_ignores_repeated_keys(spark, table):
    keys = spark.createDataFrame([(1,), (1,), (7,), (9,)], "id int")
    result = changes.patch_in(table, keys, "id", {"city": "set"})
    assert result.schema == table.schema
    assert rows(result) == [(1, "a", "set"), (2, "b", None), (7, "c", "set")]
