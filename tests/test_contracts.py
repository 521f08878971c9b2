from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tributary.operators import contracts
from tributary.operators.contracts import Contract, Reference
from tributary.plans import settings

THINGS = Contract(
    "things",
    T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("name", T.StringType(), False),
            T.StructField("price", T.DecimalType(4, 2), True),
        ]
    ),
    ("id",),
    {"name": 3},
    (Reference("id", "parents", "parent_id"),),
)


def test_conform_orders_and_casts(spark):
    df = spark.createDataFrame([("a", 1, Decimal("1.005"), True)], "name string, id bigint, price decimal(10,3), x boolean")
    result = contracts.conform(df, THINGS)
    assert [(f.name, f.dataType.simpleString()) for f in result.schema] == [
        ("id", "int"), ("name", "string"), ("price", "decimal(4,2)"),
    ]
    assert tuple(result.first()) == (1, "a", Decimal("1.01"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_conform_raises_on_overflow_in_any_mode(spark, ansi):
    df = spark.createDataFrame([(1, "a", Decimal("100.00"))], "id int, name string, price decimal(9,2)")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="things.price cannot hold 100.00"):
            contracts.conform(df, THINGS).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_conform_names_missing_columns(spark):
    with pytest.raises(ValueError, match="price"):
        contracts.conform(spark.createDataFrame([(1, "a")], "id int, name string"), THINGS)


def test_reports(spark):
    df = spark.createDataFrame(
        [(1, "abc", None), (1, "abcd", None), (None, None, None), (2, "é€😀", None)],
        "id int, name string, price decimal(4,2)",
    )
    nulls = {r["column_name"]: r["violations"] for r in contracts.not_null(df, THINGS).collect()}
    assert nulls == {"id": 1, "name": 1}
    assert [r["violations"] for r in contracts.max_length(df, THINGS).collect()] == [1]
    assert [tuple(r) for r in contracts.primary_key(df, THINGS).collect()] == [(1, 2)]
    parents = spark.createDataFrame([(2,)], "parent_id int")
    orphans = contracts.foreign_key(df, parents, THINGS.references[0])
    assert [tuple(r) for r in orphans.collect()] == [(1, 2)]  # the NULL key is allowed


def test_hot_orphan_is_one_row_before_the_join(spark):
    df = spark.range(1000).selectExpr("int(5) id", "'x' name")
    parents = spark.createDataFrame([(2,)], "parent_id int")
    orphans = contracts.foreign_key(df, parents, THINGS.references[0])
    assert [tuple(r) for r in orphans.collect()] == [(5, 1000)]
    plan = orphans._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Aggregate")


def test_gold_contracts():
    known = settings.contracts()
    assert len(known) == 11
    assert all(len(c.primary_key) == 1 for c in known.values())
    references = [(n, r.column, r.parent) for n, c in known.items() for r in c.references]
    assert len(references) == 9
    for _, column, parent in references:
        assert parent in known, column


def test_all_references_from_one_scan(spark):
    """Keys of all columns meet their own parents only; NULL keys are allowed."""
    df = spark.createDataFrame([(1, 7, "a"), (1, 8, "a"), (2, None, "b"), (None, 1, "c")], "x int, y bigint, z string")
    contract = Contract(
        "child", T.StructType([]), ("x",), {}, (Reference("x", "p", "id"), Reference("y", "q", "id")),
    )
    parents = {"p": spark.createDataFrame([(7,), (2,)], "id int"), "q": spark.createDataFrame([(1,), (1,)], "id int")}
    orphans = contracts.foreign_keys(df, contract, parents)
    assert sorted(map(tuple, orphans.select("column_name", "missing_key", "rows").collect())) == [
        ("x", 1, 2), ("y", 7, 1), ("y", 8, 1),
    ]
    counted = contracts.reference_counts(df, contract, parents)
    assert [tuple(r) for r in counted.collect()] == [("child", "x", "foreign_key", 2), ("child", "y", "foreign_key", 2)]
    texts = Contract("child", T.StructType([]), ("x",), {}, (Reference("z", "r", "id"), Reference("x", "p", "id")))
    parents["r"] = spark.createDataFrame([("a",), ("c",)], "id string")
    orphans = contracts.foreign_keys(df, texts, parents)
    assert sorted(map(tuple, orphans.select("column_name", "missing_key", "rows").collect())) == [
        ("x", "1", 2), ("z", "b", 1),
    ]


def test_values_are_counted_in_one_scan(spark):
    df = spark.createDataFrame([(1, "abcd", None), (None, None, None)], "id int, name string, price decimal(9,2)")
    report = contracts.values(df, THINGS)
    assert {(r["column_name"], r["check"]): r["violations"] for r in report.collect()} == {
        ("id", "not_null"): 1, ("name", "not_null"): 1, ("name", "max_length"): 1, ("price", "type"): 0,
    }
    assert [tuple(r) for r in contracts.key_counts(df.unionByName(df), THINGS).collect()] == [
        ("things", "id", "primary_key", 4)
    ]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("keys, dense", [
    (list(range(-50, 70_000)), True),
    (list(range(1, 70_001)) + [5, 5, 40_000], True),
    ([None, None, *range(10), 3], True),
    ([i * 1_000_003 for i in range(100)] + [0], False),  # too sparse for bitmaps
    ([None], False),
    ([], False),
])
def test_repeated_keys_by_bitmaps(spark, monkeypatch, keys, dense):
    monkeypatch.setattr(contracts, "BITMAP_ROWS", 1)
    df = spark.createDataFrame([(k,) for k in keys], "id bigint").repartition(3)
    assert (contracts._range(df, "id") is not None) == dense
    found = contracts.duplicates(df, ["id"])
    assert rows_of(found) == rows_of(df.groupBy("id").count().filter("count > 1"))
    assert found.dtypes == [("id", "bigint"), ("rows", "bigint")]


def test_only_rows_near_a_repetition_are_moved(spark, monkeypatch):
    monkeypatch.setattr(contracts, "BITMAP_ROWS", 1)
    ids = spark.range(1, 300_001, 1, 4).withColumnRenamed("id", "key")
    clean = contracts._suspects(ids, "key")
    assert clean.count() == 0
    twice = ids.unionByName(ids.filter("key = 70000"))
    assert contracts._suspects(twice, "key").count() == 32_768 + 1
    assert rows_of(contracts.duplicates(twice, ["key"])) == [(70_000, 2)]


@pytest.mark.parametrize("extra", [[], [(0, 1), (200_001, 2)], [(50_000, 50_000)], [(-5, None), (2**40, 3)], [(None, None)]])
def test_missing_parents_by_bitmaps(spark, extra):
    """Keys outside the parent's range, in its holes, and in places that the other parent fills."""
    p = spark.range(1, 200_001).filter("id <> 50000").selectExpr("cast(id as int) as id")
    q = spark.range(1, 100_001).filter("id % 3 <> 0")
    child = spark.range(1, 200_001).filter("id <> 50000").selectExpr("id as x", "case when id % 3 <> 0 and id <= 100000 then id end as y")
    child = child.unionByName(spark.createDataFrame(extra, "x bigint, y bigint"))
    contract = Contract("child", T.StructType([]), ("x",), {}, (Reference("x", "p", "id"), Reference("y", "q", "id")))
    parents = {"p": p, "q": q}
    assert all(contracts._range(df, "id") for df in parents.values())
    found = contracts.foreign_keys(child, contract, parents)
    known = [set(r.id for r in df.collect()) for df in (p, q)]
    missing = [(c, k, 1) for row in extra for c, k, ids in zip("xy", row, known) if k is not None and k not in ids]
    assert rows_of(found.select("column_name", "missing_key", "rows")) == sorted(missing, key=str)


def test_child_without_orphans_is_read_once(spark, tmp_path):
    spark.range(1, 1001).selectExpr("id as x").write.parquet(f"{tmp_path}/child")
    child = spark.read.parquet(f"{tmp_path}/child")
    contract = Contract("child", T.StructType([]), ("x",), {}, (Reference("x", "p", "id"),))
    found = contracts.foreign_keys(child, contract, {"p": spark.range(1, 1001)})
    assert found._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation <empty>")
    assert found.count() == 0
