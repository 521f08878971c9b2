import datetime as dt

import pytest

from tributary.operators import cleaning
from tributary.plans import settings


def test_trim_leaves_other_types_and_tabs(spark):
    df = spark.createDataFrame([(1, "  a b ", "\tx ")], "id int, a string, b string")
    assert tuple(cleaning.trim_strings(df).first()) == (1, "a b", "\tx")


def test_defaults_replace_null_but_not_blank(spark):
    df = spark.createDataFrame([(None,), ("",)], "Company string")
    filled = df.transform(cleaning.defaults({"Company": "Individual"}))
    assert sorted(r["Company"] for r in filled.collect()) == ["", "Individual"]


def test_timestamps_strict_and_lenient(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",)], "at string")
    lenient = df.transform(cleaning.to_timestamps("at", strict=False)).collect()
    assert [r["at"] for r in lenient] == [dt.datetime(2024, 1, 2, 3, 4, 5), None]
    with pytest.raises(Exception, match="soon"):
        df.transform(cleaning.to_timestamps("at")).collect()


def test_customer_steps_run_after_the_trim(spark):
    rows = [("  A@B.Com ", None, "  "), (None, "Acme", None)]
    df = spark.createDataFrame(rows, "Email string, Company string, Fax string")
    cleaned = cleaning.clean(df, settings.CLEANING["customer"])
    assert [tuple(r) for r in cleaned.collect()] == [
        ("a@b.com", "Individual", ""),
        (None, "Acme", "N/A"),
    ]
