"""Merkle audit against a direct comparison."""

import pytest

from tributary.llm import fixity

COLUMNS = "page_id long, url string, html string"


def audit(spark, left, right, **sizes):
    a, b = (spark.createDataFrame(x, COLUMNS).selectExpr("*", "1 as node", "2 as digest") for x in (left, right))
    rows = fixity.audit(a, b, **sizes).collect()
    assert len({(r.page_id, r.url) for r in rows}) == len(rows)
    return rows


@pytest.mark.parametrize("fanout", [2, 16])
def test_damage_is_located(spark, fanout):
    good = [(i, f"u{i}", "text" * (i % 5)) for i in range(200)] + [(None, None, None), (3, None, "x")]
    good += [(500, "twice", "one"), (500, "twice", "one"), (501, "twice", "one"), (501, "twice", "two")]
    bad = [r for r in good if r[0] not in (17, 18, 150)]
    bad = [(i, u, "changed") if i in (0, 90, 199) else (i, u, h) for i, u, h in bad]
    bad.remove((500, "twice", "one"))
    bad += [(900, "new", "y")]
    rows = audit(spark, good, bad, fanout=fanout, file_records=10)
    status = {(r.page_id, r.url): r.status for r in rows}
    odd = {k: v for k, v in status.items() if v != "ok"}
    assert odd == {(17, "u17"): "missing", (18, "u18"): "missing", (150, "u150"): "missing",
                   (0, "u0"): "corrupt", (90, "u90"): "corrupt", (199, "u199"): "corrupt",
                   (500, "twice"): "corrupt", (900, "new"): "extra"}
    assert len(rows) == len({r[:2] for r in good}) + 1
    placed = sorted((r for r in rows if r.number is not None), key=lambda r: r.number)
    assert [r.number for r in placed] == list(range(len(placed)))
    at = {}
    for r in placed:
        assert r.file == r.number // 10 and r["offset"] == at.get(r.file, 0)
        at[r.file] = r["offset"] + r.length


def test_equal_and_empty(spark):
    good = [(i, f"u{i}", "x") for i in range(20)]
    assert {r.status for r in audit(spark, good, good[::-1])} == {"ok"}
    assert {r.status for r in audit(spark, good, [])} == {"missing"}
    assert {r.status for r in audit(spark, [], good)} == {"extra"}
    assert audit(spark, [], []) == []
