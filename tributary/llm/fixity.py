"""Fixity audit of archived records by Merkle trees.

Each replica hashes its records and, in the order of the manifest, ranges of them
into a tree. Two replicas are equal if their roots are; if not, only the children
of nodes that differ are looked at, level by level, down to the records.

The manifest gives each record its place: a number, a file, and the byte range in
it. Trees are built by grouping ``fanout`` nodes at a time, so no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from ..session import stage

FANOUT = 16
FILE_RECORDS = 4096  # records of one archive file
KEY = ("page_id", "url")
_GONE = "-"  # stands for a record that a replica lacks


def record(key: Sequence[str] = KEY, payload: str = "html") -> Column:
    """The record as archived: header lines, an empty line and the payload."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    fields = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:"),
        fields[0],
        F.lit(">\r\nWARC-Target-URI: "),
        fields[-1],
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def leaves(records: DataFrame, key: Sequence[str] = KEY, payload: str = "html") -> DataFrame:
    """One row a key: ``copies``, ``length`` in bytes, and ``digest``.

    Rows with equal keys, NULL ones included, are one leaf. Its digest combines their
    hashes by sums, which do not depend on an order and are added up before the shuffle.
    """
    hashed = records.select(
        *key,
        F.octet_length(record(key, payload)).cast("long").alias("_length"),
        F.sha2(record(key, payload), 256).alias("_hash"),
    )
    number = lambda at: F.conv(F.substring("_hash", at, 15), 16, 10).cast("decimal(20,0)")
    grouped = hashed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("copies"),
        F.sum("_length").alias("length"),
        *(F.sum(number(at)).cast("string").alias(f"_sum{at}") for at in (1, 16, 31, 46)),
    )
    sums = (F.col(f"_sum{at}") for at in (1, 16, 31, 46))
    return grouped.select(
        *key,
        "copies",
        "length",
        F.sha2(F.concat_ws(":", F.col("copies").cast("string"), *sums), 256).alias("digest"),
    )


def manifest(
    records: DataFrame, key: Sequence[str] = KEY, payload: str = "html", file_records: int = FILE_RECORDS
) -> DataFrame:
    """The leaves with their place: ``number`` from 0, ``file`` and ``offset`` in bytes."""
    numbered = dense_key(leaves(records, key, payload), "_number", list(key), start=-1)
    placed = numbered.withColumn("file", F.floor(F.col("_number") / file_records).cast("long"))
    before = Window.partitionBy("file").orderBy("_number")
    return placed.select(
        *key,
        F.col("_number").cast("long").alias("number"),
        "file",
        (F.sum("length").over(before) - F.col("length")).cast("long").alias("offset"),
        "length",
        "copies",
        "digest",
    )


def tree(numbered: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of a tree, each ``node``, ``digest``: the leaves first, the root last."""
    level = stage(numbered.select(F.col("number").alias("node"), "digest"), "leaves")
    levels = [level]
    while level.count() > 1:
        child = F.struct("node", "digest")
        parent = F.floor(F.col("node") / fanout).cast("long").alias("_parent")
        level = stage(
            level.groupBy(parent)
            .agg(F.sort_array(F.collect_list(child)).alias("_children"))  # at most ``fanout``
            .select(
                F.col("_parent").alias("node"),
                F.sha2(F.array_join(F.transform("_children", lambda c: c["digest"]), ""), 256).alias(
                    "digest"
                ),
            ),
            "level",
        )
        levels.append(level)
    return levels


def differing(left: list[DataFrame], right: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Leaf numbers whose digests differ, found from the roots downwards.

    The trees have one shape, that of the manifest. Equal subtrees are not entered.
    """

    def unequal(level: int, among: DataFrame | None) -> DataFrame:
        a, b = left[level], right[level].withColumnRenamed("digest", "_other")
        if among is not None:
            parent = F.floor(F.col("node") / fanout).cast("long")
            a = a.withColumn("_parent", parent).join(among, "_parent", "left_semi")
            b = b.withColumn("_parent", parent).join(among, "_parent", "left_semi").drop("_parent")
        return a.join(b, "node").filter("digest <> _other").select("node")

    frontier = unequal(len(left) - 1, None)
    for level in range(len(left) - 2, -1, -1):
        frontier = stage(frontier.select(F.col("node").alias("_parent")), "frontier")
        frontier = unequal(level, frontier)
    return frontier


def audit(
    primary: DataFrame,
    replica: DataFrame,
    key: Sequence[str] = KEY,
    payload: str = "html",
    fanout: int = FANOUT,
    file_records: int = FILE_RECORDS,
) -> DataFrame:
    """Every record of both replicas with its place and ``status``.

    ``ok``, ``corrupt`` and ``missing`` are records of the manifest, which is made
    from ``primary``; ``extra`` ones only the replica has, and they have no place.
    NULL payloads are as empty ones. An empty primary leaves only extra records, an
    empty replica only missing ones. Columns beside key and payload are not read.
    """
    placed = stage(manifest(primary, key, payload, file_records), "manifest")
    held = stage(leaves(replica, key, payload), "replica")
    theirs = held.select(
        *(F.col(k).alias(f"_{k}") for k in key), F.col("digest").alias("_found"), F.lit(1).alias("_there")
    )
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    found = stage(
        placed.join(theirs, same, "left").select(
            "number", F.coalesce("_found", F.lit(_GONE)).alias("digest")
        ),
        "found",
    )
    broken = differing(tree(placed, fanout), tree(found, fanout), fanout)
    status = found.join(broken, F.col("number") == F.col("node")).select(
        "number", F.when(F.col("digest") == _GONE, "missing").otherwise("corrupt").alias("status")
    )
    known = placed.join(status, "number", "left").withColumn(
        "status", F.coalesce("status", F.lit("ok"))
    )
    ours = placed.select(*(F.col(k).alias(f"_{k}") for k in key))
    extra = held.join(ours, same, "left_anti").select(
        *key,
        *(F.lit(None).cast("long").alias(c) for c in ("number", "file", "offset")),
        "length",
        "copies",
        "digest",
        F.lit("extra").alias("status"),
    )
    return known.select(*extra.columns).unionByName(extra)
