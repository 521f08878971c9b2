"""Secret scan with corpus-wide ownership, in DataFrame functions only.

A pattern's matches and the gaps between them are two built-in functions
(``regexp_extract_all`` and ``split``); running sums of their lengths give the
positions. The value of each match is hashed, and a hash is judged by how many
distinct repositories and owners hold it: what many of them share is a copied
example, what one owner holds alone and looks random is taken for live.

Texts are scanned once. Only matches are shuffled; equal (hash, repository,
owner) are combined before that, so a value that a third of all rows hold costs
no more than any other, and AQE can split the join back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the secret, and the least length of that group."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


#: In the order in which spans with one start are listed. ``least`` of hex and access is in
#: the pattern: a run of one class is a match as a whole or fails as a whole.
BASE = (
    Kind(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Kind("access", r"AKIA[A-Z0-9]{14,}"),
    Kind("hex", r"[0-9a-f]{16,}"),
)
#: Further kinds with a prefix of their own.
ADDED = (
    Kind("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Kind("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
EXAMPLE_OWNERS = 3  # held by so many owners and repositories, a value is a copied example
LIVE_CHARACTERS = 8  # distinct characters of a value that looks random


def _scan(text: Column, kind: Kind) -> Column:
    """Matches of one kind: position in the list, gap before it, lengths and value."""
    pattern = F.lit(kind.pattern)
    gaps = F.transform(F.split(text, kind.pattern, -1), F.char_length)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else whole
    found = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), values.alias("value")),
        lambda m: F.struct(
            m["gap"].alias("gap"), F.char_length(m["whole"]).alias("size"), m["value"].alias("value")
        ),
    )
    # behind the last match is one more gap
    return F.when(text.rlike(kind.pattern), F.slice(found, F.lit(1), F.size(whole)))


def _columns(names: Sequence[str]) -> Column:
    parts = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names)
    return F.concat_ws("/", *parts)


def _matches(rows: DataFrame, kinds: Sequence[Kind]) -> DataFrame:
    """``_row``, ``rank``, ``start``, ``end``, ``value`` and holders of every match that counts.

    ``rows`` has one array of matches for each kind, named by its rank.
    """
    parts = []
    for rank, kind in enumerate(kinds):
        exploded = rows.select(
            "_row", "_repository", "_owner", F.posexplode(f"_found{rank}").alias("at", "m")
        )
        parts.append(
            exploded.select(
                "_row", "_repository", "_owner", F.lit(rank).alias("rank"), "at", "m.*",
                F.lit(kind.least).alias("least"),
            )
        )
    before = Window.partitionBy("_row", "rank").orderBy("at")
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before).cast("long"))
        .withColumn("start", F.col("end") - F.col("size"))
        .filter(F.char_length("value") >= F.col("least"))
        .select("_row", "_repository", "_owner", "rank", "start", "end",
                F.sha2("value", 256).alias("hash"),
                (F.size(F.array_distinct(F.split("value", ""))) >= LIVE_CHARACTERS).alias("random"))
    )


def ownership(matches: DataFrame) -> DataFrame:
    """``hash``, ``repositories`` and ``owners``: how many distinct ones hold each value."""
    held = matches.select("hash", "_repository", "_owner").distinct()
    return held.groupBy("hash").agg(
        F.count_distinct("_repository").alias("repositories"),
        F.count_distinct("_owner").alias("owners"),
    )


def _judged(matches: DataFrame) -> DataFrame:
    """Matches with their ``verdict``: ``example``, ``live`` or ``shared``."""
    copied = (F.col("owners") >= EXAMPLE_OWNERS) & (F.col("repositories") >= EXAMPLE_OWNERS)
    verdict = F.when(copied, "example").when((F.col("owners") == 1) & F.col("random"), "live")
    held = stage(ownership(matches), "ownership")  # so that the join can split a hot value
    return matches.join(held, "hash").withColumn(
        "verdict", verdict.otherwise("shared")
    )


def _prepared(
    docs: DataFrame, text: str, kinds: Sequence[Kind], holders: Mapping[str, Sequence[str]]
) -> list[Column]:
    found = [_scan(F.col(f"`{text}`"), k).alias(f"_found{i}") for i, k in enumerate(kinds)]
    return [
        _columns(holders["repository"]).alias("_repository"),
        _columns(holders["owner"]).alias("_owner"),
        *found,
    ]


#: A repository of these contains its owner, so a value has at least as many repositories as
#: owners, and the count of owners alone decides what is an example.
HOLDERS = {"repository": ("source", "lang"), "owner": ("source",)}


def scan(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    added: Sequence[Kind] = ADDED,
    holders: Mapping[str, Sequence[str]] = HOLDERS,
) -> DataFrame:
    """Per document: ``key`` and ``matches``, an array of (start, rank, end, hash, verdict).

    Positions are code points, the end exclusive; ``rank`` counts through ``BASE``
    and ``added``. NULL and empty texts have no matches; NULL holders count as one
    holder without a name. Rows are told apart by a row id, so repeated rows and
    NULL keys stay. Columns beside those named are not read.
    """
    kinds = (*BASE, *added)
    narrow = docs.select(F.col(f"`{key}`").alias("_key"), *_prepared(docs, text, kinds, holders))
    rows = stage(narrow.withColumn("_row", F.monotonically_increasing_id()), "secrets")
    each = _judged(_matches(rows, kinds)).groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "end", "hash", "verdict"))).alias(
            "matches"
        )
    )
    return rows.join(each, "_row", "left").select(F.col("_key").alias(key), "matches")


def digest(scanned: DataFrame, key: str = "doc_id", added: Sequence[Kind] = ADDED) -> DataFrame:
    """Counts for each base kind and verdict, and the spans as text."""
    names = F.array(*(F.lit(k.name) for k in (*BASE, *added)))
    matches = F.coalesce("matches", F.expr("array()").cast(scanned.schema["matches"].dataType))

    def spans(of: Column) -> Column:
        say = lambda m: F.concat_ws(":", F.get(names, m["rank"]), m["start"], m["end"])
        return F.array_join(F.transform(of, say), ",")

    def count(field: str, value) -> Column:
        return F.size(F.filter(matches, lambda m: m[field] == value)).cast("long")

    return scanned.select(
        key,
        *(count("rank", i).alias(f"n_{k.name}") for i, k in enumerate(BASE)),
        F.sha2(spans(F.filter(matches, lambda m: m["rank"] < len(BASE))), 256).alias("base_sha256"),
        spans(matches).alias("spans"),
        *(count("verdict", v).alias(f"n_{v}") for v in VERDICTS),
    )


VERDICTS = ("live", "shared", "example")
MASK = "[REDACTED]"


def redact(
    docs: DataFrame,
    text: str = "text",
    added: Sequence[Kind] = ADDED,
    holders: Mapping[str, Sequence[str]] = HOLDERS,
    verdicts: Sequence[str] = ("live", "shared"),
) -> DataFrame:
    """The documents with each run of matches of these verdicts masked; examples stay.

    Every row and column is kept. Only texts with a match leave their place: they
    are written with a row id, the others pass as they are.
    """
    kinds = (*BASE, *added)
    column = F.col(f"`{text}`")
    suspect = F.coalesce(reduce(Column.__or__, (column.rlike(k.pattern) for k in kinds)), F.lit(False))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")  # names can't clash
    rows = stage(
        docs.filter(suspect)
        .select(whole, column.alias("_text"), *_prepared(docs, text, kinds, holders))
        .withColumn("_row", F.monotonically_increasing_id()),
        "suspects",
    )
    order = Window.partitionBy("_row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        _judged(_matches(rows, kinds))
        .filter(F.col("verdict").isin(*verdicts))
        .withColumn("_new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
        .withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_row", "_run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .withColumn("_from", F.coalesce(F.lag("end").over(Window.partitionBy("_row").orderBy("start")), F.lit(0)))
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "_from"))).alias("_runs"))
    )
    size = lambda r: (r["start"] - r["_from"]).cast("int")
    piece = lambda r: F.concat(
        F.substr("_text", (r["_from"] + 1).cast("int"), size(r)), F.lit(MASK)
    )
    tail = F.substr("_text", (F.element_at("_runs", -1)["end"] + 1).cast("int"))
    masked = F.concat(F.array_join(F.transform("_runs", piece), ""), tail)
    changed = F.when(F.col("_runs").isNull(), F.col("_text")).otherwise(masked)
    done = rows.join(runs, "_row", "left").select(
        *((changed if c == text else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns)
    )
    return docs.filter(~suspect).unionByName(done)
