"""Joins whose heavy keys go their own way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named
from ..session import stage

TRACKED = 4096  # keys that the sketch keeps apart
MOST = 256  # heavy keys that are looked for
SHARE = 0.01  # of the rows, from which on a key is heavy
RIGHT_ROWS = 100_000  # right rows of all heavy keys together that are sent to every task


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """Keys that hold at least this share of the rows, by a sketch of the most frequent ones.

    The sketch is combined like any aggregate and holds ``TRACKED`` keys at most, whatever the
    input. Its counts are upper bounds, so no heavy key is missed; one that is slightly
    lighter may be among them. NULLs never join and are no key.
    """
    column = key.replace("`", "``")
    top = F.expr(f"approx_top_k(`{column}`, {MOST}, {TRACKED})")
    found = df.filter(named(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= max(2, share * found["n"])]


def split_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = SHARE, right_rows: int = RIGHT_ROWS
) -> DataFrame:
    """``left.join(right, key, how)`` for inner and left joins, safe from heavy keys on the left.

    Rows of heavy keys stay where they are and meet their right rows by broadcast, if those are few,
    which is counted first; all others take the plain join. Behind a join by key, Spark takes
    an aggregate by the same key as dealt already and leaves a hot key in one task; behind
    this one every task combines its rows before they are moved.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"no {how} join: only inner and left keep the left side's rows apart")
    heavy = heavy_keys(left, key, share)
    if not heavy:
        return left.join(right, key, how)
    is_heavy = named(key).isin(heavy)
    few = stage(right.filter(is_heavy), "heavy")  # counted, then broadcast: read once from the right side
    if few.count() > right_rows:
        return left.join(right, key, how)
    apart = left.filter(is_heavy).join(F.broadcast(few), key, how)
    rest = left.filter(~F.coalesce(is_heavy, F.lit(False))).join(right.filter(~is_heavy), key, how)
    return apart.unionByName(rest)
