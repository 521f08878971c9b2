"""Shards by balanced label propagation, in DataFrame functions only.

Documents that share a hub (here: equal texts) are linked. Every linked document
starts in a shard given by its row id; then, round by round, joins tell each one how
many of its neighbours are in which shard, and it moves to the fullest of those that
have room. This goes on while more neighbours come together; the state in which most are is the
result. Then documents without links fill the shards up to their quotas, which cuts no link,
and only then linked ones go where room is.

All tables are narrow and written between rounds, so a lost executor cannot change a
decision that others built on. A hub's counts are combined before they are shuffled
and come back as one row, so links are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage, stage_counted
from .numbering import positions

SHARDS = 16
PATIENCE = 4  # rounds without a better state, both kinds of rounds twice


def _pick(values: Sequence[int], index: Column | str) -> Column:
    return F.element_at(F.array(*(F.lit(int(v)) for v in values)), (F.col(index) if isinstance(index, str) else index).cast("int") + 1)


def _per_shard(df: DataFrame, column: str, shards: int) -> list[int]:
    counts = dict(df.groupBy(column).count().collect())  # one row per shard
    return [counts.get(i, 0) for i in range(shards)]


def _flows(wanted: Sequence[int], room: Sequence[int], shards: int) -> list[int]:
    """How many of the rows that want from shard i to j may go, by ``i * shards + j``.

    Pairs of shards swap as many as want both ways; the rest take what room is left.
    """
    allowed, left = [0] * len(wanted), list(room)
    for i in range(shards):
        for j in range(shards):
            allowed[i * shards + j] = min(wanted[i * shards + j], wanted[j * shards + i])
    for at in sorted(range(len(wanted)), key=lambda at: -wanted[at]):
        more = max(0, min(wanted[at] - allowed[at], left[at % shards]))
        allowed[at] += more
        left[at % shards] -= more
    return allowed


def _together(cells: DataFrame, shards: int) -> int:
    """Pairs of rows with a common hub and shard, counted for each hub, and each row with itself."""
    squares = sum((F.col(f"_n{i}").cast("decimal(19,0)") * F.col(f"_n{i}") for i in range(shards)), F.lit(0))
    return int(cells.agg(F.coalesce(F.sum(squares), F.lit(0)).alias("n")).first()["n"])


def _cells(links: DataFrame, state: DataFrame, shards: int) -> DataFrame:
    """``_hub``, ``_n0`` ...: how many of its rows are in each shard."""
    return links.join(state, "_row").groupBy("_hub").agg(
        *(F.count_if(F.col("_shard") == i).alias(f"_n{i}") for i in range(shards))
    )


def cut(links: DataFrame, state: DataFrame, shards: int) -> int:
    """Pairs of rows with a common hub in different shards, counted for each hub."""
    cells = stage(_cells(links, state, shards), "cells")
    held = sum((F.col(f"_n{i}") for i in range(shards)), F.lit(0))
    square = held.cast("decimal(19,0)") * held
    everything = int(cells.agg(F.coalesce(F.sum(square), F.lit(0)).alias("n")).first()["n"])
    return (everything - _together(cells, shards)) // 2


def propagate(links: DataFrame, quotas: Sequence[int], rows_per_slice: int = 200_000) -> DataFrame:
    """The shard of each linked row: ``_row``, ``_shard``.

    ``links`` has ``_row``, ``_hub`` for each membership and is written already. Rows with
    a hub in common are neighbours; a pair of rows is a hub of two. A shard takes in no
    more rows than its quota leaves room for, but for swaps. Rounds take turns: in one
    every row may wish for any shard, in the next only for those with room, so that
    what does not fit into the best shard gathers in another one. As rows move side by side, a round
    can make things worse; it ends when nothing moves in both kinds of rounds, or ``PATIENCE``
    rounds have not brought more neighbours together than the best state had. That number
    is whole and bounded, so it ends; no other limit is set.
    """
    shards = len(quotas)
    start = F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int")
    state, _ = stage_counted(
        links.select("_row").distinct().select("_row", start.alias("_shard")), "shards"
    )
    quiet, best_state, most, since = 0, state, -1, 0
    for number in count():
        room = [q - n for q, n in zip(quotas, _per_shard(state, "_shard", shards))]
        cells = stage(_cells(links, state, shards), "cells")  # so that the join below can split a hot hub
        now = _together(cells, shards)
        best_state, most, since = (state, now, 0) if now > most else (best_state, most, since + 1)
        if since == PATIENCE:
            break
        votes = links.join(cells, "_hub").groupBy("_row").agg(
            *(F.sum(f"_n{i}").alias(f"_n{i}") for i in range(shards))
        )
        # the most neighbours (itself included, so that two rows never swap places for ever),
        # then the most room
        free = number % 2 == 0
        best = F.greatest(
            *(
                F.when(
                    F.lit(free or room[i] > 0) | (F.col("_shard") == i),
                    F.struct(
                        F.col(f"_n{i}").alias("n"), F.lit(room[i]).alias("room"), F.lit(i).alias("to")
                    ),
                )
                for i in range(shards)
            )
        )["to"]
        path = (F.col("_shard") * shards + F.col("_to")).alias("_path")
        wishes = stage(
            state.join(votes, "_row")
            .select("_row", "_shard", best.alias("_to"))
            .select("_row", "_shard", "_to", path),
            "wishes",
        )
        moving = wishes.filter("_to <> _shard")
        allowed = _flows(_per_shard(moving, "_path", shards**2), room, shards)
        quiet = 0 if any(allowed) else quiet + 1
        if quiet == 2:
            break
        if quiet:
            since -= 1  # the state is the same, so it is no attempt
            continue
        ranked = positions(moving, "_path", sum(allowed), rows_per_slice=rows_per_slice)
        accepted = ranked.filter(F.col("_pos") < _pick(allowed, "_path")).select(
            "_row", F.col("_to").alias("_new")
        )
        moved = wishes.join(accepted, "_row", "left")
        state = stage(
            moved.select("_row", F.coalesce("_new", "_shard").alias("_shard")), "shards"
        )
    return best_state


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    text: str = "text",
    key: str = "doc_id",
    rows_per_slice: int = 200_000,
) -> DataFrame:
    """Per document: key, ``size``, ``text_crc32``, ``shard``, ``slot``, ``linked``.

    Row counts of the shards differ by one at most, and ``slot`` numbers the rows
    of a shard from 0. Documents with equal texts are linked; a group larger than a shard
    spreads over several. NULL texts have no bytes and no links, empty ones equal
    each other. Repeated rows and keys are placed row by row. No other column is read.
    """
    column = F.col(f"`{text}`")
    bytes_ = F.encode(F.coalesce(column, F.lit("")), "UTF-8")
    rows, number = stage_counted(
        docs.select(
            F.col(f"`{key}`").alias("_key"),
            (F.octet_length(bytes_) + 1).cast("long").alias("size"),
            F.crc32(bytes_).alias("text_crc32"),
            F.md5(F.encode(column, "UTF-8")).alias("_hub"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "documents",
    )
    groups = rows.groupBy("_hub").count().filter("_hub is not null and count > 1").select("_hub")
    groups = stage(groups, "hubs")
    links = stage(rows.select("_row", "_hub").join(groups, "_hub").select("_row", "_hub"), "links")
    quotas = [number // shards + (i < number % shards) for i in range(shards)]
    state = propagate(links, quotas, rows_per_slice)

    start = F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int")
    placed = rows.drop("_hub").join(state, "_row", "left").select(
        "_row", "_key", "size", "text_crc32",
        F.col("_shard").isNotNull().alias("linked"),
        F.coalesce("_shard", start).alias("_shard"),
    )
    # group 2i: linked rows of shard i, 2i+1: its other rows, which leave it first
    placed = stage(
        placed.withColumn("_group", 2 * F.col("_shard") + (~F.col("linked")).cast("int")), "placed"
    )
    sizes = _per_shard(placed, "_group", 2 * shards)
    held = [sizes[2 * i] + sizes[2 * i + 1] for i in range(shards)]
    over = [max(0, h - q) for h, q in zip(held, quotas)]
    free = [max(0, q - h) for h, q in zip(held, quotas)]
    over_before = [0, *accumulate(over)][:-1]
    free_before = [0, *accumulate(free)][:-1]

    ranked = positions(placed, "_group", number, rows_per_slice=rows_per_slice)
    at = F.col("_pos") + F.when(F.col("linked"), 0).otherwise(_pick(sizes[::2], "_shard"))
    surplus = at - _pick(quotas, "_shard")
    ranked = ranked.withColumn("_place", at).withColumn(
        "_extra", F.when(surplus >= 0, surplus + _pick(over_before, "_shard"))
    )
    # the n-th row too many takes the n-th free place
    to = F.size(F.filter(F.array(*(F.lit(int(b)) for b in free_before)), lambda b: b <= F.col("_extra"))) - 1
    ranked = ranked.withColumn("_to", F.when(F.col("_extra").isNotNull(), to))
    slot = F.col("_extra") - _pick(free_before, "_to") + _pick(held, "_to")
    return ranked.select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        F.coalesce("_to", "_shard").cast("int").alias("shard"),
        F.coalesce(slot, "_place").cast("long").alias("slot"),
        "linked",
    )
