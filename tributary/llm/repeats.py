"""Repeated passages by window minima with bounded contexts, in place of prefix-free parsing.

Rolling-hash triggers cut texts into overlapping phrases. A trigger with what lies around
it, ``LENGTH`` bytes to either side less its own, holds every string of ``LENGTH`` bytes
in which it is the first choice, so equal strings meet at equal triggers:

* Parse: every trigger with a hash of its surroundings. Triggers that occur once
  end here. Surroundings that occur again are copies as a whole; the first occurrence
  of each is an entry of the dictionary.
* Dictionary: entries of a trigger are sorted by what follows (the suffix array of the
  parse) and by what precedes, read backwards (that of the phrases). Common prefixes of
  neighbours in both orders tell which entries share a string around the trigger:
  it ends in a common suffix of the left and begins a common prefix of the right.
* The first in corpus order of those that share a string keeps it.

Texts that copy each other cost one entry between them. The entries of a trigger with very many
different surroundings are not sorted in one task: its strings are dealt out one by one. Its
surroundings are counted in one, though.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage, stage_counted
from . import rolling

LENGTH = 100  # bytes of a string that must not occur again
TRIGGER = 32  # bytes of the string that ends a phrase
HOT = 20_000  # different surroundings of a trigger that one task sorts
BUCKET = 30_000  # entries of one task
TAG = 16  # bytes of a digest by which texts of one key are told apart
SLOTS = 1 << 22  # of the filter for texts that are looked at again


def triggers(chunk: rolling.Chunk, length: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, byte position in the text, hash of the trigger and of its surroundings.

    A trigger is where the rolling hash of ``width`` bytes is least among all that begin in
    some string of ``length`` bytes. So every such string has one, and equal strings
    have the same. Texts shorter than ``length`` have none.
    """
    data, offsets = chunk.data, chunk.offsets
    n, span = len(data), length - width + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    sums = rolling.bytes_prefix(data)
    at = np.arange(n - width + 1)
    grams = rolling.spans_hash(sums, at, at + width)
    # least[i]: the minimum of grams[i : i + span], by doubling
    least, size = grams, 1
    while size < span:
        step = min(size, span - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    # windows inside one text
    starts = np.arange(n - length + 1)
    row_of = np.repeat(np.arange(chunk.rows), np.diff(offsets))
    inside = row_of[starts] == row_of[starts + length - 1]
    # a position is a trigger if it is the least of a window that holds it: the least of the
    # windows that hold it, the largest of their minima, is its own hash
    valid = np.where(inside, least, 0)
    top, size = valid, 1
    while size < span:
        step = min(size, span - size)
        padded = np.concatenate((np.zeros(step, np.uint64), top))
        top = np.maximum(padded, np.concatenate((top, np.zeros(step, np.uint64))))
        size += step
    found = np.flatnonzero(top[: len(grams)] == grams)
    row = row_of[found]
    low = np.maximum(offsets[row], found - (length - width))
    high = np.minimum(offsets[row + 1], found + length)
    return row, found - offsets[row], grams[found], rolling.mix(
        rolling.spans_hash(sums, low, high) + (found - low).astype(np.uint64)
    )


def _find(docs: DataFrame, length: int, width: int) -> DataFrame:
    """``_key``, ``_tag``, ``_at``, ``_anchor``, ``_around`` of every trigger of ``_key``, ``_tag``, ``_text``.

    ``_at`` is the position in the text. Surroundings that repeat inside a batch are combined
    before the shuffle: the first goes on for all, the others are ``_copy`` already and
    get an anchor of their own, by which they spread.
    """
    schema = T.StructType(
        [docs.schema["_key"], docs.schema["_tag"]]
        + [T.StructField(c, T.LongType()) for c in ("_at", "_anchor", "_around")]
        + [T.StructField("_copy", T.BooleanType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(row + chunk.first, *rest) for chunk in rolling.chunks(batch.column(2))
                     for row, *rest in [triggers(chunk, length, width)]]
            if not parts:
                continue
            row, at, anchor, around = (np.concatenate(x) for x in zip(*parts))
            keys = pa.table({"k": batch.column(0), "t": batch.column(1)})
            by_key = [("k", "ascending"), ("t", "ascending")]
            rank = np.empty(batch.num_rows, np.int64)
            rank[pc.sort_indices(keys, sort_keys=by_key, null_placement="at_start").to_numpy()] = (
                np.arange(batch.num_rows)
            )
            order = np.argsort(rank[row], kind="stable")  # positions ascend already
            row, at, anchor, around = (x[order] for x in (row, at, anchor, around))
            copy = np.ones(len(row), bool)
            both = np.stack((anchor, around), axis=1).view("V16").ravel()
            copy[np.unique(both, return_index=True)[1]] = False
            own = rolling.mix(rolling.mix(rank[row].astype(np.uint64)) + around + at.astype(np.uint64))
            anchor = np.where(copy, own, anchor)
            columns = [batch.column(i).take(pa.array(row)) for i in range(2)]
            columns += [pa.array(x.view(np.int64)) for x in (at, anchor, around)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(copy)], schema.names)

    return docs.select("_key", "_tag", "_text").mapInArrow(work, schema)


def _slot():
    return F.pmod(F.xxhash64("_key", "_tag"), F.lit(SLOTS)).cast("int")


def _flags(lists: DataFrame):
    """A broadcast of ``SLOTS`` bits: which documents ``lists`` may name."""
    slots = lists.select(_slot().alias("slot")).distinct().toArrow()["slot"].to_numpy()
    flags = np.zeros(SLOTS, bool)
    flags[slots] = True
    return lists.sparkSession.sparkContext.broadcast(np.packbits(flags).tobytes())


def _known(shared) -> np.ndarray:
    return np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)


def _wanted(docs: DataFrame, lists: DataFrame, shared, how: str = "inner") -> DataFrame:
    """Texts, compressed, of the flagged documents, joined with ``lists``."""
    schema = T.StructType(
        [docs.schema["_key"], docs.schema["_tag"], T.StructField("_size", T.LongType()),
         T.StructField("_packed", T.BinaryType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, codec = _known(shared), pa.Codec("zstd", 1)
        for batch in batches:
            batch = batch.filter(pa.array(known[batch.column(3).to_numpy()]))
            raw = [(x.as_py() or "").encode() for x in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array([len(r) for r in raw], pa.int64())]
            packed = [codec.compress(r, asbytes=True) if r else b"" for r in raw]
            columns.append(pa.array(packed, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    texts = docs.select("_key", "_tag", "_text", _slot().alias("_slot")).mapInArrow(work, schema)
    named = lists.withColumnsRenamed({"_key": "_k", "_tag": "_t"})
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_tag") == F.col("_t"))
    return texts.join(named, same, how).drop("_k", "_t")


def _unpack(packed: pa.Scalar, size: int) -> bytes:
    return pa.Codec("zstd").decompress(packed.as_py(), size, asbytes=True) if size else b""


def _entries(found: DataFrame, length: int, width: int) -> DataFrame:
    """The dictionary: anchor, whether it is hot, key, tag, place, bytes on the left, surroundings."""
    key = found.schema["_key"]
    schema = T.StructType(
        [
            T.StructField("_anchor", T.LongType()),
            T.StructField("_hot", T.BooleanType()),
            key,
            found.schema["_tag"],
            T.StructField("_at", T.LongType()),
            T.StructField("_left", T.IntegerType()),
            T.StructField("_bytes", T.BinaryType()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            while first < batch.num_rows:
                row, lists, lefts, parts = [], [], [], []
                while first < batch.num_rows and len(row) < 20_000:
                    text = _unpack(batch.column(3)[first], batch.column(2)[first].as_py())
                    list_ = batch.column(4)[first].values
                    at = list_.field("at").to_numpy()
                    left = np.minimum(at, length - width)
                    parts += [text[a - b : a + length] for a, b in zip(at.tolist(), left.tolist())]
                    row += [first] * len(at)
                    lists.append(list_)
                    lefts.append(left)
                    first += 1
                merged = pa.concat_arrays(lists)
                own = pa.array(row, pa.int64())
                columns = [
                    merged.field("anchor"),
                    merged.field("hot"),
                    batch.column(0).take(own),
                    batch.column(1).take(own),
                    merged.field("at").cast(pa.int64()),
                    pa.array(np.concatenate(lefts).astype(np.int32)),
                    pa.array(parts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return found.select("_key", "_tag", "_size", "_packed", "_entries").mapInArrow(work, schema)


def _order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte rows, and the common prefix of each with the one before."""
    width = rows.shape[1]
    flat = rows.tobytes()
    keys = [flat[i : i + width] for i in range(0, len(flat), width)]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    ranked = rows[order]
    differ = np.ones((len(rows), width + 1), bool)
    differ[1:, :width] = ranked[1:] != ranked[:-1]
    common = differ.argmax(axis=1)
    common[:1] = -1
    return order, common


def shared_strings(
    anchors: np.ndarray, left: np.ndarray, around: list[bytes], length: int, width: int
) -> np.ndarray:
    """For entries in corpus order, one row each: does the string that begins ``a`` bytes
    before the trigger stand in an earlier entry of the same trigger?"""
    n, reach = len(around), length - width
    before, after = np.zeros((n, reach), np.uint8), np.zeros((n, length), np.uint8)
    right = np.zeros(n, np.int64)
    for i, (b, text) in enumerate(zip(left.tolist(), around)):
        own = np.frombuffer(text, np.uint8)
        before[i, :b] = own[:b][::-1]
        after[i, : len(own) - b] = own[b:]
        right[i] = len(own) - b
    # the triggers' hashes first, so that entries of different ones never meet
    tail = anchors.astype(">u8").view(np.uint8).reshape(n, 8)
    order, common = _order(np.concatenate((tail, after), axis=1))
    back, shared = _order(before)
    again = np.zeros((n, reach + 1), bool)
    suffix, prefix = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(reach + 1):
        suffix[order] = np.cumsum(common < 8 + length - a)
        prefix[back] = np.cumsum(shared < a)
        fits = np.flatnonzero((left >= a) & (right >= length - a))
        _, first, group = np.unique(
            suffix[fits] * (n + 1) + prefix[fits], return_index=True, return_inverse=True
        )
        again[fits, a] = first[group] != np.arange(len(fits))
    return again


def _sorted_out(entries: DataFrame, count: int, length: int, width: int) -> DataFrame:
    """``_key``, ``_tag``, ``_begin``, ``_end``: strings of entries that an earlier one has."""
    names = [entries.schema["_key"], entries.schema["_tag"]]
    schema = T.StructType(names + [T.StructField(c, T.LongType()) for c in ("_begin", "_end")])
    buckets = max(1, math.ceil(count / BUCKET))

    def work(group: pa.Table) -> pa.Table:
        keys = [(c, "ascending") for c in ("_key", "_tag", "_at")]
        group = group.take(pc.sort_indices(group, sort_keys=keys, null_placement="at_start"))
        group = group.combine_chunks()
        at = group["_at"].to_numpy()
        again = shared_strings(
            group["_anchor"].to_numpy().view(np.uint64),
            group["_left"].to_numpy(),
            group["_bytes"].to_pylist(),
            length,
            width,
        )
        edge = np.zeros((len(at), 1), bool)
        change = np.diff(np.concatenate((edge, again, edge), axis=1).astype(np.int8), axis=1)
        row, low = np.nonzero(change == 1)
        _, high = np.nonzero(change == -1)  # one behind the largest a of the run
        columns = [group[c].take(pa.array(row)) for c in ("_key", "_tag")]
        columns += [pa.array(at[row] - high + 1), pa.array(at[row] - low + length)]
        return pa.table(columns, names=schema.names)

    bucket = F.pmod("_anchor", F.lit(buckets)).alias("_bucket")
    cold = entries.filter("not _hot").select(bucket, *entries.columns)
    return cold.groupBy("_bucket").applyInArrow(work, schema)


def _dealt_out(entries: DataFrame, length: int, width: int) -> DataFrame:
    """As ``_sorted_out`` for hot triggers: every string by its digest, first ones by a minimum."""
    places = F.sequence(F.lit(0), F.least(F.col("_left"), F.lit(length - width)))
    place = ["_key", "_tag", "_at"]
    each = entries.filter("_hot").select(*place, "_left", "_bytes", F.explode(places).alias("_a"))
    string = F.substring("_bytes", F.col("_left") - F.col("_a") + 1, length)
    each = each.select(*place, "_a", string.alias("_s")).filter(F.octet_length("_s") == length)
    each = each.select(*place, "_a", F.sha2("_s", 256).alias("_s"))
    order = F.struct(*place)
    first = stage(each.groupBy("_s", "_a").agg(F.min(order).alias("_first")), "strings")
    late = each.join(first, ["_s", "_a"]).filter(order > F.col("_first"))
    begin = F.col("_at") - F.col("_a")
    return late.select("_key", "_tag", begin.alias("_begin"), (begin + length).alias("_end"))


def _parsed(docs: DataFrame, length: int, width: int, hot: int) -> DataFrame:
    """Per document with repeats: positions of copied triggers, and entries to compare."""
    same = Window.partitionBy("_anchor")
    ordered = same.orderBy("_around", "_key", "_tag", "_at")
    previous = F.lag("_around").over(ordered)
    first = ~F.col("_copy") & F.coalesce(previous != F.col("_around"), F.lit(True))
    seen = (
        _find(docs, length, width)
        .withColumn("_new", first)
        .withColumn("_kinds", F.count_if("_new").over(same))
        .filter("not _new or _kinds > 1")
    )
    at = F.col("_at").cast("int")
    entry = F.struct(
        F.col("_anchor").alias("anchor"), at.alias("at"), (F.col("_kinds") > hot).alias("hot")
    )
    return seen.groupBy("_key", "_tag").agg(
        F.collect_list(F.when(~F.col("_new"), at)).alias("_copies"),
        F.collect_list(F.when(F.col("_new"), entry)).alias("_entries"),
    )


def _judge(text: bytes, copies: np.ndarray, spans: np.ndarray, length: int, width: int):
    """Which bytes go: around copied triggers, and in the spans."""
    change = np.zeros(len(text) + 1, np.int64)
    low = np.maximum(copies - (length - width), 0)
    high = np.minimum(copies + length, len(text))
    whole = high - low >= length
    np.add.at(change, np.concatenate((low[whole], spans[:, 0])), 1)
    np.add.at(change, np.concatenate((high[whole], spans[:, 1])), -1)
    return np.cumsum(change[:-1]) > 0


def remove(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    width: int = TRIGGER,
    hot: int = HOT,
    with_kept: bool = True,
) -> DataFrame:
    """Per document: ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept``.

    A byte goes if it lies in a string of ``length`` bytes that begins earlier, too: in a
    document with a smaller key (NULL is the smallest), or before in the same text. Of
    documents with one key, texts are ordered by a hash; rows with equal key and text
    are one document, and each gets its result. NULL texts are as empty ones. ``kept``,
    which can be left out, are the remaining bytes. Other columns are not read.
    """
    named = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    repeats = named.groupBy("_key").count().filter("count > 1")
    repeated = not repeats.isEmpty()
    tag = F.substring(F.unhex(F.sha2(F.coalesce("_text", F.lit("")), 256)), 1, TAG)
    named = named.withColumn("_tag", tag if repeated else F.lit("").cast("binary"))
    unique = named.dropDuplicates(["_key", "_tag"]) if repeated else named
    parsed = stage(_parsed(unique, length, width, hot), "parsed")

    with_entries = parsed.filter(F.size("_entries") > 0).select("_key", "_tag", "_entries")
    texts = _wanted(unique, with_entries, _flags(with_entries))
    entries, count = stage_counted(_entries(texts, length, width), "entries")
    found = _sorted_out(entries, count, length, width)
    if not entries.filter("_hot").isEmpty():
        found = found.unionByName(_dealt_out(entries, length, width))
    spans = found.groupBy("_key", "_tag").agg(
        F.collect_list(F.struct("_begin", "_end")).alias("_spans")
    )
    copies = parsed.filter(F.size("_copies") > 0).select("_key", "_tag", "_copies")
    both = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("_key", "_tag")]
    marks = spans.alias("a").join(copies.alias("b"), both[0] & both[1], "full").select(
        F.coalesce("a._key", "b._key").alias("_key"),
        F.coalesce("a._tag", "b._tag").alias("_tag"),
        "_spans",
        "_copies",
    )
    marks = stage(marks, "marks")
    return _applied(named, marks, key, length, width, with_kept)


def _applied(
    named: DataFrame, marks: DataFrame, key: str, length: int, width: int, with_kept: bool
) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField(key, named.schema["_key"].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
            *([T.StructField("kept", T.BinaryType())] if with_kept else []),
        ]
    )

    def batch_of(keys, texts, gone) -> pa.RecordBatch:
        kept, counts = [], []
        for raw, flag in zip(texts, gone):
            data = np.frombuffer(raw, np.uint8)
            kept.append(raw if flag is None else data[~flag].tobytes())
            edges = 0 if flag is None else int(flag[:1].sum() + (flag[1:] & ~flag[:-1]).sum())
            counts.append((len(raw), len(raw) - len(kept[-1]), edges))
        columns = [keys] + [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
        columns.append(pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()))
        if with_kept:
            columns.append(pa.array(kept, pa.binary()))
        return pa.RecordBatch.from_arrays(columns, schema.names)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            for i in range(batch.num_rows):
                raw = _unpack(batch.column(2)[i], batch.column(1)[i].as_py())
                copies, spans = batch.column(3)[i].values, batch.column(4)[i].values
                at = np.zeros(0, np.int64) if copies is None else copies.to_numpy().astype(np.int64)
                ranges = np.zeros((0, 2), np.int64)
                if spans is not None:
                    ranges = np.stack([spans.field(c).to_numpy() for c in range(2)], axis=1)
                texts.append(raw)
                gone.append(_judge(raw, at, ranges, length, width))
            yield batch_of(batch.column(0), texts, gone)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(shared)
        for batch in batches:
            batch = batch.filter(pa.array(~known[batch.column(2).to_numpy()]))
            texts = [(x.as_py() or "").encode() for x in batch.column(1)]
            yield batch_of(batch.column(0), texts, [None] * len(texts))

    shared = _flags(marks)
    done = _wanted(named, marks, shared, "left")
    done = done.select("_key", "_size", "_packed", "_copies", "_spans").mapInArrow(marked, schema)
    others = named.select("_key", "_text", _slot().alias("_slot")).mapInArrow(plain, schema)
    return done.unionByName(others)
