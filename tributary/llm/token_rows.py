"""Token ids packed into rows of fixed length, by best fit decreasing.

Texts are tokenised, closed by an end mark, and cut into pieces of at most one row.
Pieces are dealt to groups of bounded size by hash; each group is packed by itself:
the longest piece first, each into the fullest row that still has room, which
a segment tree over the free capacities finds. Groups are many and
alike, so hot sources or long documents spread over all of them, and a group of
some million tokens packs as tightly as the whole would.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 2048  # tokens of a row
GROUP_BYTES = 8 << 20  # text bytes of one group: at most as many tokens, and one for each text
_BATCH = 1 << 20  # token ids handed on at once
_encoders: dict[str, object] = {}


def vocabulary(path: str | None = None) -> tuple[bytes, str]:
    """The rank file and the split pattern of a public byte-level tokenizer."""
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return Path(path).read_bytes(), public_tokenizers.PATTERN


def encoder(ranks: bytes, pattern: str):
    """The tokenizer of a rank file; built once in each worker."""
    name = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if name not in _encoders:
        import tiktoken

        lines = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(token): int(rank) for token, rank in lines}
        _encoders[name] = tiktoken.Encoding(
            "public", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
        )
    return _encoders[name]


class Capacities:
    """Open rows by free capacity; the segment tree finds the least that is enough."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        at = free + self.width
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (free, row) of the row that fits best, if any does."""
        at = need + self.width
        while not self.count[at]:  # to the right: up until there is a right neighbour
            while at & 1:
                at >>= 1
            if at <= 1:
                return None
            at += 1
        while at < self.width:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.width
        row = self.rows[free].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return free, row


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """The members of each row, in the order in which they were placed."""
    rows: list[list[int]] = []
    tree = Capacities(capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        found = tree.take(size)
        free, row = found or (capacity, len(rows))
        if not found:
            rows.append([])
        rows[row].append(i)
        tree.add(free - size, row)
    return rows


def tokens(
    docs: DataFrame,
    groups: int,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key``, ``piece``, ``ids`` and a ``group``: each text and its end mark, cut into pieces.

    The end mark is the first id that the vocabulary leaves free. Ids are 2 bytes
    each if they fit, else 4, little-endian. NULL and empty texts are an end mark alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer))  # size of a vocabulary
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("group", T.IntegerType()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(*shared.value)
        end, kind = encode.max_token_value + 1, id_type(encode.max_token_value + 1)
        task, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, pieces, parts, group, size = [], [], [], [], 0

            def made():
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(parts, pa.binary()),
                    pa.array(group, pa.int32()),
                ]
                return pa.RecordBatch.from_arrays(columns, schema.names)

            for i in range(batch.num_rows):
                ids = np.array(encode.encode_ordinary(batch.column(1)[i].as_py() or "") + [end], kind)
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    rows.append(i)
                    pieces.append(piece)
                    parts.append(ids[at : at + capacity].tobytes())
                    mixed = hashlib.blake2b(f"{task}:{seen}".encode(), digest_size=4).digest()
                    group.append(int.from_bytes(mixed, "big") % groups)
                    seen += 1
                size += len(ids)
                if size >= _BATCH:
                    yield made()
                    rows, pieces, parts, group, size = [], [], [], [], 0
            if rows:
                yield made()

    return docs.select(key, text).mapInArrow(work, schema)


def id_type(largest: int) -> np.dtype:
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    text: str = "text",
    key: str = "doc_id",
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Packed rows: ``group``, ``row``, ``n_tokens``, ``keys``, ``pieces``, ``cu_seqlens``,
    ``input_ids``, ``position_ids``.

    ``input_ids`` are ``capacity`` ids, filled up with the end mark behind ``n_tokens``;
    ``position_ids`` restart at 0 with each segment and are 0 in the filling;
    ``cu_seqlens`` are where segments begin, and the end of the last one. Both matrices
    are little-endian bytes. Each text's pieces, joined in order, give its ids and the
    end mark. Repeated rows and NULL keys are packed as rows of their own, and an
    empty table gives no rows.
    """
    total = docs.select(
        F.sum(F.coalesce(F.octet_length(F.encode(text, "UTF-8")), F.lit(0)) + 1).alias("n")
    ).first()["n"]
    groups = max(1, math.ceil((total or 0) / group_bytes))
    kind_of_key = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("group", T.IntegerType()),
            T.StructField("row", T.IntegerType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("keys", T.ArrayType(kind_of_key)),
            T.StructField("pieces", T.ArrayType(T.IntegerType())),
            T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
            T.StructField("input_ids", T.BinaryType()),
            T.StructField("position_ids", T.BinaryType()),
        ]
    )
    names = schema.names
    ranks, pattern = vocabulary(tokenizer)
    end = encoder(ranks, pattern).max_token_value + 1

    def work(group: pa.Table) -> pa.Table:
        kind = id_type(end)
        group = group.combine_chunks()
        ids = [np.frombuffer(x.as_py(), kind) for x in group["ids"]]
        keys, pieces = group.column(0).to_pylist(), group["piece"].to_pylist()
        number = group["group"][0].as_py()
        rows = best_fit_decreasing(np.array([len(x) for x in ids]), capacity)
        out = {name: [] for name in names}
        for row, members in enumerate(rows):
            lengths = [len(ids[i]) for i in members]
            ends = np.cumsum([0, *lengths])
            used = int(ends[-1])
            matrix = np.full(capacity, end, kind)
            matrix[:used] = np.concatenate([ids[i] for i in members])
            position = np.zeros(capacity, id_type(capacity))
            position[:used] = np.arange(used) - np.repeat(ends[:-1], lengths)
            made = (number, row, used, [keys[i] for i in members], [pieces[i] for i in members])
            made += (ends.tolist(), matrix.tobytes(), position.tobytes())
            for name, value in zip(names, made):
                out[name].append(value)
        arrow = pa.schema(
            [
                ("group", pa.int32()),
                ("row", pa.int32()),
                ("n_tokens", pa.int64()),
                ("keys", pa.list_(group.schema.field(0).type)),
                ("pieces", pa.list_(pa.int32())),
                ("cu_seqlens", pa.list_(pa.int32())),
                ("input_ids", pa.binary()),
                ("position_ids", pa.binary()),
            ]
        )
        return pa.table(out, schema=arrow)

    cut = tokens(docs, groups, capacity, tokenizer, text, key)
    return cut.groupBy("group").applyInArrow(work, schema)


def segments(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The way back: ``key``, ``piece`` and the bytes of its ids."""
    width = F.octet_length("input_ids") / F.octet_length("position_ids")
    each = F.arrays_zip("keys", "pieces", F.slice("cu_seqlens", 1, F.size("keys")).alias("begin"),
                        F.slice("cu_seqlens", F.lit(2), F.size("keys")).alias("end"))
    size = (width * F.when(F.octet_length("position_ids") > 0, 2)).cast("int")
    return packed.select(F.explode(each).alias("s"), "input_ids", size.alias("size")).select(
        F.col("s.keys").alias(key),
        F.col("s.pieces").alias("piece"),
        F.substr("input_ids", F.col("s.begin") * F.col("size") + 1,
                 (F.col("s.end") - F.col("s.begin")) * F.col("size")).alias("ids"),
    )
