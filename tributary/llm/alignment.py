"""Two tokenizers side by side: groups of tokens that cover the same bytes, and their pairs.

Byte offsets at which tokens of both sides end cut a text into groups. Each token of side A is
linked with each token of side B in its group. How many documents hold a pair of ids linked
is counted over the corpus outside memory:

* Spill. A task collects records (pair, document, links) up to ``RUN_RECORDS``, sorts them by
  pair, side A first, and writes them as a run: a zstd block for each radix, that is, the low
  bits of the id of A. A run holds each pair of a document once.
* Count. The blocks of a radix are dealt to tasks of at most about ``TASK_RECORDS`` records. Each
  task merges its blocks over a heap of their next bounds and emits pairs with counts, which
  Spark adds up. Runs of one radix go to as many tasks as they need, so a pair that all
  documents hold is no burden: it is one count in each run.
* Maxima. All pairs of an id of A are in one radix and in order, so the highest count of each
  follows from one pass over the counts. What a radix holds is bounded by the
  vocabularies, not by the corpus.
* Back. The blocks meet the counts of their radix again and give, for each run and radix,
  what its documents gain; a sum over the radices of a run ends it.

Runs lie in the shared folder and are written once, so a lost executor repeats tasks on the
same runs.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

RADIX_BITS = 6  # low bits of an id of A
RUN_RECORDS = 4 << 20
RUN_DOCUMENTS = 1 << 16
TASK_RECORDS = 8 << 20
STEP = 1 << 15  # pairs of a block that the heap moves on by
CHUNK = 1 << 20  # bytes of text tokenised at once
SEGMENT = 1 << 16  # characters, after which a long text may be cut between two words
WIDE = 4096  # links of a group, above which equal ids are counted before they are paired

_RADICES = 1 << RADIX_BITS
_pairs_of_files: dict[str, "Sides"] = {}


def files(a: str | None = None, b: str | None = None) -> tuple[bytes, bytes]:
    """A byte-level tokenizer file (A) and a piece model (B)."""
    import public_tokenizers

    a = a or public_tokenizers.path("byte_bpe_50k.json")
    b = b or public_tokenizers.path("piece_bpe_32k.model")
    return Path(a).read_bytes(), Path(b).read_bytes()


def sides(found: tuple[bytes, bytes]) -> Sides:
    """Both tokenizers; read once in each worker."""
    name = hashlib.sha256(b"".join(hashlib.sha256(f).digest() for f in found)).hexdigest()
    if name not in _pairs_of_files:
        _pairs_of_files[name] = Sides(*found)
    return _pairs_of_files[name]


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable bytes are themselves, the
    others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _merges(file: bytes) -> dict[bytes, int]:
    """Bytes and id of each token of a byte-level merge file, where ids follow the merges.

    In such a file the pair whose union has the least id is merged first, so ids are ranks.
    Special tokens are none of these, so their strings are plain text.
    """
    read = json.loads(file)
    own, split = read["model"], read["pre_tokenizer"]
    ids = [own["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in own["merges"]]
    plain = own["type"] == "BPE" and not (own["dropout"] or own["ignore_merges"] or read["normalizer"])
    plain &= split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
    if not plain or ids != sorted(set(ids)) or len(ids) + 256 != len(own["vocab"]):
        raise ValueError("the file is no byte-level vocabulary with ids in the order of its merges")
    letters = _byte_letters()
    return {bytes(letters[c] for c in token): i for token, i in own["vocab"].items()}


class Sides:
    """Ids of texts on both sides, and the bytes of each id."""

    def __init__(self, a: bytes, b: bytes):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        merges = _merges(a)
        self.a = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a_bytes = [b""] * (max(merges.values()) + 1)
        for token, i in merges.items():
            self.a_bytes[i] = token
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            value = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            self.b_bytes.append(value)
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids of both sides must fit 16 bits")
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        largest = max(len(self.a_bytes), len(self.b_bytes))
        self.written = [f"{i}{mark}" for i in range(largest) for mark in ",|;"] + [
            str(i) for i in range(largest)
        ]
        self.last = 3 * largest  # ids without a mark behind them start here

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of a space and each text; long texts are cut between words, which changes no id."""
        cut, owner = [], []
        for i, text in enumerate(texts):
            for part in _segments(text):
                cut.append(part)
                owner.append(i)
        ids_a = [self.a.encode_ordinary(" " + p) for p in cut]
        ids_b = self.b.encode(cut, num_threads=1) if cut else []
        if len(cut) == len(texts):
            return ids_a, ids_b
        out_a: list[list[int]] = [[] for _ in texts]
        out_b: list[list[int]] = [[] for _ in texts]
        for i, a, b in zip(owner, ids_a, ids_b):
            out_a[i].extend(a)
            out_b[i].extend(b)
        return out_a, out_b

    def covers(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether the tokens of both sides are the text's bytes behind a space."""
        whole = b" " + text.encode()
        return (
            b"".join(map(self.a_bytes.__getitem__, a)) == whole
            and b"".join(map(self.b_bytes.__getitem__, b)) == whole
        )


_GAP = re.compile(r"(?<=\w) (?=\w)")


def _segments(text: str) -> Iterator[str]:
    """Parts of a text, each to be read behind a space; a space between two parts is left out."""
    at = 0
    while len(text) - at > SEGMENT:
        gap = _GAP.search(text, at + SEGMENT)
        if not gap:
            break
        yield text[at : gap.start()]
        at = gap.end()
    yield text[at:] if at else text


def _ends(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes[ids])


class Aligned:
    """The groups of some texts, of which both sides cover the same bytes."""

    def __init__(self, own: Sides, ids_a: list[list[int]], ids_b: list[list[int]]):
        self.own, self.rows = own, len(ids_a)
        self.n_a = np.array([len(x) for x in ids_a], np.int64)
        self.n_b = np.array([len(x) for x in ids_b], np.int64)
        self.a = np.array([i for x in ids_a for i in x], np.int64)
        self.b = np.array([i for x in ids_b for i in x], np.int64)
        ends_a, ends_b = _ends(self.a, own.a_sizes), _ends(self.b, own.b_sizes)
        cut_a = np.isin(ends_a, ends_b, assume_unique=True)
        cut_b = np.isin(ends_b, ends_a, assume_unique=True)
        self.group_a = np.cumsum(cut_a) - cut_a
        self.group_b = np.cumsum(cut_b) - cut_b
        row_a = np.repeat(np.arange(self.rows), self.n_a)
        self.row = row_a[cut_a]  # of each group
        self.in_a = np.bincount(self.group_a, minlength=len(self.row))
        self.in_b = np.bincount(self.group_b, minlength=len(self.row))
        links = self.in_a * self.in_b
        self.n_groups = np.bincount(self.row, minlength=self.rows)
        self.n_links = np.zeros(self.rows, np.int64)
        np.add.at(self.n_links, self.row, links)

    def written(self) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each text."""
        wide = np.concatenate((2 * self.group_a, 2 * self.group_b + 1))
        ids = np.concatenate((self.a, self.b))
        order = np.argsort(wide, kind="stable")
        wide, ids = wide[order], ids[order]
        marks = np.zeros(len(ids), np.int64)  # a comma
        if len(ids):
            marks[:-1][wide[1:] != wide[:-1]] = 1
            marks[(marks == 1) & (wide % 2 == 1)] = 2
        codes = 3 * ids + marks
        ends = np.cumsum(self.n_a + self.n_b)
        filled = ends[(self.n_a + self.n_b) > 0] - 1
        codes[filled] = self.own.last + ids[filled]
        codes = codes.tolist()
        said, at = [], 0
        for end in ends.tolist():
            said.append("".join(map(self.own.written.__getitem__, codes[at:end])))
            at = end
        return said

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, pair (id of A in the high 16 bits) and links, of each row's distinct pairs."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        links = self.in_a * self.in_b
        first_b = np.cumsum(self.in_b) - self.in_b
        plain = np.flatnonzero(links[self.group_a] <= WIDE)
        times = self.in_b[self.group_a[plain]]
        bounds = np.cumsum(times)
        at = 0
        while at < len(plain):  # some links at a time
            done = bounds[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(bounds, done + (1 << 22), "right")))
            token, n = plain[at:end], times[at:end]
            group = np.repeat(self.group_a[token], n)
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            pair = np.repeat(self.a[token], n) << 16 | self.b[first_b[group] + inside]
            key, count = np.unique(self.row[group] << 32 | pair, return_counts=True)
            keys.append(key)
            counts.append(count)
            at = end
        first_a = np.cumsum(self.in_a) - self.in_a
        for g in np.flatnonzero(links > WIDE).tolist():
            a, n = np.unique(self.a[first_a[g] : first_a[g] + self.in_a[g]], return_counts=True)
            b, m = np.unique(self.b[first_b[g] : first_b[g] + self.in_b[g]], return_counts=True)
            keys.append((int(self.row[g]) << 32) + np.add.outer(a << 16, b).ravel())
            counts.append(np.multiply.outer(n, m).ravel())
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, back, np.concatenate(counts))
        return key >> 32, key & 0xFFFFFFFF, total


def _turned(pair: np.ndarray) -> np.ndarray:
    """The pair with the radix in front, so that a radix is a stretch of the order."""
    a = pair >> 16
    front = (a & (_RADICES - 1)) << (16 - RADIX_BITS) | a >> RADIX_BITS
    return front << 16 | (pair & 0xFFFF)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as one zstd block, each as narrow as it can be."""
    import zstandard

    out = [np.array([len(arrays)], np.int64).tobytes()]
    for x in arrays:
        kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
        out += [np.array([kind.itemsize, len(x)], np.int64).tobytes(), x.astype(kind).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack(block: bytes) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(block)
    out, at = [], 8
    for _ in range(int(np.frombuffer(data, np.int64, 1)[0])):
        size, n = np.frombuffer(data, np.int64, 2, at).tolist()
        out.append(np.frombuffer(data, f"<u{size}", n, at + 16).astype(np.int64))
        at += 16 + size * n
    return out


class Run:
    """Records of some documents; sorted and cut by radix when it is full."""

    def __init__(self, name: int):
        self.name, self.documents, self.size = name, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, rows: np.ndarray, pairs: np.ndarray, links: np.ndarray) -> None:
        self.parts.append((rows + self.documents, pairs, links))
        self.size += len(rows)

    def blocks(self) -> Iterator[tuple[int, int, bytes]]:
        """Radix, records and block: pairs, documents of each pair, places, links."""
        if not self.size:
            return
        place, pair, links = (np.concatenate(x) for x in zip(*self.parts))
        key = _turned(pair) << 17 | place
        order = np.argsort(key)
        key, links = key[order], links[order]
        bounds = np.searchsorted(key, np.arange(_RADICES + 1) << (33 + 16 - RADIX_BITS))
        for radix in np.flatnonzero(np.diff(bounds)).tolist():
            own = slice(bounds[radix], bounds[radix + 1])
            pairs, first, held = np.unique(key[own] >> 17, return_index=True, return_counts=True)
            steps = np.diff(pairs, prepend=0)
            yield radix, len(links[own]), pack(steps, held, key[own] & 0x1FFFF, links[own])


def _read(block: bytes) -> list[np.ndarray]:
    steps, held, place, links = unpack(block)
    return [np.cumsum(steps), held, place, links]


def merge(blocks: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted pairs with their counts added up, over a heap of the blocks' next bounds."""
    at = [0] * len(blocks)
    bound = lambda i: int(blocks[i][0][min(at[i] + STEP, len(blocks[i][0])) - 1])
    heap = [(bound(i), i) for i in range(len(blocks)) if len(blocks[i][0])]
    heapq.heapify(heap)
    while heap:
        limit, _ = heap[0]  # no other block has an unseen step that ends before
        keys, counts, moved = [], [], []
        for _, i in heap:
            pairs, held = blocks[i]
            end = at[i] + int(np.searchsorted(pairs[at[i] : at[i] + STEP], limit, "right"))
            if end > at[i]:
                keys.append(pairs[at[i] : end])
                counts.append(held[at[i] : end])
                at[i] = end
                moved.append(i)
        rest = [x for x in heap if x[1] not in set(moved)]
        heap = rest + [(bound(i), i) for i in moved if at[i] < len(blocks[i][0])]
        heapq.heapify(heap)
        pairs, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, back, np.concatenate(counts))
        yield pairs, total


def spill(
    docs: DataFrame, a: str | None, b: str | None, text: str, key: str, with_groups: bool, run_records: int
) -> DataFrame:
    """Rows of two kinds: documents (``run``, ``place`` and what a text alone says), and blocks
    of runs (``run``, ``radix``, ``records``, ``block``)."""
    shared = docs.sparkSession.sparkContext.broadcast(files(a, b))  # the size of vocabularies
    schema = T.StructType(
        [T.StructField("key", docs.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("run", "place", "n_a", "n_b", "n_groups", "n_links")]
        + [T.StructField(c, T.StringType()) for c in ("groups_sha256", "groups")]
        + [T.StructField("radix", T.IntegerType()), T.StructField("records", T.LongType())]
        + [T.StructField("block", T.BinaryType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, arrow, runs = sides(shared.value), None, 0
        name = lambda: TaskContext.get().partitionId() << 32 | runs
        run = Run(name())

        def batch_of(columns: dict, n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow
            )

        def closed() -> Iterator[pa.RecordBatch]:
            for radix, records, block in run.blocks():
                yield batch_of({"run": [run.name], "radix": [radix], "records": [records], "block": [block]}, 1)

        for batch in batches:
            if arrow is None:
                kinds = {"key": batch.column(0).type, "radix": pa.int32(), "block": pa.binary(),
                         "groups": pa.string(), "groups_sha256": pa.string()}
                arrow = pa.schema([(n, kinds.get(n, pa.int64())) for n in schema.names])
            for first, last in _chunks(batch.column(1)):
                texts = [t or "" for t in batch.column(1)[first:last].to_pylist()]
                ids_a, ids_b = own.encode(texts)
                for i, t in enumerate(texts):
                    if not t or not own.covers(t, ids_a[i], ids_b[i]):
                        ids_a[i], ids_b[i] = [], []
                aligned = Aligned(own, ids_a, ids_b)
                said = aligned.written()
                rows, pairs, links = aligned.records()
                n = len(texts)
                if run.documents and (run.size + len(rows) > run_records or run.documents + n > RUN_DOCUMENTS):
                    yield from closed()
                    runs += 1
                    run = Run(name())
                run.add(rows, pairs, links)
                yield batch_of(
                    {
                        "key": batch.column(0)[first:last],
                        "run": np.full(n, run.name),
                        "place": np.arange(run.documents, run.documents + n),
                        "n_a": aligned.n_a, "n_b": aligned.n_b,
                        "n_groups": aligned.n_groups, "n_links": aligned.n_links,
                        "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said],
                        **({"groups": said} if with_groups else {}),
                    },
                    n,
                )
                run.documents += n
        if arrow is not None:
            yield from closed()

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(work, schema)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``CHUNK`` bytes, of one row at least and ``SEGMENT`` at most."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(sizes.astype(np.int64)), 0
    while first < len(texts):
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        last = min(last, first + SEGMENT)
        yield first, last
        first = last


def _dealt(blocks: DataFrame, task_records: int) -> tuple[DataFrame, dict[int, int]]:
    """Blocks with a ``slot``: as many for a radix as its records need; and slots by radix."""
    sizes = blocks.groupBy("radix").agg(F.sum("records").alias("n")).collect()  # one row a radix
    slots = {r["radix"]: max(1, math.ceil(r["n"] / task_records)) for r in sizes}
    many = F.get(F.lit([slots.get(r, 1) for r in range(_RADICES)]), F.col("radix"))
    return blocks.withColumn("slot", F.pmod(F.xxhash64("run"), many).cast("int")), slots


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``radix``, ``pair`` and ``n``, the documents that hold the pair, from dealt blocks."""

    def work(group: pa.Table) -> pa.Table:
        radix, runs = group["radix"][0].as_py(), []
        for block in group["block"]:
            runs.append(tuple(_read(block.as_py())[:2]))
        merged = list(merge(runs))
        pairs, counts = (np.concatenate(x) for x in zip(*merged))
        return pa.table({"radix": pa.array(np.full(len(pairs), radix), pa.int32()), "pair": pairs, "n": counts})

    partial = blocks.select("radix", "slot", "block").groupBy("radix", "slot")
    return partial.applyInArrow(work, "radix int, pair long, n long").groupBy("radix", "pair").agg(F.sum("n").alias("n"))


def _counted(counts: DataFrame) -> DataFrame:
    """One block a radix: its pairs in order, their counts, and whether the highest of their id of A."""

    def work(group: pa.Table) -> pa.Table:
        radix = group["radix"][0].as_py()
        pairs, n = group["pair"].to_numpy(), group["n"].to_numpy()
        order = np.argsort(pairs)
        pairs, n = pairs[order], n[order]
        starts = np.flatnonzero(np.diff(pairs >> 16, prepend=-1))
        most = np.repeat(np.maximum.reduceat(n, starts), np.diff(starts, append=len(n)))
        block = pack(np.diff(pairs, prepend=0), n, (n == most).astype(np.int64))
        return pa.table({"radix": pa.array([radix], pa.int32()), "counted": pa.array([block], pa.binary())})

    return counts.groupBy("radix").applyInArrow(work, "radix int, counted binary")


def _gains(dealt: DataFrame, counted: DataFrame) -> DataFrame:
    """``run``, ``gains``: for a run and radix, best links and sums of counts by place."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        runs, blocks = [], []
        if right.num_rows:
            steps, n, best = unpack(right["counted"][0].as_py())
            known = np.cumsum(steps)
            for run, block in zip(left["run"].to_pylist(), left["block"]):
                pairs, held, place, links = _read(block.as_py())
                at = np.repeat(np.searchsorted(known, pairs), held)
                sums = np.zeros((2, int(place.max()) + 1), np.int64)
                np.add.at(sums[0], place, links * best[at])
                np.add.at(sums[1], place, links * n[at])
                runs.append(run)
                blocks.append(pack(sums[0], sums[1]))
        return pa.table({"run": pa.array(runs, pa.int64()), "gains": pa.array(blocks, pa.binary())})

    left = dealt.select("radix", "slot", "run", "block").groupBy("radix", "slot")
    return left.cogroup(counted.groupBy("radix", "slot")).applyInArrow(work, "run long, gains binary")


def _by_document(gains: DataFrame) -> DataFrame:
    """``run``, ``place``, ``n_best``, ``count_sum``: a run's gains over all radices."""

    def work(group: pa.Table) -> pa.Table:
        run, total = group["run"][0].as_py(), np.zeros((2, 0), np.int64)
        for block in group["gains"]:
            best, counts = unpack(block.as_py())
            if len(best) > total.shape[1]:
                total = np.pad(total, ((0, 0), (0, len(best) - total.shape[1])))
            total[0, : len(best)] += best
            total[1, : len(best)] += counts
        n = total.shape[1]
        return pa.table({"run": np.full(n, run, np.int64), "place": np.arange(n), "n_best": total[0], "count_sum": total[1]})

    return gains.groupBy("run").applyInArrow(work, "run long, place long, n_best long, count_sum long")


def align(
    docs: DataFrame,
    a: str | None = None,
    b: str | None = None,
    text: str = "text",
    key: str = "doc_id",
    with_groups: bool = False,
    run_records: int = RUN_RECORDS,
    task_records: int = TASK_RECORDS,
) -> DataFrame:
    """Per document: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``, and ``groups`` itself if wanted.

    A reads a space and the text, B the text, to which it adds the space; strings of special
    tokens are plain text. ``n_best`` counts links whose pair is in as many documents
    as any pair of its id of A, ties included, ``count_sum`` adds up the documents of each
    link's pair. NULL and empty texts, and those whose tokens are not their bytes, have no
    tokens: zeros, and an empty ``groups_sha256``. Repeated rows and keys, NULL keys among
    them, are documents of their own; an empty table gives no rows. Other columns are not read.
    """
    spilled = stage(spill(docs, a, b, text, key, with_groups, run_records), "alignment")
    blocks = spilled.filter("block is not null").select("run", "radix", "records", "block")
    dealt, slots = _dealt(blocks, task_records)
    counted = stage(_counted(pair_counts(dealt)), "pair-counts")
    many = F.get(F.lit([slots.get(r, 1) for r in range(_RADICES)]), F.col("radix"))
    copies = counted.withColumn("slot", F.explode(F.sequence(F.lit(0), many - 1)))
    gains = _by_document(_gains(dealt, copies))
    known = spilled.filter("block is null").drop("radix", "records", "block")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return known.join(gains, ["run", "place"], "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"),
        "groups_sha256", *(["groups"] if with_groups else []),
    )
