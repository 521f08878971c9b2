"""Benchmark decontamination: windows of test items looked up in training texts.

The n-grams of the benchmark are normalised, hashed and broadcast in blocks of
at most about ``BLOCK`` entries, so that the size of a broadcast is bounded
whatever the benchmark's size: a larger one takes several passes over the texts, one
block at a time, each of which writes its hits and gives its broadcast back before the
next is collected. The hits are merged by document. A window of a text whose hash is
in the set is confirmed by its words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from . import rolling

WINDOW = 10  # words
BLOCK = 500_000  # (window, item) entries of one broadcast: some 150 MB at most

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BITS = 22  # of the table that rejects most windows at once


def item_windows(items: DataFrame, size: int = WINDOW, key: str = "item_id", text: str = "text"):
    """Distinct (``window``, ``item``) pairs: words joined by blanks, and the item's id as text.

    An item of fewer words, but not none, is one window. Items with NULL text or
    without words have none; those with a NULL id go under the empty id.
    """
    words = F.regexp_extract_all(_lower(text), F.lit(_PATTERN), F.lit(0))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return (
        items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words.alias("w"))
        .filter(F.size("w") > 0)
        .withColumn("at", F.explode(starts))
        .select(F.array_join(F.slice("w", F.col("at") + 1, size), " ").alias("window"), "item")
        .distinct()
    )


class _Set:
    """One block of windows: exact words to items, and hashes for each length."""

    def __init__(self, entries: dict[bytes, list[str]]):
        self.entries, self.hashes, self.seen = entries, {}, {}
        parts = defaultdict(list)
        for chunk in rolling.chunks(pa.array(list(entries), pa.binary()).cast(pa.string())):
            words = rolling.runs(chunk, _WORD[chunk.data])
            hashes = rolling.spans_hash(
                rolling.bytes_prefix(chunk.data), words.starts, words.ends
            )
            counts, rows = np.diff(words.first), words.row
            for n in np.unique(counts).tolist():
                at, keys = rolling.windows(hashes, words, n)
                parts[n].append(keys[counts[rows[at]] == n])
        for n, keys in parts.items():
            self.hashes[n] = np.unique(np.concatenate(keys))
            self.seen[n] = np.zeros(1 << _BITS, bool)
            self.seen[n][self.hashes[n] >> np.uint64(64 - _BITS)] = True


def _hits(chunk: rolling.Chunk, wanted: _Set):
    """Words of the chunk, which of them are hit, and (row, item) pairs."""
    data = _LOWER[chunk.data]
    words = rolling.runs(chunk, _WORD[data])
    hashes = rolling.spans_hash(rolling.bytes_prefix(data), words.starts, words.ends)
    rows = words.row
    at, lengths, items = [], [], defaultdict(set)
    for n, known in wanted.hashes.items():
        first, keys = rolling.windows(hashes, words, n)
        maybe = np.flatnonzero(wanted.seen[n][keys >> np.uint64(64 - _BITS)])
        maybe = maybe[np.isin(keys[maybe], known)]
        for j in first[maybe]:
            parts = zip(words.starts[j : j + n], words.ends[j : j + n])
            found = wanted.entries.get(b" ".join(data[s:e].tobytes() for s, e in parts))
            if found:
                at.append(j)
                lengths.append(n)
                items[int(rows[j])].update(found)
    hit = rolling.covered(np.array(at, np.int64), np.array(lengths, np.int64), len(hashes))
    return words, hit, items


def _spans(chunk: rolling.Chunk, words: rolling.Words, hit: np.ndarray) -> dict[int, list]:
    """Runs of hit words by row: code points from and to, first and last word."""
    out = defaultdict(list)
    if hit.any():
        lead = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80)))
        rows = words.row
        new = np.ones(len(hit), bool)
        new[1:] = ~hit[:-1] | (rows[1:] != rows[:-1])
        starts = np.flatnonzero(hit & new)
        last = np.ones(len(hit), bool)
        last[:-1] = new[1:] | ~hit[1:]
        for s, e in zip(starts, np.flatnonzero(hit & last)):
            base = lead[chunk.offsets[rows[s]]]
            first = words.first[rows[s]]
            span = lead[words.starts[s]] - base, lead[words.ends[e]] - base, s - first, e - first
            out[int(rows[s])].append([int(x) for x in span])
    return out


_SPANS = T.ArrayType(T.ArrayType(T.LongType()))


def _scan(docs: DataFrame, text: str, block: Broadcast, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_hit``, ``spans`` and ``items`` of every row."""
    made = {"_words": T.LongType(), "_hit": T.LongType(), "_spans": _SPANS,
            "_items": T.ArrayType(T.StringType())}
    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField(c, t) for c, t in made.items()]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Set(block.value)
        for batch in batches:
            words, hits, spans, items = [], [], [], []
            for chunk in rolling.chunks(batch.column(batch.num_columns - 1)):
                own, hit, found = _hits(chunk, wanted)
                ranges = _spans(chunk, own, hit)
                words.extend(np.diff(own.first).tolist())
                hits.extend(rolling.per_row(hit, own.first).tolist())
                spans.extend([ranges.get(i, []) for i in range(chunk.rows)])
                items.extend([sorted(found.get(i, ())) for i in range(chunk.rows)])
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(words, pa.int64()), pa.array(hits, pa.int64())]
            columns += [pa.array(spans, pa.list_(pa.list_(pa.int64())))]
            columns += [pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(work, schema)


def _shared(windows: DataFrame, blocks: int, number: int) -> Broadcast:
    """One of ``blocks`` blocks of the windows, which is on the driver only in here.

    Entries are dealt out by a hash of window and item, so a window that very
    many items share is spread as well.
    """
    slot = F.pmod(F.xxhash64("window", "item"), F.lit(max(blocks, 1)))
    entries = defaultdict(list)
    for row in windows.filter(slot == number).collect():  # a block of rows
        entries[row["window"].encode()].append(row["item"])
    return windows.sparkSession.sparkContext.broadcast(dict(entries))


def _lower(text: str):
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(_PATTERN)), F.lit(0)).cast("long")


def _ranges(spans: str):
    return F.transform(spans, lambda s: F.slice(s, 1, 2))


_NO_SPANS, _NO_ITEMS = "cast(array() as array<array<bigint>>)", "cast(array() as array<string>)"


def _digest(text: str):
    return F.md5(F.coalesce(text, F.lit("")))


def _merged(docs: DataFrame, text: str, windows: DataFrame, blocks: int) -> DataFrame:
    """Hits of several blocks by text digest: ``_digest``, ``_spans``, ``_items``.

    Equal texts have equal hits, so copies collapse before the shuffle. The hits of a block
    are written before the next block is collected.
    """
    keyed = docs.select(_digest(text).alias("_digest"), text)
    windows = stage(windows, "windows")
    hits = None
    for number in range(blocks):
        shared = _shared(windows, blocks, number)
        scan = _scan(keyed, text, shared, ["_digest"]).filter("_hit > 0")
        found = stage(scan.select("_digest", "_spans", "_items").distinct(), "hits")
        shared.destroy(blocking=True)
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy("_digest").agg(
        F.array_sort(F.flatten(F.collect_set("_spans"))).alias("_ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("_items"),
    )
    last = lambda done: F.element_at(done, -1)
    runs = F.aggregate(  # runs of different blocks may overlap or follow each other
        "_ranges",
        F.expr(_NO_SPANS),
        lambda done, r: F.when(
            F.coalesce(F.get(F.get(done, F.size(done) - 1), F.lit(3)) + 1 >= r[2], F.lit(False)),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.array(last(done)[0], *(F.greatest(last(done)[i], r[i]) for i in (1, 2, 3)))),
            ),
        ).otherwise(F.concat(done, F.array(r))),
    )
    return hits.select("_digest", runs.alias("_spans"), "_items")


def find(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """Per document: ``key``, ``n_words``, ``n_hit``, ``spans`` (code points of runs of
    hit words) and ``items`` (ids, as text, of items with a window in it, sorted).

    A word is hit if any occurrence of a window covers it. NULL and empty texts
    have no words and no hits. Repeated rows and NULL keys are kept row by row;
    an empty benchmark hits nothing. Other columns are not read.
    """
    windows = item_windows(items, window)
    blocks = -(-windows.count() // block)
    if blocks <= 1:
        result = _scan(docs, text, _shared(windows, 1, 0), [key])
        return result.select(
            key,
            F.col("_words").alias("n_words"),
            F.col("_hit").alias("n_hit"),
            _ranges("_spans").alias("spans"),
            F.col("_items").alias("items"),
        )
    joined = docs.select(key, F.col(text).alias("_text"), _digest(text).alias("_digest")).join(
        _merged(docs, text, windows, blocks), "_digest", "left"
    )
    lower = _lower("_text")
    inside = F.transform("_spans", lambda s: _n_words(F.substr(lower, s[0] + 1, s[1] - s[0])))
    total = F.aggregate(inside, F.lit(0).cast("long"), lambda a, b: a + b)
    return joined.select(
        key,
        _n_words(lower).alias("n_words"),
        F.coalesce(total, F.lit(0)).alias("n_hit"),
        F.coalesce(_ranges("_spans"), F.expr(_NO_SPANS)).alias("spans"),
        F.coalesce("_items", F.expr(_NO_ITEMS)).alias("items"),
    )


def clean(
    docs: DataFrame,
    items: DataFrame,
    mode: str = "documents",
    text: str = "text",
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """The documents, with their columns, without what the benchmark contains.

    ``documents`` drops each document with a hit, ``spans`` cuts the hit runs out
    of the texts. Documents without hits stay as they are.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    windows = item_windows(items, window)
    blocks = -(-windows.count() // block)
    if blocks <= 1:
        return _cleaned(docs, text, _shared(windows, 1, 0), mode)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")  # names can't clash
    keyed = docs.select(whole, _digest(text).alias("_digest"))
    hits = _merged(docs, text, windows, blocks)
    if mode == "documents":
        left = keyed.join(hits.select("_digest"), "_digest", "left_anti")
        return left.select(*(F.col(f"_doc.`{c}`") for c in docs.columns))
    joined = keyed.join(hits, "_digest", "left")
    body = F.col(f"_doc.`{text}`")
    cut = F.aggregate(  # from the last run, so that earlier positions still hold
        F.reverse("_spans"),
        body,
        lambda t, s: F.concat(F.substr(t, F.lit(1), s[0]), F.substr(t, s[1] + 1)),
    )
    return joined.select(
        *((F.coalesce(cut, body) if c == text else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns)
    )


def _cleaned(docs: DataFrame, text: str, shared: Broadcast, mode: str) -> DataFrame:
    place, names = docs.columns.index(text), docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Set(shared.value)
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names)
            texts, hit_rows = batch.column(place), {}
            for chunk in rolling.chunks(texts):
                own, hit, _ = _hits(chunk, wanted)
                for i, ranges in _spans(chunk, own, hit).items():
                    hit_rows[chunk.first + i] = ranges
            if not hit_rows:
                yield batch
            elif mode == "documents":
                yield batch.filter(pa.array([i not in hit_rows for i in range(batch.num_rows)]))
            else:
                values = texts.to_pylist()
                for i, ranges in hit_rows.items():
                    for s, e, *_ in reversed(ranges):
                        values[i] = values[i][:s] + values[i][e:]
                made = pa.array(values, texts.type)
                yield batch.set_column(place, batch.schema.field(place), made)

    return rolling.by_place(docs).mapInArrow(work, docs.schema)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The counts of ``find`` with a digest of the item ids."""
    return found.select(
        key,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
