"""Length buckets with the least padding, and token-budget batches inside each.

Texts are cut into pieces of at most ``longest`` tokens, so the histogram of lengths has a fixed number of bins whatever the data; dynamic
programming over it finds the bucket boundaries that pad least. The pieces
of a bucket are numbered by many tasks and dealt out to batches by number.

A token is a word between white space, or each ``WORD_CHARS`` characters of a longer one. Scripts
that write no blanks between words (``ALONE``) have a token for each character.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_counted
from . import rolling
from .numbering import ROWS_PER_SLICE, positions

LONGEST = 2048  # tokens of a piece
BUCKETS = 12
BUDGET = 32_768  # padded tokens of a batch

WORD_CHARS = 24  # characters of a word that count as one token

# First and last code points of scripts without blanks, and of pictographs.
ALONE = [
    (0x0E00, 0x0EFF),  # Thai, Lao
    (0x1000, 0x109F),  # Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x2E80, 0xA4CF),  # Chinese, Japanese, Yi
    (0xF900, 0xFAFF),  # compatibility ideographs
    (0x1F000, 0x3FFFF),  # pictographs, rare ideographs
]

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False


def _alone(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of the characters that begin at these bytes stand for themselves."""
    out = np.zeros(len(starts), bool)
    wide = np.flatnonzero(data[starts] >= 0xE0)  # three bytes and four
    if len(wide):
        at = starts[wide]
        byte = [data[np.minimum(at + i, len(data) - 1)].astype(np.int64) for i in range(4)]
        three = (byte[0] & 0x0F) << 12 | (byte[1] & 0x3F) << 6 | byte[2] & 0x3F
        four = (byte[0] & 0x07) << 18 | (byte[1] & 0x3F) << 12 | (byte[2] & 0x3F) << 6 | byte[3] & 0x3F
        point = np.where(byte[0] >= 0xF0, four, three)
        for low, high in ALONE:
            out[wide] |= (point >= low) & (point <= high)
    return out


def token_starts(chunk: rolling.Chunk) -> np.ndarray:
    """The byte at which each token begins."""
    data, word = chunk.data, _WORD[chunk.data]
    starts = np.flatnonzero((data & 0xC0) != 0x80)  # of characters
    alone = starts[_alone(data, starts)]
    if len(alone):
        change = np.zeros(len(data) + 1, np.int64)
        np.add.at(change, alone, 1)
        np.add.at(change, np.append(starts, len(data))[np.searchsorted(starts, alone) + 1], -1)
        word &= np.cumsum(change[:-1]) == 0
    words = rolling.runs(chunk, word)
    first = np.searchsorted(starts, words.starts)
    parts = -(-(np.searchsorted(starts, words.ends) - first) // WORD_CHARS)
    inside = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    found = starts[np.repeat(first, parts) + WORD_CHARS * inside]
    return np.sort(np.concatenate((found, alone)), kind="stable") if len(alone) else found


def pieces(
    docs: DataFrame,
    longest: int = LONGEST,
    text: str = "text",
    key: str = "doc_id",
    with_text: bool = False,
) -> DataFrame:
    """``key``, ``piece``, ``start``, ``n_chars``, ``n_tokens`` and, on request, the piece itself.

    A piece ends where the first token of the next begins, so the pieces of a text
    joined give the text. NULL and empty texts, and those of white space, are one
    piece of no tokens.
    """
    fields = [T.StructField(key, docs.schema[key].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "n_chars", "n_tokens")]
    if with_text:
        fields.append(T.StructField("piece_text", T.StringType()))
    schema = T.StructType(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in rolling.chunks(batch.column(1)):
                found = token_starts(chunk)
                own = np.searchsorted(found, chunk.offsets)  # the first token of each text
                lead = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80)))
                tokens = np.diff(own)
                n = np.maximum(1, -(-tokens // longest))
                row = np.repeat(np.arange(chunk.rows), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                # bytes where pieces begin: the text's own begin, or that of a token
                begin = chunk.offsets[row].copy()
                later = piece > 0
                begin[later] = found[own[row[later]] + piece[later] * longest]
                end = np.append(begin[1:], chunk.offsets[-1])
                last = np.append(piece[1:] == 0, True)
                end[last] = chunk.offsets[row[last] + 1]
                columns = [
                    batch.column(0).take(pa.array(row + chunk.first)),
                    pa.array(piece, pa.int32()),
                    pa.array(lead[begin] - lead[chunk.offsets[row]], pa.int64()),
                    pa.array(lead[end] - lead[begin], pa.int64()),
                    pa.array(np.minimum(tokens[row] - piece * longest, longest), pa.int64()),
                ]
                if with_text:
                    data = chunk.data.tobytes()
                    parts = (data[b:e] for b, e in zip(begin.tolist(), end.tolist()))
                    columns.append(pa.array(parts, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(key, text).mapInArrow(work, schema)


def boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """The upper ends of at most ``buckets`` buckets with the least padding in all.

    ``lengths`` ascend. ``least[k][j]`` is the least padding of the first ``j``
    lengths in ``k`` buckets; the last bucket pads to the j-th length.
    """
    size = np.asarray(lengths, np.float64)
    rows = np.concatenate(([0.0], np.cumsum(np.asarray(counts, np.float64))))
    total = np.concatenate(([0.0], np.cumsum(size * counts)))
    n = len(size)
    least = np.full(n + 1, np.inf)
    least[0] = 0.0
    choices = []
    for _ in range(min(buckets, n)):
        step, choice = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        step[0] = 0.0
        for j in range(1, n + 1):
            cost = least[:j] + size[j - 1] * (rows[j] - rows[:j]) - (total[j] - total[:j])
            choice[j] = int(np.argmin(cost))
            step[j] = cost[choice[j]]
        least = step
        choices.append(choice)
    ends, j = [], n
    for choice in reversed(choices):
        if j:
            ends.append(int(size[j - 1]))
            j = int(choice[j])
    return ends[::-1]


def _at(values: Sequence[int], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(int(v)) for v in values)), index.cast("int") + 1)


def pack(
    docs: DataFrame,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    longest: int = LONGEST,
    text: str = "text",
    key: str = "doc_id",
    with_text: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The pieces with ``bucket``, ``bucket_tokens``, ``batch``, ``slot`` and ``padding``.

    A batch of a bucket holds as many pieces as fit the budget when each is padded to
    ``bucket_tokens`` (one at least); only the last batch of a bucket may hold fewer.
    Batches are numbered inside their bucket, slots inside their batch, from 0.
    Repeated rows and NULL keys are packed row by row, an empty table gives no rows, and
    columns besides key and text are not read.
    """
    cut = pieces(docs, longest, text, key, with_text)
    named = cut.withColumnRenamed(key, "_key").withColumn("_row", F.monotonically_increasing_id())
    rows, count = stage_counted(named, "pieces")
    histogram = sorted(rows.groupBy("n_tokens").count().collect())  # at most ``longest`` + 1 rows
    ends = boundaries(*zip(*histogram), buckets) if histogram else [longest]
    sizes = [max(1, budget // max(1, e)) for e in ends]
    bucket = F.size(F.filter(F.array(*(F.lit(e) for e in ends)), lambda e: e < F.col("n_tokens")))
    ranked = positions(
        rows.withColumn("bucket", bucket), "bucket", count, rows_per_slice=rows_per_slice
    )
    size = _at(sizes, F.col("bucket"))
    full = ranked.withColumn("bucket_tokens", _at(ends, F.col("bucket")).cast("long"))
    shown = ["piece", "start", "n_chars", "n_tokens", *(["piece_text"] if with_text else [])]
    return full.select(
        F.col("_key").alias(key),
        *shown,
        "bucket",
        "bucket_tokens",
        F.floor(F.col("_pos") / size).cast("long").alias("batch"),
        (F.col("_pos") % size).cast("int").alias("slot"),
        (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
    )
