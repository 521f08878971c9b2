"""Quality rules by repetition coverage.

For several n-gram lengths, rolling hashes find the windows of words that occur
more than once in a text, and the characters inside them are measured against
the characters in all words; likewise the characters in repeated lines. Texts
of which too much repeats fail, as do very short ones.

Work is one pass over the texts, row by row independent: no shuffle, and a lost
executor repeats only its own splits. Lines are equal only if their bytes are, and windows
only if they have the same words, which are told apart by their bytes as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import rolling

#: Word windows that are measured, and the share of word characters above which
#: a text fails. Short windows repeat by chance in long texts, so they get more.
NGRAMS = {3: 0.60, 5: 0.40, 7: 0.35, 10: 0.30}
DUPLICATE_LINES = 0.50  # share of lines, and of characters in lines
SYMBOLS = 0.20  # symbols for each word character
MIN_WORDS = 50
REPEAT_WORDS = 50  # percent of words in repeated 3-word windows

_BLOCK = 1 << 18  # words numbered or compared at once
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _bytes_of(data: bytes, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [data[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def _numbers(data: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number for each span, equal for equal bytes alone: its hash, unless another span has that."""
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    out = hashes.copy()
    for at in range(0, len(hashes), _BLOCK):
        some = slice(at, at + _BLOCK)
        own, lead = _bytes_of(data, starts[some], ends[some]), first[back[some]]
        leads = _bytes_of(data, starts[lead], ends[lead])
        for i in [i for i, (a, b) in enumerate(zip(own, leads)) if a != b]:
            digest = hashlib.sha256(own[i] + out[at + i].tobytes()).digest()  # a collision
            out[at + i] = int.from_bytes(digest[:8], "little")
    return out


def _same_words(words: np.ndarray, at: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Windows of a key that occurs again, without those whose words differ from all others'."""
    at, keys = at[again := rolling.repeated(keys)], keys[again]
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]
    lead = np.zeros(len(at), np.int64)
    lead[1:] = np.where(keys[1:] != keys[:-1], np.arange(1, len(at)), 0)
    lead = at[np.maximum.accumulate(lead)]
    differs = np.zeros(len(at), bool)
    for k in range(n):
        differs |= words[at + k] != words[lead + k]
    if differs.any():  # a collision: compare by the words themselves
        _, back, times = np.unique(
            np.stack([keys, *(words[at + k] for k in range(n))]), axis=1, return_inverse=True, return_counts=True
        )
        return at[times[back.ravel()] > 1]
    return at


def _measure(chunk: rolling.Chunk, ngrams: tuple[int, ...]) -> dict[str, np.ndarray]:
    data, offsets = chunk.data, chunk.offsets
    flag = _WORD[data]
    words = rolling.runs(chunk, flag)
    sums = rolling.bytes_prefix(data)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before a byte
    chars = lead[words.ends] - lead[words.starts]
    hashes = rolling.spans_hash(sums, words.starts, words.ends)
    raw = data.tobytes()
    numbers = _numbers(raw, words.starts, words.ends, hashes)
    out = {
        "n_words": np.diff(words.first),
        "word_chars": rolling.per_row(chars, words.first),
        "n_symbols": rolling.per_row(_SYMBOL[data], offsets),
    }
    rows = words.row.astype(np.uint64)
    for n in ngrams:
        at, keys = rolling.windows(hashes, words, n)
        again = _same_words(numbers, at, rolling.mix(keys + rows[at]), n)
        inside = rolling.covered(again, n, len(hashes))
        out[f"repeat_words_{n}"] = rolling.per_row(inside, words.first)
        out[f"repeat_chars_{n}"] = rolling.per_row(np.where(inside, chars, 0), words.first)

    # lines: cut behind each line feed and at the end of each text
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    row = np.sort(
        np.concatenate((np.arange(chunk.rows), np.searchsorted(offsets, breaks, "right") - 1)),
        kind="stable",
    )
    ends = np.concatenate((starts[1:] - (row[1:] == row[:-1]), offsets[-1:]))
    with_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    row, starts, ends = row[with_word], starts[with_word], ends[with_word]
    keys = rolling.mix(rolling.spans_hash(sums, starts, ends) + row.astype(np.uint64))
    keys = _numbers(raw, starts, ends, keys)
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    line_chars = lead[ends] - lead[starts]
    count = lambda weight: np.bincount(row, weight, chunk.rows).astype(np.int64)
    out["n_lines"] = count(np.ones(len(row)))
    out["n_dup_lines"] = count(~first)
    out["line_chars"] = count(line_chars)
    out["dup_line_chars"] = count(np.where(first, 0, line_chars))
    return out


def _verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    base = (m["n_words"] < MIN_WORDS) | (100 * m["repeat_words_3"] > REPEAT_WORDS * m["n_words"])
    bad = base.copy()
    for n, share in NGRAMS.items():
        bad |= m[f"repeat_chars_{n}"] > share * m["word_chars"]
    bad |= m["n_dup_lines"] > DUPLICATE_LINES * m["n_lines"]
    bad |= m["dup_line_chars"] > DUPLICATE_LINES * m["line_chars"]
    bad |= m["n_symbols"] > SYMBOLS * m["word_chars"]
    return base, ~bad


def _batch(texts: pa.Array) -> dict[str, np.ndarray]:
    parts = []
    for chunk in rolling.chunks(texts):
        m = _measure(chunk, tuple(NGRAMS))
        m["base_failed"], m["kept"] = _verdict(m)
        parts.append(m)
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: the key, all measures, ``base_failed`` and ``kept``.

    NULL and empty texts have no words, so every count is 0 and they fail.
    Repeated rows and keys, NULL keys among them, are judged row by row; an empty
    table gives no rows. Only the key and the text are read, so no other column can clash.
    """
    grams = [f"repeat_{what}_{n}" for n in NGRAMS for what in ("words", "chars")]
    counts = [*COUNTS, "n_lines", "line_chars", "dup_line_chars", *grams]
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in counts]
        + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = _batch(batch.column(1))
                m["n_repeat_words"] = m["repeat_words_3"]
                made = [pa.array(m[c], pa.int64()) for c in counts]
                flags = [pa.array(m[c]) for c in ("base_failed", "kept")]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made, *flags], schema.names)

    return docs.select(key, text).mapInArrow(work, schema)


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns as they are, whatever their names."""
    place, names = docs.columns.index(text), docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = batch.filter(pa.array(_batch(batch.column(place))["kept"]))
                yield pa.RecordBatch.from_arrays(kept.columns, names)

    return rolling.by_place(docs).mapInArrow(work, docs.schema)
