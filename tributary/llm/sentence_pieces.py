"""SentencePiece ids of whole texts by a table over prefixes, and the way back.

A merge-type vocabulary joins, again and again, the neighbours whose union has the
best score, the leftmost first. Joins inside the final pieces happen in the same
order whatever stands beside them. So each part of a result is the result of its own text,
and pieces of which all neighbours stay apart by themselves are a result. Hence the last
piece of each prefix is unique: it ends there, and the last piece of the prefix before it
does not join with any part of it. ``Vocabulary.encode`` fills that table from left to
right: an automaton reports the pieces that end at each place, and a test of the pair,
remembered for the next time, picks the right one. Ids are then read backwards.

No join crosses two characters that stand side by side in no piece, so texts are cut
there: into blanks with a run of letters of one script, a run of marks, or one other
character. Such words are taken from memory if they were met before. Work is one pass,
row by row independent, so a lost executor repeats only its own splits.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = "▁"  # stands for a space
KNOWN_WORDS = 450_000  # words remembered by a worker; those not met again among as many are dropped
KNOWN_LENGTH = 64  # characters; longer words are not remembered
KNOWN_PAIRS = 500_000  # pairs of pieces remembered by a worker
_BATCH = 1 << 20  # characters handed on at once
_vocabularies: dict[str, "Vocabulary"] = {}


def model(path: str | None = None) -> bytes:
    """The file of a public vocabulary."""
    import public_tokenizers

    return Path(path or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()


def vocabulary(proto: bytes) -> Vocabulary:
    """The vocabulary of a model file; read once in each worker."""
    name = hashlib.sha256(proto).hexdigest()
    if name not in _vocabularies:
        _vocabularies[name] = Vocabulary(proto)
    return _vocabularies[name]


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("tributary.each_byte", _each_byte)


class _Words(dict):
    """Ids of words, as bytes; unknown words are encoded when they are asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= KNOWN_WORDS:
                self.older = self.copy()
                self.clear()
            self[word] = ids
        return ids


def _cutter(pieces: list[str], characters: set[str]) -> Callable[[str], list[str]]:
    """Cuts a text where no piece has both neighbours; all parts together are the text."""
    if any(BLANK in piece.lstrip(BLANK) for piece in pieces):
        return lambda text: [text]
    group = {c: c for c in characters}

    def of(c: str) -> str:
        while group[c] != c:
            group[c] = c = group[group[c]]
        return c

    for piece in pieces:
        inner = piece.lstrip(BLANK)
        for one, two in zip(inner, inner[1:]):
            group[of(one)] = of(two)
    scripts = defaultdict(str)
    for c in sorted(characters - {BLANK}):
        scripts[of(c)] += re.escape(c)
    runs = [f"[{cs}]+" for c, cs in scripts.items() if cs != re.escape(c)]
    alone = "".join(cs for c, cs in scripts.items() if cs == re.escape(c))
    known = "".join(scripts.values())
    runs = sorted(runs, key=len, reverse=True) + ([f"[{alone}]"] if alone else [])
    either = "|".join(runs)
    return re.compile(f"{BLANK}*(?:{either})|{BLANK}+|[^{BLANK}{known}]+").findall


class Vocabulary:
    """Pieces, scores and byte ids of a merge-type model without text normalisation.

    Raises for a model that changes texts beyond blanks, has no bytes to fall back to, or joins
    characters that are no pieces.
    """

    def __init__(self, proto: bytes):
        import ahocorasick
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_proto=proto)
        plain = read.normalize("Ａ  b ﬁ ")
        self.lead = BLANK if plain.startswith(BLANK) else ""
        if plain != self.lead + "Ａ  b ﬁ ".replace(" ", BLANK):
            raise ValueError("the model normalises texts")
        self.byte_ids: dict[int, int] = {}
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.pieces: list[str] = []
        self.surface: list[bytes] = []  # of each id
        for i in range(read.get_piece_size()):
            piece = read.id_to_piece(i)
            self.pieces.append(piece)
            if read.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif read.is_control(i):
                self.surface.append(b"")
            elif read.is_unknown(i):
                self.surface.append(read.decode([i]).encode())
            else:
                self.scores[piece], self.ids[piece] = read.get_score(i), i
                self.surface.append(piece.replace(BLANK, " ").encode())
            if read.is_unused(i):
                raise ValueError("the model has unused pieces")
        self.characters = {c for piece in self.scores for c in piece}
        if len(self.byte_ids) < 256 or not self.characters <= set(self.scores):
            raise ValueError("the model lacks bytes or single characters")
        self.blank_first = [p.startswith(BLANK) for p in self.pieces]
        self.lengths = [len(p) for p in self.pieces]
        self.controls = {i for i, said in enumerate(self.surface) if not said}
        self.words = _cutter(list(self.scores), self.characters)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.known = _Words(self._word)
        self.apart: list[dict[int, bool]] = [{} for _ in range(len(self.pieces) + 1)]  # by the first, then the second
        self.tests = 0  # pairs remembered

    def joined(self, text: str) -> list[str]:
        """The rule itself, for short texts: join the best neighbours until none is a piece."""
        parts = list(text)
        while True:
            scores = [self.scores.get(a + b) for a, b in zip(parts, parts[1:])]
            found = [(score, -i) for i, score in enumerate(scores) if score is not None]
            if not found:
                return parts
            at = -max(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fits(self, before: int, piece: int) -> bool:
        """Whether the two pieces stay as they are beside each other; -1 is the start."""
        wanted = [self.pieces[i] for i in (before, piece) if i >= 0]
        fits = self.joined("".join(wanted)) == wanted
        self.tests += 1
        if self.tests > KNOWN_PAIRS:
            self.tests = 0
            for row in self.apart:
                row.clear()
        self.apart[before][piece] = fits
        return fits

    def prefixes(self, word: str) -> list[int]:
        """The last piece of each prefix, the shortest first, then -1, which stands for the start.

        ``word`` has characters of the vocabulary only. Index -1 is in front of the word.
        """
        last = [-1] * (len(word) + 1)
        apart = self.apart
        for end, (piece, length) in self.automaton.iter(word):
            if last[end] < 0:
                before = last[end - length]
                fits = apart[before].get(piece)
                if fits or fits is None and self._fits(before, piece):
                    last[end] = piece
        return last

    def _word(self, word: str) -> bytes:
        if self.characters.issuperset(word):
            return self._ids(word).tobytes()
        ids = array("i")
        for inside, run in groupby(word, self.characters.__contains__):
            part = "".join(run)
            ids.extend(self._ids(part) if inside else (self.byte_ids[b] for b in part.encode()))
        return ids.tobytes()

    def _ids(self, word: str) -> array:
        last, at, lengths = self.prefixes(word), len(word) - 1, self.lengths
        ids = array("i")
        while at >= 0:
            piece = last[at]
            ids.append(piece)
            at -= lengths[piece]
        ids.reverse()
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, 4 bytes each."""
        if not text:
            return b""
        words = self.words(self.lead + text.replace(" ", BLANK))
        return b"".join(map(self.known.__getitem__, words))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; a byte that is no part of a character becomes U+FFFD."""
        controls = self.controls
        if not controls.isdisjoint(ids):  # nothing is joined across a control id
            said = [list(run) for control, run in groupby(ids, controls.__contains__) if not control]
            return "".join(self._said(run, not i) for i, run in enumerate(said))
        return self._said(ids, True)

    def _said(self, ids: list[int], first: bool) -> str:
        text = b"".join(map(self.surface.__getitem__, ids))
        if first and self.lead and ids and self.blank_first[ids[0]]:
            text = text[1:]
        return text.decode("utf-8", "tributary.each_byte")


def _slices(texts: pa.Array, weights: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``_BATCH`` together, of one row at least."""
    ends, first = np.cumsum(weights), 0
    while first < len(texts):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + _BATCH, "right")))
        yield first, last
        first = last


def encode(
    docs: DataFrame, vocabulary_path: str | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key`` and ``ids``: all ids of each text, without begin and end marks.

    NULL and empty texts have no ids. Repeated rows and keys, NULL keys among them, are
    rows of their own; an empty table gives no rows. Characters outside the vocabulary
    become the ids of their bytes, and no string in a text is special. No other column
    is read, whatever its name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model(vocabulary_path))  # a vocabulary's size
    kind = T.StructType([T.StructField("_key", docs.schema[key].dataType),
                         T.StructField("_ids", T.ArrayType(T.IntegerType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(shared.value)
        for batch in batches:
            texts = batch.column(1)
            for first, last in _slices(texts, _lengths(texts)):
                made = [own.encode(t or "") for t in texts[first:last].to_pylist()]
                ends = np.cumsum([0, *(len(m) // 4 for m in made)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(made), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], lists], kind.names)

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(work, kind).toDF(key, "ids")


def _lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text, or items of each list; NULL has none."""
    import pyarrow.compute as pc

    count = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    return pc.fill_null(count(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def decode(
    encoded: DataFrame, vocabulary_path: str | None = None, ids: str = "ids", key: str = "doc_id"
) -> DataFrame:
    """``key``, ``ids`` and ``text``: what the ids say. NULL and empty lists say nothing."""
    shared = encoded.sparkSession.sparkContext.broadcast(model(vocabulary_path))
    kind = T.StructType([T.StructField("_key", encoded.schema[key].dataType),
                         T.StructField("_ids", T.ArrayType(T.IntegerType())),
                         T.StructField("_text", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(shared.value)
        for batch in batches:
            lists = batch.column(1)
            for first, last in _slices(lists, _lengths(lists)):
                part = batch.slice(first, last - first)
                said = [own.decode(x or []) for x in part.column(1).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array(said, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, kind.names)

    narrow = encoded.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{ids}`").cast("array<int>").alias("_ids"))
    return narrow.mapInArrow(work, kind).toDF(key, "ids", "text")


def digest(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of ``decode``: number and digest of the ids, and digest of the text."""
    listed = F.array_join(F.coalesce("ids", F.array().cast("array<int>")).cast("array<string>"), ",")
    return decoded.select(
        F.col(f"`{key}`"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
