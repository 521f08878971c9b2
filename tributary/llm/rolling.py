"""Words and rolling hashes of UTF-8 texts, vectorised over Arrow batches.

The helpers run inside Spark tasks. A text is handled as its UTF-8 bytes: all
separators used here are ASCII, so a byte never belongs to two classes. Hashes are
polynomials modulo two primes, 62 bits together, mixed to 64 (modulo a power of two, texts made
after the Thue-Morse sequence would collide for any base); where a result must be exact, the caller
confirms on the bytes or words. Memory is about 100 bytes for each byte of a chunk, and a
chunk is one text or a run of texts of ``CHUNK`` bytes together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CHUNK = 1 << 19  # bytes handled at once

_PRIMES = (2**31 - 1, 2**31 - 19)  # products of two residues fit 64 bits
_some = np.random.default_rng(7)
_BASES = tuple(int(_some.integers(1 << 20, p - 1)) for p in _PRIMES)
_BYTE = np.stack([_some.integers(1, p, 256, dtype=np.uint64) for p in _PRIMES])
_powers: dict[tuple[int, int], np.ndarray] = {}


def by_place(docs: DataFrame) -> DataFrame:
    """The columns under plain names, as ``mapInArrow`` can't take names with dots."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def _rest(x: np.ndarray, prime: int) -> np.ndarray:
    """x modulo a prime; division by a constant is faster than numpy's remainder."""
    p = np.uint64(prime)
    return x - x // p * p


def _power(base: int, prime: int, size: int) -> np.ndarray:
    """1, base, base**2 ... modulo a prime, by doubling; kept for the next chunk while small."""
    known = _powers.get((base, prime))
    if known is None or len(known) < size:
        known = np.ones(1, np.uint64)
        while len(known) < size:
            step = np.uint64(pow(base, len(known), prime))
            known = np.concatenate((known, _rest(known * step, prime)))
        if size <= 4 * CHUNK:
            _powers[base, prime] = known
    return known[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix(residues: np.ndarray) -> np.ndarray:
    """Prefix sums of residue times power, one row a prime, with a leading zero."""
    out = np.zeros((len(_PRIMES), residues.shape[1] + 1), np.uint64)
    for own, values, base, prime in zip(out, residues, _BASES, _PRIMES):
        products = _rest(values * _power(base, prime, len(values)), prime)
        own[1:] = _rest(np.cumsum(products), prime)
    return out


def spans_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span, the same wherever it stands."""
    both = mix((ends - starts).astype(np.uint64))
    for own, base, prime, bits in zip(sums, _BASES, _PRIMES, (0, 31)):
        back = _power(pow(base, -1, prime), prime, len(own))
        between = _rest(own[ends] + np.uint64(prime) - own[starts], prime)
        both = both + (_rest(between * back[starts], prime) << np.uint64(bits))
    return mix(both)


def bytes_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTE[:, data])


def hashes_prefix(hashes: np.ndarray) -> np.ndarray:
    return prefix(np.stack([_rest(hashes, p) for p in _PRIMES]))


@dataclass
class Chunk:
    """Texts ``first .. first+rows-1`` of a batch: bytes and where each text starts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """Cut a text column into runs of whole texts; NULL is as an empty text."""
    column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield Chunk(first, data[own[0] : own[-1]], own - own[0])
        first = last


@dataclass
class Words:
    """Byte ranges of the words of a chunk; ``first[i]`` is the first word of row i."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def runs(chunk: Chunk, flag: np.ndarray) -> Words:
    """Maximal runs of flagged bytes, never across texts."""
    n = len(flag)
    inner = chunk.offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begins, stops = flag.copy(), flag.copy()
    if n:
        begins[1:] &= ~flag[:-1]
        begins[inner] = flag[inner]
        stops[:-1] &= ~flag[1:]
        stops[inner - 1] = flag[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(starts, ends, np.searchsorted(starts, chunk.offsets))


def windows(hashes: np.ndarray, words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of ``n`` words inside one text."""
    rows = words.row
    at = np.arange(max(len(hashes) - n + 1, 0))
    at = at[rows[at] == rows[at + n - 1]]
    return at, spans_hash(hashes_prefix(hashes), at, at + n)


def covered(at: np.ndarray, n: int | np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in a window [at, at+n)."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return np.cumsum(change[:-1]) > 0


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; rows may be empty."""
    sums = np.concatenate(([0], np.cumsum(values.astype(np.int64))))
    return sums[first[1:]] - sums[first[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out
