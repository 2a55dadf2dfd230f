"""Texts of an Arrow batch as flat numpy arrays: words, lines, n-grams and their hashes.

Words are runs of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``).
All functions work on many texts at once and on whole texts; memory follows
``PIECE_BYTES`` or the longest single text, whichever is larger. Null texts
read as empty.

Hashes are 64-bit polynomials over randomly drawn byte codes, finished by a
bijective mixer. Two different strings share one with probability 2**-64 or
so; callers that compare across a corpus take two with different seeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the offsets of each text in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n, first = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int64)[first : first + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``most`` bytes of text, one row at least."""
    texts = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at, n = 0, batch.num_rows
    while at < n:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _codes(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def _base(seed: int) -> tuple[int, int]:
    base = int(np.random.default_rng(seed + 1000).integers(1 << 60, 1 << 61)) * 8 + 5
    base %= 1 << 64
    return base, pow(base, -1, 1 << 64)


# Powers are products of two short tables, a row and a column, so that no worker
# keeps a number for each byte of a text.
COLUMN = 1 << 10
_powers: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int, seed: int, inverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """First powers of the seed's base or of its inverse: of every ``COLUMN``-th exponent up to ``n``, and of those below ``COLUMN``."""
    rows = n // COLUMN + 1
    if len(_powers.get((seed, inverse), ((),))[0]) < rows:
        value = _base(seed)[inverse]
        tables = []
        for step, size in ((pow(value, COLUMN, 1 << 64), rows), (value, COLUMN)):
            table = np.full(size, step, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[seed, inverse] = tuple(tables)
    return _powers[seed, inverse]


def powers(n: int, seed: int) -> np.ndarray:
    """First ``n`` powers of the seed's base, modulo 2**64."""
    rows, column = _tables(n, seed, False)
    return np.multiply.outer(rows[: n // COLUMN + 1], column).reshape(-1)[:n]


def inverse_powers(at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Powers of the inverse of the seed's base at exponents ``at`` below ``n``, modulo 2**64."""
    rows, column = _tables(n, seed, True)
    return rows[at // COLUMN] * column[at % COLUMN]


def sums(values: np.ndarray, seed: int) -> np.ndarray:
    """Prefix sums of ``values * base**i``, from which ``spans`` takes hashes."""
    out = np.zeros(len(values) + 1, np.uint64)
    powered = powers(len(values), seed)
    np.cumsum(np.multiply(values, powered, out=powered), out=out[1:])
    return out


def spans(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of the spans ``[start, end)`` of what ``sums`` has seen."""
    raw = (prefix[ends] - prefix[starts]) * inverse_powers(starts, len(prefix), seed)
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Words of a run of texts: byte positions, owner, and hashes on demand."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n_texts = data, offsets, len(offsets) - 1
        inside = ~SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:] = ~inside[:-1]
        after[:-1] = ~inside[1:]
        self.inside = inside
        self.starts = np.flatnonzero(inside & (before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (after | edge[1:])) + 1
        self.owner = np.searchsorted(offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.owner, minlength=self.n_texts)
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)])

    def hashes(self, seed: int = 0) -> np.ndarray:
        return spans(sums(_codes(seed)[self.data], seed), self.starts, self.ends, seed)

    def windows(self, hashes: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``n`` words within one text."""
        last = len(hashes) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.owner[:last] == self.owner[n - 1 :])
        return at, spans(sums(hashes, seed), at, at + n, seed)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur twice or more."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return np.zeros(len(keys), bool)
    again = np.unique(again)
    at = np.minimum(np.searchsorted(again, keys), len(again) - 1)
    return again[at] == keys


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` positions some ``[start, start + length)`` covers."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, n), -1)
    return np.cumsum(change[:-1]) > 0


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one for each position) over each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
