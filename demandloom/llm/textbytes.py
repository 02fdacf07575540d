"""Vectorised text primitives used inside Arrow tasks: words, 64-bit word hashes, word windows.

Texts are handled as UTF-8 bytes, a bounded slice of a batch at a time, so a task needs a few
times ``SLICE_BYTES`` of memory (or a few times its longest text) whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once.
SLICE_BYTES = 1 << 20

_SEED = np.random.Generator(np.random.PCG64(20260117))
_BYTE_CODES = _SEED.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POSITION_CODES = _SEED.integers(1, 2**63, size=4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Separators of the contract's words: space and the controls 9 to 13.
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True

#: Separators that leave letters, digits and every byte of a non-ASCII character.
NOT_TERM = np.ones(256, dtype=bool)
NOT_TERM[ord("0") : ord("9") + 1] = False
NOT_TERM[ord("A") : ord("Z") + 1] = False
NOT_TERM[ord("a") : ord("z") + 1] = False
NOT_TERM[128:] = False


class Words(NamedTuple):
    """Words of a slice of texts, in text order."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    counts: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut record batches into runs of rows of about ``limit`` bytes; a NULL text is empty."""
    for batch in batches:
        texts = [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
        first, held = 0, 0
        for i, text in enumerate(texts):
            if held and held + len(text) > limit:
                yield batch.slice(first, i - first), texts[first:i]
                first, held = i, 0
            held += len(text) + 1
        if first < len(texts):
            yield batch.slice(first), texts[first:]


def find_words(texts: list[bytes], separators: np.ndarray = SPACES) -> Words:
    """Maximal runs of bytes that are no separators; a word never crosses texts."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lengths = np.fromiter((len(x) + 1 for x in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    gap = separators[data]
    inside = np.diff(np.concatenate(([1], gap.view(np.int8))))
    starts = np.flatnonzero(inside == -1)
    ends = np.flatnonzero(inside == 1)
    # the closing separator of each text ends its last word
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)
    doc = np.repeat(np.arange(len(texts)), counts)
    return Words(starts, ends, doc, counts, data, offsets)


class Hasher:
    """Hashes any byte range of a slice from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray, lower: bool = False) -> None:
        codes = _BYTE_CODES[LOWER] if lower else _BYTE_CODES
        powers, inverses = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes[data] * powers[:-1], out=self.prefix[1:])
        self.inverses = inverses

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.prefix[ends] - self.prefix[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_CACHE: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("powers", ())) < n:
        size = max(n, SLICE_BYTES + 4096)
        for name, base in (("powers", _BASE), ("inverses", _BASE_INVERSE)):
            out = np.full(size, np.uint64(base))
            out[0] = 1
            _CACHE[name] = np.cumprod(out)
    return _CACHE["powers"][:n], _CACHE["inverses"][:n]


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes, by the run's first word."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(count, np.uint64(size))
    for i in range(size):
        total += words[i : i + count] * _POSITION_CODES[i % 4096]
    return mix(total)
