"""Vectorised word splitting and hashing of Arrow text columns.

Everything works on whole texts.  A record batch is cut into chunks of a few
megabytes of text, so that temporary arrays stay small whatever Spark's batch
size is; a single longer text is one chunk of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 3 << 20

_SPACE = {9, 10, 11, 12, 13, 32}


def _table(fold: bool, keep) -> bytes:
    out = bytearray(range(256))
    for b in range(256):
        if fold and 65 <= b <= 90:
            out[b] = b + 32
        if b in _SPACE or not keep(out[b]):
            out[b] = 32
    return bytes(out)


#: Words between ASCII white space, unchanged.
RAW = _table(False, lambda b: True)
#: The same with A-Z lower-cased.
FOLDED = _table(True, lambda b: True)
#: Lower-cased runs of ASCII letters, digits and anything beyond ASCII.
ALNUM = _table(True, lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)


@dataclass
class Words:
    """codes: a dictionary index per word; bounds: first word of each text, and the end."""

    codes: np.ndarray
    bounds: np.ndarray
    dictionary: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        return dictionary_hashes(self.dictionary, seed)[self.codes]

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def dictionary_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def split_words(texts: pa.Array, table: bytes) -> Words:
    """Words of each text after a byte-wise translation; null has none."""
    offsets, data = text_bytes(texts)
    folded = data.tobytes().translate(table)
    strings = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(folded)])
    lists = pc.ascii_split_whitespace(strings.view(pa.large_string()))
    flat = lists.flatten()
    bounds = np.asarray(lists.offsets, np.int64)
    bounds = bounds - bounds[0]
    filled = np.asarray(pc.not_equal(flat, "").to_numpy(zero_copy_only=False), bool)
    if not filled.all():
        flat = flat.filter(pa.array(filled))
        bounds = np.concatenate([[0], np.cumsum(filled)])[bounds]
    coded = flat.dictionary_encode()
    return Words(np.asarray(coded.indices, np.int64), bounds, coded.dictionary)


def _give_back() -> None:
    """Hand freed memory back: a worker is kept for later tasks, and others need the room meanwhile."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, or one text."""
    # Arrow's own allocator keeps what it frees
    pa.set_memory_pool(pa.system_memory_pool())
    yield from _chunks(batches, column, limit)
    _give_back()


def _chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.nan_to_num(np.asarray(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), float))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


_BASES: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_ODD = {1: 0x9E3779B97F4A7C15, 2: 0xC2B2AE3D27D4EB4F}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _BASES.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base = _ODD[which]
        inverse = pow(base, -1, 1 << 64)
        both = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _BASES[which] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(words: np.ndarray, width: int, which: int = 1) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive word hashes."""
    n = len(words)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = _powers(which, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up, out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * down[: n - width + 1])


def window_starts(bounds: np.ndarray, width: int) -> np.ndarray:
    """The starts of all windows that lie within one text."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    total = int(counts.sum())
    first = np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts)
    return first + np.arange(total)
