"""Words of whole Arrow text columns as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D.  Everything here
works on a slice of consecutive documents at once (at most ``SLICE`` text
bytes, or one document), so memory is bounded whatever the batch holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
SLICE_ROWS = 1 << 15
LONG_WORD = 64

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Words(NamedTuple):
    data: np.ndarray   # bytes of the slice, lower-cased if asked for
    doc: np.ndarray    # document index of each word
    start: np.ndarray  # first byte of each word
    end: np.ndarray    # byte after the last
    hash: np.ndarray   # 64-bit hash of each word
    n_docs: int


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` text bytes each."""
    if not batch.num_rows:
        return
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    a = 0
    while a < batch.num_rows:
        b = int(np.searchsorted(total, total[a] + limit, "right")) - 1
        b = min(max(b, a + 1), a + SLICE_ROWS, batch.num_rows)
        yield batch.slice(a, b - a)
        a = b
    pa.default_memory_pool().release_unused()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array; nulls are empty."""
    if texts.null_count:
        texts = pa.compute.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    off = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def words_of(texts: pa.Array, fold: bool = False) -> Words:
    """All words of a text column; ``fold`` lower-cases A-Z first."""
    data, off = buffers(texts)
    if fold:
        data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))
    n = len(data)
    ink = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    edge = off[:-1][off[:-1] < off[1:]]
    first[edge] = ink[edge]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    tail = off[1:][off[:-1] < off[1:]] - 1
    last[tail] = ink[tail]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(off, start, "right") - 1
    if n:
        power = np.full(n, _BASE, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, out=total[1:])
        back = np.full(n, _INV, np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        h = mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64) * _STEP)
        # the sum is linear modulo 2^64: words long enough to be built to collide get a digest
        for i in np.flatnonzero(end - start > LONG_WORD):
            h[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    else:
        h = np.zeros(0, np.uint64)
    return Words(data, doc, start, end, h, len(texts))


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every window of ``k`` words; window i starts at
    word i, windows that would leave their document have document -1."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.full(n, np.uint64(k), np.uint64)
    for t in range(k):
        acc = acc * _STEP + words.hash[t:t + n]
    return mix(acc), np.where(words.doc[:n] == words.doc[k - 1:], words.doc[:n], -1)
