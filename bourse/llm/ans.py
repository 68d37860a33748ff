"""Range asymmetric numeral systems over token ids, with static tables.

One ``Table`` holds the frequencies of all ids, scaled to a sum of 2^BITS, and
is shared by every block of every file.  A block is coded on its own: id i goes
to lane i modulo ``lanes``, each lane is a 64-bit state, and all lanes share one
stream of 32-bit words.  Every ``every`` steps the block keeps a checkpoint (the
states and the place in the stream), so a decoder can start there; ``decode``
runs the parts between checkpoints side by side.

Block bytes, little-endian: b"RNB1"; n ids, lanes, every, checkpoints, words,
CRC-32 of the ids as unsigned 32-bit integers (u32 each); per checkpoint its
word position (u32) and its states (u64 each); the words (u32 each); CRC-32 of
all bytes before it.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from typing import NamedTuple

import numpy as np

BITS = 20
LANES = 256
EVERY = 256
LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63)
_HEAD = "<4s6I"
_HEAD_SIZE = struct.calcsize(_HEAD)
_WORD = np.uint64(32)
_LOW_WORD = np.uint64(0xFFFFFFFF)


class CorruptFile(ValueError):
    pass


class Table(NamedTuple):
    bits: int
    ids: np.ndarray    # ids that occur, rising
    freq: np.ndarray   # of each, at least 1; their sum is 2^bits

    def to_bytes(self) -> bytes:
        body = struct.pack("<4sII", b"RNT1", self.bits, len(self.ids)) + self.ids.astype("<u4").tobytes() + self.freq.astype("<u4").tobytes()
        return body + hashlib.sha256(body).digest()

    @staticmethod
    def from_bytes(raw: bytes) -> Table:
        body, digest = raw[:-32], raw[-32:]
        if hashlib.sha256(body).digest() != digest:
            raise CorruptFile("wrong digest of the frequency table")
        magic, bits, n = struct.unpack_from("<4sII", body)
        if magic != b"RNT1" or len(body) != 12 + 8 * n:
            raise CorruptFile("no frequency table")
        both = np.frombuffer(body, "<u4", 2 * n, 12)
        return Table(bits, both[:n].astype(np.int64), both[n:].astype(np.int64))

    @property
    def digest(self) -> bytes:
        return self.to_bytes()[-32:]


def scaled(counts: dict[int, int], bits: int = BITS) -> Table:
    """The table of exact counts: shares of 2^bits, at least 1 for every id
    that occurs; ids below a share of 1 are set first, the rest is rounded by
    largest remainder."""
    ids = np.array(sorted(i for i, c in counts.items() if c > 0), np.int64)
    room = 1 << bits
    if len(ids) > room:
        raise ValueError(f"{len(ids)} ids do not fit into {bits} bits")
    freq = np.ones(len(ids), np.int64)
    big = list(range(len(ids)))
    left = room
    while big:
        total = sum(counts[int(ids[i])] for i in big)
        small = {i for i in big if counts[int(ids[i])] * left < total}
        if not small:
            break
        left -= len(small)
        big = [i for i in big if i not in small]
    if big:
        parts = [divmod(counts[int(ids[i])] * left, total) for i in big]
        freq[big] = [p[0] for p in parts]
        spare = left - sum(p[0] for p in parts)
        for i in sorted(range(len(big)), key=lambda i: (-parts[i][1], i))[:spare]:
            freq[big[i]] += 1
    return Table(bits, ids, freq)


class Coder:
    def __init__(self, table: Table, lanes: int = LANES, every: int = EVERY):
        self.lanes, self.every, self.bits = lanes, every, table.bits
        size = int(table.ids[-1]) + 1 if len(table.ids) else 0
        self.freq, self.base = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[table.ids] = table.freq.astype(np.uint64)
        self.base[table.ids] = (np.cumsum(table.freq) - table.freq).astype(np.uint64)
        self.of_slot = np.repeat(table.ids, table.freq).astype(np.uint32)

    def encode(self, ids: np.ndarray) -> bytes:
        """One block of at least one id."""
        n, lanes = len(ids), self.lanes
        if int(ids.max()) >= len(self.freq) or not self.freq[ids].all():
            raise ValueError("an id is not in the table")
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        steps = -(-n // lanes)
        freq, base = self.freq[ids], self.base[ids]
        shift = np.uint64(63 - self.bits)
        x = np.full(lanes, LOW)
        out, held, count = [], [], 0
        for t in range(steps - 1, -1, -1):
            f, c = freq[t * lanes:(t + 1) * lanes], base[t * lanes:(t + 1) * lanes]
            s = x[:len(f)]  # a view: the last step may leave lanes out
            full = s >= f << shift
            words = s[full]
            if len(words):
                out.append((words & _LOW_WORD).astype("<u4"))
                count += len(words)
                s[full] = words >> _WORD
            q = s // f
            s[:] = (q << np.uint64(self.bits)) + (s - q * f) + c
            if t % self.every == 0:
                held.append((count, x.astype("<u8").tobytes()))
        stream = np.concatenate(out[::-1]).tobytes() if out else b""
        marks = b"".join(struct.pack("<I", count - at) + states for at, states in reversed(held))
        body = struct.pack(_HEAD, b"RNB1", n, lanes, self.every, len(held), count, crc) + marks + stream
        return body + struct.pack("<I", zlib.crc32(body))

    def decode(self, raw: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of a block, or those of its checkpoints first..last-1; the
        whole block is checked against its checksums."""
        if len(raw) < _HEAD_SIZE + 4 or zlib.crc32(raw[:-4]) != struct.unpack_from("<I", raw, len(raw) - 4)[0]:
            raise CorruptFile("wrong checksum of a block")
        magic, n, lanes, every, marks, count, crc = struct.unpack_from(_HEAD, raw)
        size = 4 + 8 * lanes
        if magic != b"RNB1" or len(raw) != _HEAD_SIZE + marks * size + 4 * count + 4:
            raise CorruptFile("no block")
        last = marks if last is None else min(last, marks)
        parts = last - first
        if parts <= 0:
            return np.zeros(0, np.uint32)
        table = np.frombuffer(raw, np.dtype([("at", "<u4"), ("x", "<u8", (lanes,))]), marks, _HEAD_SIZE)[first:last]
        words = np.frombuffer(raw, "<u4", count, _HEAD_SIZE + marks * size).astype(np.uint64)
        at, x = table["at"].astype(np.int64), table["x"].astype(np.uint64)
        out = np.zeros((parts, every, lanes), np.uint32)
        mask, bits = np.uint64((1 << self.bits) - 1), np.uint64(self.bits)
        whole = -(-n // lanes)                       # steps of the block
        begin = (first + np.arange(parts)) * every   # first step of each part
        for t in range(min(every, whole - int(begin[0]))):
            if begin[-1] + t >= whole:  # the last part is shorter
                x, at, begin = x[:-1], at[:-1], begin[:-1]
            slot = x & mask
            ids = self.of_slot[slot]
            new = self.freq[ids] * (x >> bits) + slot - self.base[ids]
            live = n - (begin[-1] + t) * lanes
            if live < lanes:  # the last step of the block: its other lanes rest
                new[-1, live:] = x[-1, live:]
            out[:len(x), t] = ids
            short = new < LOW
            place = np.cumsum(short, axis=1)
            new[short] = (new[short] << _WORD) | words[(at[:, None] + place - 1)[short]]
            at = at + place[:, -1]
            x = new
        flat = out.reshape(-1)[:n - first * every * lanes]
        if not first and last == marks and zlib.crc32(flat.astype("<u4").tobytes()) != crc:
            raise CorruptFile("wrong checksum of the ids")
        return flat
