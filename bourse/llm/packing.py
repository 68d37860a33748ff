"""Packing documents into fixed-length token sequences: minimum bin slack.

Every document is tokenized once and ends with id 0.  Its full windows of
``capacity`` ids are sequences of their own; what remains (1 to capacity - 1
ids) is packed by its length only:

* The histogram of remaining lengths (at most capacity - 1 numbers, the only
  thing that reaches the driver) is planned window by window.  A window takes
  the longest length left, then the multiset of lengths that comes closest to
  the capacity: a subset-sum dynamic program over the bits of one integer,
  backtracked to counts per length.  The pattern is repeated as often as the
  counts allow, so there are about as many patterns as lengths.
* If the best multiset leaves a slack, a remaining piece is cut to fill it and
  its rest is planned as a length of its own.  The last, partly filled window
  is cut at powers of two, where no padding is due.
* Each document gets its rank within its length from counts per (length,
  hash bucket), so a length that a third of all rows share is spread out, and
  looks up its windows in the plan (a few thousand intervals).

Defined results: null text is an empty document (one id, 0); repeated rows
and rows without a doc_id are packed each on its own; an empty table gives no pieces; other columns are
not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import narrow, written

CAPACITY = 1024
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
END_ID = 0
CACHE = 200_000
GROUP = 1 << 20
ROWS_PER_BUCKET = 200_000


class Encoder:
    """Ids of texts as little-endian uint32 bytes.

    A byte-level BPE cuts a text before each white space that stands alone, so
    the chunks that begin there are encoded once and kept (about ``CACHE`` of
    them).  The new Latin chunks of several texts go through the rank file of
    the same vocabulary in one call, and their ids are dealt out by the lengths
    of the tokens; other chunks, and texts with white space next to white
    space, whose chunks are not independent, go through the tokenizer itself.
    """

    _run = re.compile(r"\s\s")

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(tokenizer)
        self.fast, self.known = None, {}
        if ranks:
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            self.length = np.zeros(max(table.values()) + 1, np.int64)
            for token, i in table.items():
                self.length[i] = len(token)

    def raw(self, text: str) -> bytes:
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, chunk: str) -> bool:
        return self.fast is not None and max(chunk, default="") < "ɐ" and "<|" not in chunk

    def _learn(self, parts: set[str]) -> None:
        """Encode new chunks; a chunk stands for itself after a line break and
        follows a space otherwise."""
        names = list(parts)
        chunks = [x if x[:1] == "\n" else " " + x for x in names]
        if not self._plain("".join(chunks)):  # some are not: sort them out
            plain = [self._plain(c) for c in chunks]
            for x, c in [(x, c) for x, c, ok in zip(names, chunks, plain) if not ok]:
                self.known[x] = self.raw(c)
            names, chunks = [x for x, ok in zip(names, plain) if ok], [c for c, ok in zip(chunks, plain) if ok]
        if not names:
            return
        text = "".join(chunks)
        ends = np.cumsum(list(map(len, chunks if text.isascii() else map(str.encode, chunks))), dtype=np.int64)
        ids = np.array(self.fast.encode_ordinary(text), "<u4")
        at = np.cumsum(self.length[ids])
        stop = np.searchsorted(at, ends) + 1
        if not np.array_equal(at[stop - 1], ends):
            raise ValueError("tokens cross chunks")
        raw, cut = ids.tobytes(), (4 * stop).tolist()
        self.known.update(zip(names, map(raw.__getitem__, map(slice, [0, *cut], cut))))

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        parts = [None if self._run.search(t) else t.replace("\n", " \n").split(" ") for t in texts]
        heads = [x and x.pop(0) for x in parts]
        if len(self.known) > CACHE:
            self.known.clear()
        new = set().union(*filter(None, parts)) - self.known.keys()
        if new:
            self._learn(new)
        get = self.known.__getitem__
        return [self.raw(t) if x is None else (self._first(h) if h else b"") + b"".join(map(get, x))
                for t, h, x in zip(texts, heads, parts)]

    def _first(self, chunk: str) -> bytes:
        return np.array(self.fast.encode_ordinary(chunk), "<u4").tobytes() if self._plain(chunk) else self.raw(chunk)

    def ids(self, text: str) -> bytes:
        return self.many([text])[0]


def _encoded(enc: Encoder, texts: list[str]):
    """The ids of all texts, in groups of about ``GROUP`` characters."""
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size < GROUP):
            size += len(texts[b])
            b += 1
        yield from enc.many(texts[a:b])
        a = b


def _encoder(tokenizer: str, ranks: str | None) -> Encoder:
    import public_tokenizers

    return Encoder(public_tokenizers.path(tokenizer), ranks and public_tokenizers.path(ranks), public_tokenizers.PATTERN)


_END = np.array([END_ID], "<u4").tobytes()


def _tokenize(capacity: int, tokenizer: str, ranks: str | None):
    def run(batches):
        enc = _encoder(tokenizer, ranks)
        size = 4 * capacity
        for batch in batches:
            n, whole, full, left, crc = [], [], [], [], []
            for ids in _encoded(enc, batch.column("text").to_pylist()):
                ids += _END
                cut = len(ids) // size * size
                n.append(len(ids) // 4)
                whole.append(zlib.crc32(ids))
                full.append([zlib.crc32(ids[a:a + size]) for a in range(0, cut, size)])
                left.append((len(ids) - cut) // 4)
                crc.append(zlib.crc32(ids[cut:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(whole, pa.int64()),
                 pa.array(full, pa.list_(pa.int64())), pa.array(left, pa.int32()), pa.array(crc, pa.int64())],
                names=["doc_id", "doc_tokens", "doc_crc", "full_crcs", "rest", "rest_crc"])
    return run


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths whose sum is largest but at most
    ``room``: {length: how many}.  Bit s of ``reach`` is set if the sum s can
    be made; counts are split into powers of two."""
    items: list[tuple[int, int]] = []
    for length in sorted(counts, reverse=True):
        n, k = min(counts[length], room // length), 1
        while n > 0:
            items.append((length, min(k, n)))
            n -= k
            k *= 2
    mask, reach, stages = (1 << (room + 1)) - 1, 1, [1]
    for length, k in items:
        reach = (reach | reach << (length * k)) & mask
        stages.append(reach)
    left, used = reach.bit_length() - 1, defaultdict(int)
    for (length, k), before in zip(reversed(items), reversed(stages[:-1])):
        if not before >> left & 1:
            used[length] += k
            left -= length * k
    return dict(used)


class Place(NamedTuple):
    """Ranks lo..hi-1 of a class: positions v0.. of a block of windows that
    hold ``per`` pieces of this length each, the first at ``offset``."""
    lo: int
    hi: int
    v0: int
    window: int
    per: int
    offset: int
    take: int  # ids placed: the whole length, or the first part of a cut
    then: int  # class of what is left after a cut, or -1
    then_rank: int


class Plan:
    """Windows for a histogram of lengths; ``steps[class]`` holds the
    intervals of a class by rank.  Class L < capacity is length L."""

    def __init__(self, counts: dict[int, int], capacity: int, tail_powers: bool = True):
        self.capacity, self.windows = capacity, 0
        self.steps: dict[int, list[Place]] = defaultdict(list)
        self._queue: dict[int, list[list[int]]] = {}
        self._next = capacity
        for length, n in counts.items():
            if n:
                self._queue[length] = [[length, 0, n]]
        left = {k: v for k, v in counts.items() if v}
        while left:
            if sum(k * v for k, v in left.items()) < capacity:
                self._tail(left, tail_powers)
                break
            top = max(left)
            rest = dict(left)
            rest[top] -= 1
            if not rest[top]:
                del rest[top]
            used = best_fill(rest, capacity - top)
            used[top] = used.get(top, 0) + 1
            slack = capacity - sum(k * v for k, v in used.items())
            reps = min(left[k] // v for k, v in used.items())
            cut = None
            if slack:
                spare = {k: v - used.get(k, 0) for k, v in left.items() if k > slack and v > used.get(k, 0)}
                if spare:
                    cut = max(spare, key=lambda k: (spare[k], k))
                    reps = min(reps, left[cut] // (used.get(cut, 0) + 1))
            offset = 0
            for length in sorted(used, reverse=True):
                self._take(length, reps, used[length], offset, length, -1)
                offset += length * used[length]
                left[length] -= reps * used[length]
            if cut is not None:
                new = self._next
                self._next += 1
                self._take(cut, reps, 1, offset, slack, new)
                left[cut] -= reps
                rest_len = cut - slack
                self._queue.setdefault(rest_len, []).append([new, 0, reps])
                left[rest_len] = left.get(rest_len, 0) + reps
            left = {k: v for k, v in left.items() if v}
            self.windows += reps

    def _take(self, length: int, reps: int, per: int, offset: int, take: int, then: int) -> None:
        v, need = 0, reps * per
        while need:
            head = self._queue[length][0]
            n = min(need, head[2] - head[1])
            self.steps[head[0]].append(Place(head[1], head[1] + n, v, self.windows, per, offset, take, then, v))
            head[1] += n
            v += n
            need -= n
            if head[1] == head[2]:
                self._queue[length].pop(0)

    def _tail(self, left: dict[int, int], powers: bool) -> None:
        """The last pieces, cut so that their sequences end at powers of two."""
        total, lengths = sum(k * v for k, v in left.items()), [k for k in sorted(left, reverse=True) for _ in range(left[k])]
        sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1] if powers else [total]
        room, at = sizes[0], 0
        for length in lengths:
            while length:
                take = min(length, room)
                new = -1
                if take < length:
                    new = self._next
                    self._next += 1
                self._take(length, 1, 1, at, take, new)
                at += take
                room -= take
                length -= take
                if new >= 0:
                    self._queue.setdefault(length, []).insert(0, [new, 0, 1])
                if not room:
                    self.windows += 1
                    sizes.pop(0)
                    room, at = (sizes[0], 0) if sizes else (0, 0)

    def find(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start within the rest, ids, window, offset) of one rest."""
        out, cls, start = [], length, 0
        while cls >= 0:
            steps = self.steps[cls]
            s = steps[bisect_right(steps, rank, key=lambda x: x.lo) - 1]
            v = s.v0 + rank - s.lo
            out.append((start, s.take, s.window + v // s.per, s.offset + (v % s.per) * s.take))
            start += s.take
            cls, rank = s.then, v
        return out


def _assign(plan: Plan):
    capacity = plan.capacity

    def run(batches):
        for batch in batches:
            rows = []
            for doc, n, whole, full, rest, crc, rank, seq in zip(*(batch.column(c).to_pylist() for c in (
                    "doc_id", "doc_tokens", "doc_crc", "full_crcs", "rest", "rest_crc", "rank", "first_full"))):
                rows += [(doc, i * capacity, capacity, c, n, plan.windows + seq + i, 0, whole) for i, c in enumerate(full)]
                if rest:
                    found, base = plan.find(rest, rank), n - rest
                    rows += [(doc, base + s, k, crc if len(found) == 1 else None, n, w, o, whole) for s, k, w, o in found]
            cols = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "doc_crc"])
    return run


def _recut(tokenizer: str, ranks: str | None):
    def run(batches):
        enc = _encoder(tokenizer, ranks)
        for batch in batches:
            rows = []
            for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                ids = enc.ids(text) + _END
                whole = zlib.crc32(ids)
                rows += [(doc, whole, s["start"], s["length"], zlib.crc32(ids[4 * s["start"]:4 * (s["start"] + s["length"])])) for s in spans]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["doc_id", "doc_crc", "start", "length", "cut_crc"])
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, ranks: str | None = RANKS,
         tail_powers: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (see the module)."""
    base = narrow(docs)
    tokens = written(base.mapInArrow(
        _tokenize(capacity, tokenizer, ranks),
        "doc_id long, doc_tokens long, doc_crc long, full_crcs array<long>, rest int, rest_crc long"), "tokens")
    counts = {r[0]: r[1] for r in tokens.where("rest > 0").groupBy("rest").count().collect()}
    plan = Plan(counts, capacity, tail_powers)
    n_buckets = max(64, -(-tokens.count() // ROWS_PER_BUCKET))
    ranked = tokens.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "doc_crc"), F.lit(n_buckets)).cast("int")).withColumn(
        "full", F.size("full_crcs").cast("long"))
    # rank of a document within its remaining length, and its first full window
    per = ranked.groupBy("rest", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("rank0", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    fulls = ranked.groupBy("bucket").agg(F.sum("full").alias("n"))  # one row per bucket
    up = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    fulls = fulls.withColumn("full0", F.coalesce(F.sum("n").over(up), F.lit(0))).drop("n")
    tie = [F.col("doc_id"), F.col("doc_crc")]
    in_length = Window.partitionBy("rest", "bucket").orderBy(*tie)
    in_bucket = Window.partitionBy("bucket").orderBy("rest", *tie)
    ranked = (ranked.withColumn("r", F.row_number().over(in_length) - 1)
              .withColumn("f", F.sum("full").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"))
              .join(per, ["rest", "bucket"]).join(fulls, "bucket")
              .withColumn("rank", F.col("rank0") + F.col("r")).withColumn("first_full", F.col("full0") + F.col("f")))
    pieces = written(ranked.mapInArrow(_assign(plan), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                                      "sequence_id long, offset long, doc_crc long"), "pieces")
    # pieces of cut rests: their ids are read again, for those documents only
    cuts = written(pieces.where("ids_crc32 IS NULL").groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "length")).alias("spans")), "cuts")
    n_cut = cuts.count()
    if n_cut:
        cuts = cuts.withColumnRenamed("doc_id", "cut_id")  # documents without an id have one row there
        again = base.join(F.broadcast(cuts) if n_cut <= 100_000 else cuts, F.col("doc_id").eqNullSafe(F.col("cut_id"))).drop("cut_id")
        crcs = again.mapInArrow(_recut(tokenizer, ranks), "doc_id long, doc_crc long, start long, length long, cut_crc long").distinct()
        key = ["doc_id", "doc_crc", "start", "length"]
        crcs = crcs.select("cut_crc", *[F.col(c).alias(f"cut_{c}") for c in key])
        pieces = pieces.join(crcs, [F.col(c).eqNullSafe(F.col(f"cut_{c}")) for c in key], "left").withColumn(
            "ids_crc32", F.coalesce("ids_crc32", "cut_crc"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _ids(tokenizer: str, ranks: str | None):
    def run(batches):
        enc = _encoder(tokenizer, ranks)
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                ids = np.frombuffer(enc.ids(text) + _END, "<u4")
                rows += [(s["sequence_id"], s["offset"], ids[s["start"]:s["start"] + s["length"]].tolist()) for s in spans]
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int32()))],
                names=["sequence_id", "offset", "ids"])
    return run


def sequences(docs: DataFrame, pieces: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
              ranks: str | None = RANKS, pad_id: int = END_ID) -> DataFrame:
    """(sequence_id, length, ids): the training sequences themselves, padded
    with ``pad_id`` to the capacity unless their length is a power of two.
    A doc_id must not repeat with different texts."""
    spans = pieces.groupBy("doc_id").agg(F.collect_set(F.struct("sequence_id", "offset", "start", "length")).alias("spans"))
    parts = narrow(docs).dropDuplicates(["doc_id"]).join(spans, "doc_id").mapInArrow(
        _ids(tokenizer, ranks), "sequence_id long, offset long, ids array<int>")
    seq = parts.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    pad = F.when(F.bit_count(n) == 1, 0).otherwise(capacity - n)
    return seq.select("sequence_id", n.alias("length"), F.concat("ids", F.array_repeat(F.lit(pad_id), pad)).alias("ids"))
