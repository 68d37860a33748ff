"""Token-ID files: documents as ids, coded by range asymmetric numeral systems.

* One pass tokenizes whole texts.  Parts between white space, and within them
  between ASCII letters or digits and sentence punctuation, are tokens of their
  own for this tokenizer, so each distinct part is encoded once and its ids are
  gathered for all its places; texts with special-token marks go through the
  tokenizer whole.  The ids are written once, as they are needed three times.
* The frequencies of all ids (one number per id of the vocabulary reaches the
  driver) become the shared table, a file of its own.
* The ids are range-partitioned by (doc_id, content, row), so rows that share a
  doc_id spread out, sorted, and coded in blocks of ``BLOCK`` ids (``ans``).  A
  task streams its documents into files of about ``FILE`` ids; a document
  never leaves its file, but may run over many blocks.
* A file is visible through the manifest only, which lists the files of the
  tasks that finished; a task that runs again writes new ones.

File bytes, little-endian: b"RNF1", digest of the table (32 bytes); blocks;
index: zlib of a JSON head line and the arrays it counts (doc ids, their null
flags, lengths; block offsets, first ids); index offset (u64), index length and
CRC-32 (u32 each), b"RNF1".

Defined results: null text is empty, an empty document is the end id alone;
rows without doc_id come first; rows that share one follow each other by the
content of their ids; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ans
from .files import opened
from .store import narrow, scratch, written
from .text import buffers, text_slices

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CACHE = 1_000_000
SLICE = 3 << 20
BLOCK = ans.LANES * ans.EVERY * 4
FILE = 1 << 25              # ids
PART = 1 << 22              # ids of a partition
MAX_PARTS = 50_000
MAGIC = b"RNF1"
_TAIL = "<QII4s"
_TAIL_SIZE = struct.calcsize(_TAIL)

_SEP, _ALNUM, _POINT = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, *range(9, 14)]] = _SEP
_KIND[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]] = _ALNUM
_KIND[[*b".,;:!?"]] = _POINT

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts by a word tokenizer: each part is encoded once.

    A part of Latin letters is one word to the tokenizer, so many of them are
    encoded as one text and dealt out by the tokens that end a word; other
    parts are encoded one by one.  Texts with marks of special tokens or with
    combining characters (which may join a letter before it is lower-cased)
    go through the tokenizer whole."""

    def __init__(self, tokenizer: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        words = self.own.get_vocab()
        self.width = "<u2" if max(words.values()) < 1 << 16 else "<u4"
        self.last = np.zeros(max(words.values()) + 1, bool)
        self.last[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def raw(self, text: str) -> np.ndarray:
        return np.array(self.own.encode(text, add_special_tokens=False).ids, self.width)

    def _deal(self, names: list[str], ids: np.ndarray, stop: np.ndarray) -> None:
        cut, raw = (stop * ids.itemsize).tolist(), ids.tobytes()
        self.known.update(zip(names, map(raw.__getitem__, map(slice, [0, *cut], cut))))

    def _learn(self, names: list[str]) -> None:
        plain = [x for x in names if x.isalpha() and max(x) < "\u0250" and "\u0130" not in x]
        for a in range(0, len(plain), 8192):
            some = plain[a:a + 8192]
            ids = np.array(self.own.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.width)
            stop = np.flatnonzero(self.last[ids]) + 1
            if len(stop) != len(some):
                raise ValueError("a word of letters is not one word to the tokenizer")
            self._deal(some, ids, stop)
        rest = [x for x in names if x not in self.known]
        for a in range(0, len(rest), 8192):
            some = rest[a:a + 8192]
            found = self.own.encode(some, is_pretokenized=True, add_special_tokens=False)
            size = np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)) if found.ids else np.zeros(len(some), np.int64)
            self._deal(some, np.array(found.ids, self.width), np.cumsum(size))

    def _of(self, names: list[str]) -> list[bytes]:
        if len(self.known) > CACHE:
            self.known.clear()
        found = list(map(self.known.get, names))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            self._learn([names[i] for i in new])
            for i in new:
                found[i] = self.known[names[i]]
        return found

    def many(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with ``end`` after each, their offsets)."""
        data, off = buffers(texts)
        odd = (data == 0xCC) | (data == 0xCD)
        odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)  # <|
        marked = np.zeros(len(texts), bool)
        marked[np.searchsorted(off, np.flatnonzero(odd), "right") - 1] = True
        apart = {int(i): self.raw(texts[int(i)].as_py()) for i in np.flatnonzero(marked)}
        if apart:
            data, off = buffers(pc.if_else(pa.array(marked), "", texts))
        kind = _KIND[data]
        # two-byte Latin letters: all after C3 but the signs for times and divided
        letter = np.zeros(len(data), bool)
        letter[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        upper = ((data >= 65) & (data <= 90)) | (letter & (data < 0x9F))
        data = data + (upper.astype(np.uint8) << np.uint8(5))
        letter[:-1] |= letter[1:]
        kind[letter] = _ALNUM
        before = np.concatenate([[_SEP], kind[:-1]]).astype(np.uint8)
        before[off[:-1][off[:-1] < len(data)]] = _SEP  # documents touch
        ink = kind != _SEP
        turn = ((before == _ALNUM) & (kind == _POINT)) | ((before == _POINT) & (kind == _ALNUM))
        start = np.flatnonzero(ink & ((before == _SEP) | turn))
        doc = np.searchsorted(off, start, "right") - 1
        size = np.add.reduceat(ink.astype(np.int64), start) if len(start) else start
        at = np.concatenate([[0], np.cumsum(size)])
        parts = pa.Array.from_buffers(pa.large_utf8(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data[ink])]).dictionary_encode()
        code = np.asarray(parts.indices, np.int64)
        found = self._of(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        length = np.fromiter(map(len, found), np.int64, len(found)) // np.dtype(self.width).itemsize
        flat = np.frombuffer(b"".join(found), self.width)
        first = np.cumsum(length) - length
        n = length[code]
        ids = flat[np.repeat(first[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        total = np.bincount(doc, weights=n, minlength=len(texts)).astype(np.int64)
        out_off = np.concatenate([[0], np.cumsum(total + 1)])
        out = np.insert(ids, np.cumsum(total), np.array(end, self.width))
        if not apart:
            return out, out_off
        rows = [np.append(apart[i], np.array(end, self.width)) if i in apart else out[out_off[i]:out_off[i + 1]] for i in range(len(texts))]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def _encoder(tokenizer: str) -> Encoder:
    if tokenizer not in _encoders:
        _encoders[tokenizer] = Encoder(tokenizer)
    return _encoders[tokenizer]


def _tokenize(tokenizer: str, end: int):
    def run(batches):
        enc = _encoder(tokenizer)
        for batch in batches:
            for part in text_slices(batch, limit=SLICE):
                ids, off = enc.many(part.column("text"), end)
                raw, wide = ids.tobytes(), off * ids.itemsize
                rows = [raw[a:b] for a, b in zip(wide[:-1].tolist(), wide[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(off), pa.int64()), pa.array(list(map(zlib.crc32, rows)), pa.int64()),
                     pa.array([ids.itemsize] * len(rows), pa.int32()), pa.array(rows, pa.binary())],
                    names=["doc_id", "n", "crc", "width", "ids"])
    return run


def _ids_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<u2" if w == 2 else "<u4") for x, w in zip(batch.column("ids"), batch.column("width").to_pylist())]


def _counts(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            n = np.bincount(np.concatenate(_ids_of(batch)), minlength=len(total))
            n[:len(total)] += total
            total = n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])


def tokenized(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END_ID) -> DataFrame:
    """(doc_id, n, crc, width, ids, row): the ids of each document, written."""
    out = narrow(docs).mapInArrow(_tokenize(tokenizer, end), "doc_id long, n long, crc long, width int, ids binary")
    return written(out.withColumn("row", F.monotonically_increasing_id()), "ids")


class _Writer:
    """One file: blocks as they fill, the index at the end."""

    def __init__(self, folder: str, name: str, coder: ans.Coder, digest: bytes):
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        self.uri, self.coder = f"{folder.rstrip('/')}/{name}", coder
        self.out = store.open_output_stream(f"{path.rstrip('/')}/{name}", compression=None)
        self.out.write(MAGIC + digest)
        self.at, self.total, self.coded = len(MAGIC) + len(digest), 0, 0
        self.held: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.blocks: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.sizes.append(len(ids))
        self.total += len(ids)
        self.held.append(ids)
        if self.total - self.coded >= BLOCK:
            self._code(False)

    def _code(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.held)
        a = 0
        while len(ids) - a >= BLOCK or (all_of_it and a < len(ids)):
            raw = self.coder.encode(ids[a:a + BLOCK])
            self.blocks.append((self.at, self.coded))
            self.out.write(raw)
            self.at += len(raw)
            self.coded += len(ids[a:a + BLOCK])
            a += BLOCK
        self.held = [ids[a:]]

    def close(self) -> tuple[str, int, int, int]:
        if self.held:
            self._code(True)
        head = json.dumps({"docs": len(self.docs), "blocks": len(self.blocks), "ids": self.total}).encode()
        lost = np.array([d is None for d in self.docs], np.uint8)
        index = zlib.compress(head + b"\n" + np.array([d or 0 for d in self.docs], "<i8").tobytes() + lost.tobytes()
                              + np.array(self.sizes, "<i8").tobytes() + np.array(self.blocks, "<i8").reshape(-1, 2).T.tobytes())
        self.out.write(index + struct.pack(_TAIL, self.at, len(index), zlib.crc32(index), MAGIC))
        self.out.close()
        return self.uri, len(self.docs), self.total, self.at + len(index) + _TAIL_SIZE


_MANIFEST = "path string, part int, seq int, docs long, ids long, bytes long"


def _write(folder: str, table, file_ids: int):
    def run(batches):
        known = ans.Table.from_bytes(table.value)
        coder = ans.Coder(known)
        part, mark = TaskContext.get().partitionId(), uuid.uuid4().hex
        file, done = None, []
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _ids_of(batch)):
                if file is None:
                    file = _Writer(folder, f"part-{part:06d}-{mark}-{len(done):04d}.rnf", coder, known.digest)
                file.add(doc_id, ids)
                if file.total >= file_ids:
                    done.append(file.close())
                    file = None
        if file is not None:
            done.append(file.close())
        cols = list(zip(*done)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array([part] * len(done), pa.int32()), pa.array(range(len(done)), pa.int32()),
             *[pa.array(c, pa.int64()) for c in cols[1:]]], names=["path", "part", "seq", "docs", "ids", "bytes"])
    return run


def write_files(docs: DataFrame, folder: str | None = None, tokenizer: str = TOKENIZER, end: int = END_ID, file_ids: int = FILE,
                part_ids: int = PART) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the
    manifest (path, docs, ids, bytes, start, table): ``start`` counts the ids
    before the file, ``table`` is the path of the shared frequencies."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token-files")
    tokens = tokenized(docs, tokenizer, end)
    counts = {r["id"]: r["n"] for r in tokens.select("width", "ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    table = ans.scaled(counts).to_bytes()
    store, path = opened(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path.rstrip('/')}/table.rnt", compression=None) as out:
        out.write(table)
    parts = min(MAX_PARTS, max(1, -(-sum(counts.values()) // part_ids)))
    order = [F.asc_nulls_first("doc_id"), F.asc("crc"), F.asc("n"), F.asc("row")]
    dealt = tokens.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "width", "ids")
    files = written(dealt.mapInArrow(_write(folder, spark.sparkContext.broadcast(table), file_ids), _MANIFEST), "manifest")
    # one row per file
    before = Window.partitionBy(F.lit(0)).orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", "docs", "ids", "bytes", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"),
                        F.lit(f"{folder.rstrip('/')}/table.rnt").alias("table"))


def _table_of(uri: str) -> ans.Table:
    store, path = opened(uri)
    with store.open_input_stream(path, compression=None) as f:
        return ans.Table.from_bytes(f.read())


class Reader:
    """One file: its index, and any of its blocks."""

    def __init__(self, uri: str, table: ans.Table):
        store, path = opened(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        at, length, crc, magic = struct.unpack(_TAIL, self.file.read_at(_TAIL_SIZE, size - _TAIL_SIZE)) if size >= _TAIL_SIZE else (0, 0, 0, b"")
        if magic != MAGIC or at + length + _TAIL_SIZE != size:
            raise ans.CorruptFile(f"{uri}: not a token file, or cut off")
        index = self.file.read_at(length, at)
        if zlib.crc32(index) != crc or self.file.read_at(36, 0) != MAGIC + table.digest:
            raise ans.CorruptFile(f"{uri}: wrong index checksum, or another frequency table")
        head, _, rest = zlib.decompress(index).partition(b"\n")
        said = json.loads(head)
        docs, blocks = said["docs"], said["blocks"]
        self.doc_ids = np.frombuffer(rest, "<i8", docs)
        self.lost = np.frombuffer(rest, np.uint8, docs, 8 * docs).astype(bool)
        self.sizes = np.frombuffer(rest, "<i8", docs, 9 * docs)
        self.offsets, self.first = np.frombuffer(rest, "<i8", 2 * blocks, 17 * docs).reshape(2, blocks)
        self.ends = np.append(self.offsets[1:], at)
        self.total, self.coder = said["ids"], ans.Coder(table)

    def block(self, i: int, first: int = 0, last: int | None = None) -> np.ndarray:
        return self.coder.decode(self.file.read_at(int(self.ends[i] - self.offsets[i]), int(self.offsets[i])), first, last)

    def span(self, start: int, length: int) -> np.ndarray:
        """ids start..start + length - 1: only the blocks and checkpoints that
        hold them are decoded."""
        stop, step = min(start + length, self.total), ans.LANES * ans.EVERY
        out = []
        for i in range(max(int(np.searchsorted(self.first, start, "right")) - 1, 0), len(self.first)):
            base = int(self.first[i])
            if base >= stop:
                break
            a, b = max(start - base, 0), min(stop - base, BLOCK)
            lo = a // step
            ids = self.block(i, lo, -(-b // step))
            out.append(ids[a - lo * step:b - lo * step])
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _read(with_ids: bool):
    def run(batches):
        tables: dict[str, ans.Table] = {}
        for batch in batches:
            for uri, start, name in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "table"))):
                if name not in tables:
                    tables[name] = _table_of(name)
                reader = Reader(uri, tables[name])
                held, have, block, rows = np.zeros(0, np.uint32), 0, 0, []
                crc, begin = 0, start
                pieces: list[bytes] = []
                for doc, lost, size in zip(reader.doc_ids.tolist(), reader.lost.tolist(), reader.sizes.tolist()):
                    need, crc, pieces = size, 0, []
                    while need:
                        if have == len(held):
                            held, have, block = reader.block(block), 0, block + 1
                        some = held[have:have + need].astype("<u4").tobytes()
                        crc = zlib.crc32(some, crc)
                        if with_ids:
                            pieces.append(some)
                        have += len(some) // 4
                        need -= len(some) // 4
                    rows.append((None if lost else doc, begin, size, crc, b"".join(pieces)))
                    begin += size
                    if len(rows) >= 20_000 or (with_ids and sum(len(r[4]) for r in rows[-1:]) > 1 << 20):
                        yield _rows(rows, with_ids)
                        rows = []
                yield _rows(rows, with_ids)
    return run


def _rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    arrays = [pa.array(c, pa.int64()) for c in cols[:4]] + ([pa.array(cols[4], pa.binary())] if with_ids else [])
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)


def read_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the
    files, decoded and checked; ids as little-endian unsigned 32-bit."""
    parts = max(1, min(manifest.count(), MAX_PARTS))
    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return manifest.select("path", "start", "table").repartition(parts).mapInArrow(_read(with_ids), kinds)


def read_span(spark: SparkSession, manifest: DataFrame, start: int, length: int) -> np.ndarray:
    """``length`` ids from place ``start`` of the whole stream (at most
    ``FILE`` of them): seeks to the blocks and checkpoints that hold them."""
    if length > FILE:
        raise ValueError(f"at most {FILE} ids at once")
    at = manifest.where((F.col("start") < start + length) & (F.col("start") + F.col("ids") > start)).orderBy("start").collect()
    out = [Reader(r["path"], _table_of(r["table"])).span(max(start - r["start"], 0), min(start + length - r["start"], length)
                                                          if r["start"] > start else length) for r in at]
    return np.concatenate(out)[:length] if out else np.zeros(0, np.uint32)


def round_trip(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, from the files."""
    return read_files(write_files(docs, folder))
