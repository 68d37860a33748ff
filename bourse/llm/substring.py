"""Repeated passages across documents: fixed-block anchors.

A window is ``window`` (35) consecutive words of one document.  Every word
covered by a window whose word sequence also starts anywhere else (same
document included) is removed.

* Index: the non-overlapping reference blocks of ``block`` = (window + 1) // 2
  words at word positions 0, block, 2 * block, ...  Each window holds exactly
  one aligned block at one of its first ``block`` positions.
* Probe: every rolling window of ``block`` words, as a 32-bit fingerprint sent
  to one of many fingerprint buckets, packed to one row per bucket and slice.
  A block is a hit if its fingerprint rolls by a second time anywhere.  A
  repeated window's own aligned block is always a hit, so nothing is lost.
* Extend: the windows around hit blocks are grouped by their 64-bit hash over
  all ``window`` words; those that occur twice are repeats, and consecutive
  ones form the maximal exact repeats.  No pairs of places are formed, so a
  passage shared by very many documents costs one row per slice and bucket.

Documents with equal texts are represented by the smallest doc_id; the number
of copies decides that all their windows repeat.

Rows whose doc_id is null or repeats get a key of their own per (doc_id, word
sequence) for the work in between (``_row_keys``), so each text is judged as a
document and no id passes through floating point.

Defined results: null text counts as no words; shorter documents than one
window lose nothing; rows without a doc_id and rows that share one are
documents of their own, each with a result for its own text; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import input_bytes, join_ids, narrow, written
from .text import Words, grams, mix, text_slices, words_of

WINDOW = 35
BUCKET_BYTES = 2 << 20  # input bytes per fingerprint bucket
PACK_BYTES = 4 << 20    # text bytes per packed set of fingerprint rows


def _buckets(docs: DataFrame) -> int:
    return int(min(1 << 20, max(64, -(-input_bytes(docs) // BUCKET_BYTES))))


def _rows_by_bucket(bucket: np.ndarray, n_buckets: int):
    order = np.argsort(bucket, kind="stable")
    at = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    return order, at


def _ordinal(words: Words) -> np.ndarray:
    """Position of each word within its document."""
    first = np.searchsorted(words.doc, np.arange(words.n_docs))
    return np.arange(len(words.doc)) - first[words.doc]


def _join_words(words: Words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each document joined by one space."""
    length = (words.end - words.start)[keep] + 1
    total = int(length.sum())
    ends = np.cumsum(length)
    src = np.arange(total) - np.repeat(ends - length, length) + np.repeat(words.start[keep], length)
    out = np.empty(total, np.uint8)
    if total:
        out[:] = words.data[np.minimum(src, len(words.data) - 1)]
        out[ends - 1] = 32
    doc = words.doc[keep]
    cut = np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(words.n_docs + 1))]
    raw = out.tobytes()
    return [raw[a:b - 1] if b > a else b"" for a, b in zip(cut, cut[1:])]


def _digests(batches):
    """(doc_id, n_words, digest of the text, sha256 of all words joined)."""
    for batch in batches:
        for part in text_slices(batch):
            w = words_of(part.column("text"))
            n = np.bincount(w.doc, minlength=w.n_docs)
            joined = _join_words(w, np.ones(len(w.doc), bool))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in joined], pa.string())],
                names=["doc_id", "n_words", "all_sha256"])


def _fingerprints(block: int, n_buckets: int):
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, limit=PACK_BYTES):
                ids = np.asarray(part.column("doc_id"), dtype=np.int64)
                w = words_of(part.column("text"))
                h, d = grams(w, block)
                ok = d >= 0
                pos = _ordinal(w)[:len(h)]
                anchor = ok & (pos % block == 0)
                bucket = (mix(h) % np.uint64(n_buckets)).astype(np.int64)
                code = (h >> np.uint64(32)).astype(np.uint32)
                # rolling fingerprints: at most two of a kind from a slice tell as much as all
                key = np.sort((bucket[ok].astype(np.uint64) << np.uint64(32)) | code[ok])
                third = np.zeros(len(key), bool)
                third[2:] = key[2:] == key[:-2]
                key = key[~third]
                at = np.searchsorted(key, np.arange(n_buckets + 1, dtype=np.uint64) << np.uint64(32))
                roll = (key & np.uint64(0xFFFFFFFF)).astype("<u4")
                a = np.flatnonzero(anchor)
                order, cut = _rows_by_bucket(bucket[a], n_buckets)
                a = a[order]
                used = np.flatnonzero((np.diff(at) > 0) | (np.diff(cut) > 0))
                codes, owners, blocks = code[a].astype("<u4"), ids[d[a]].astype("<i8"), (pos[a] // block).astype("<i4")
                for lo in range(0, len(used), 4096):
                    some = used[lo:lo + 4096]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(some, pa.int32()),
                        pa.array([roll[at[b]:at[b + 1]].tobytes() for b in some], pa.binary()),
                        pa.array([codes[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary()),
                        pa.array([owners[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary()),
                        pa.array([blocks[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary()),
                    ], names=["bucket", "roll", "codes", "owners", "blocks"])
    return run


def _packed(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), dtype=dtype)


def _hits(table: pa.Table) -> pa.Table:
    """Blocks of one fingerprint bucket that roll by at least twice."""
    roll = np.sort(_packed(table.column("roll"), "<u4"))
    twice = np.unique(roll[1:][roll[1:] == roll[:-1]])
    codes = _packed(table.column("codes"), "<u4")
    hit = np.isin(codes, twice)
    return pa.table({"doc_id": _packed(table.column("owners"), "<i8")[hit].astype(np.int64),
                     "block": _packed(table.column("blocks"), "<i4")[hit].astype(np.int32)})


def _candidates(window: int, block: int, n_buckets: int):
    """Windows whose own aligned block is a hit, packed by bucket."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                ids = np.asarray(part.column("doc_id"), dtype=np.int64)
                w = words_of(part.column("text"))
                h, d = grams(w, window)
                pos = _ordinal(w)[:len(h)]
                hits = part.column("hits")
                n_hits = np.asarray(pa.compute.list_value_length(hits), dtype=np.int64)
                flat = np.asarray(hits.flatten(), dtype=np.int64)
                far = np.int64(1) << np.int64(32)
                known = np.sort(np.repeat(np.arange(len(ids)), n_hits) * far + flat)
                mine = d * far + -(-pos // block)
                at = np.minimum(np.searchsorted(known, mine), max(len(known) - 1, 0))
                ok = (d >= 0) & (known[at] == mine if len(known) else np.zeros(len(d), bool))
                c = np.flatnonzero(ok)
                bucket = (mix(h[c] ^ np.uint64(0x1234567)) % np.uint64(n_buckets)).astype(np.int64)
                order, cut = _rows_by_bucket(bucket, n_buckets)
                c = c[order]
                own, code, at_ = ids[d[c]].astype("<i8"), h[c].astype("<u8"), pos[c].astype("<i4")
                used = np.flatnonzero(np.diff(cut) > 0)
                for lo in range(0, len(used), 4096):
                    some = used[lo:lo + 4096]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(some, pa.int32()),
                        pa.array([code[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary()),
                        pa.array([own[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary()),
                        pa.array([at_[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary()),
                    ], names=["bucket", "codes", "owners", "starts"])
    return run


def _repeats(window: int):
    def run(table: pa.Table) -> pa.Table:
        """Runs of starts of one bucket whose window occurs at least twice."""
        code = _packed(table.column("codes"), "<u8")
        owner = _packed(table.column("owners"), "<i8")
        start = _packed(table.column("starts"), "<i4")
        order = np.argsort(code, kind="stable")
        s = code[order]
        same = np.zeros(len(s), bool)
        same[1:] = s[1:] == s[:-1]
        same[:-1] |= same[1:].copy()
        rep = order[same]
        o, p = owner[rep], start[rep]
        by = np.lexsort((p, o))
        o, p = o[by], p[by]
        edge = np.ones(len(o) + 1, bool)
        edge[1:-1] = o[1:] != o[:-1]
        at = np.flatnonzero(edge)
        return pa.table({"doc_id": pa.array(o[at[:-1]], pa.int64()),
                         "starts": pa.array([p[a:b].astype("<i4").tobytes() for a, b in zip(at, at[1:])], pa.binary())})
    return run


def _cut(window: int):
    """Remove the covered words: (doc_id, n_words, n_removed, kept text)."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                w = words_of(part.column("text"))
                n = np.bincount(w.doc, minlength=w.n_docs)
                first = np.searchsorted(w.doc, np.arange(w.n_docs))
                covered = np.zeros(len(w.doc) + 1, np.int64)
                for i, packs in enumerate(part.column("starts").to_pylist()):
                    p = np.concatenate([np.frombuffer(x, "<i4") for x in packs]).astype(np.int64)
                    p = p + first[i]
                    np.add.at(covered, p, 1)
                    np.add.at(covered, p + window, -1)
                keep = np.cumsum(covered)[:-1] == 0
                joined = _join_words(w, keep)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()),
                     pa.array(n - np.bincount(w.doc[keep], minlength=w.n_docs), pa.int64()), pa.array(joined, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def _with_digest(batches):
    """The rows with the sha256 of their words joined."""
    for batch in batches:
        for part in text_slices(batch):
            w = words_of(part.column("text"))
            joined = _join_words(w, np.ones(len(w.doc), bool))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([hashlib.sha256(x).hexdigest() for x in joined], pa.string())],
                                             names=["doc_id", "text", "all_sha256"])


def _row_keys(base: DataFrame, summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``base`` and ``summary`` with doc_id replaced by a key that no two
    different texts share; ``summary`` keeps the id as ``own_id``.  Ids that
    are there once are their own keys, the others get numbers above all ids
    (below, if there is no room)."""
    summary = summary.withColumn("own_id", F.col("doc_id"))
    odd = written(summary.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("odd_id")), "odd-ids")
    if odd.isEmpty():
        return base, summary
    lo, hi = summary.agg(F.coalesce(F.min("doc_id"), F.lit(0)), F.coalesce(F.max("doc_id"), F.lit(0))).first()
    if hi >= 1 << 62 and lo <= -(1 << 62):
        raise ValueError("doc_ids leave no room for the keys of repeated ones")
    same = F.col("doc_id").eqNullSafe(F.col("odd_id"))
    rows = summary.join(odd, same, "left_semi").select("doc_id", "all_sha256").distinct()
    number = F.monotonically_increasing_id()
    keys = written(rows.select(F.col("doc_id").alias("odd_id"), F.col("all_sha256").alias("odd_sha"),
                               (F.lit(hi + 1) + number if hi < 1 << 62 else F.lit(lo - 1) - number).alias("key")), "row-keys")
    own = same & (F.col("all_sha256") == F.col("odd_sha"))
    texts = base.join(odd, same, "left_semi").mapInArrow(_with_digest, "doc_id long, text string, all_sha256 string")
    texts = written(texts.join(keys, own).select(F.col("key").alias("doc_id"), "text"), "odd-rows")
    summary = summary.join(keys, own, "left").withColumn("doc_id", F.coalesce("key", "doc_id")).drop("odd_id", "odd_sha", "key")
    return base.join(odd, same, "left_anti").unionByName(texts), written(summary, "digests")


def repeated_passages(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(summary, cut).  ``summary`` has every document: own_id (its doc_id),
    doc_id (its key), n_words, all_sha256 (of all words joined by one space)
    and ``copied`` (an equal word sequence of at least one window exists
    elsewhere, so every word goes).  ``cut`` has the other documents that lose
    words: doc_id (the key), n_words, n_removed, kept_text."""
    block = (window + 1) // 2
    base = narrow(docs)
    n_buckets = _buckets(docs)
    summary = written(base.mapInArrow(_digests, "doc_id long, n_words long, all_sha256 string"), "digests")
    base, summary = _row_keys(base, summary)
    groups = summary.groupBy("all_sha256", "n_words").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep")).where("copies > 1")
    groups = written(groups, "copies")
    copies = summary.where(f"n_words >= {window}").join(groups, ["all_sha256", "n_words"])
    # copies other than the first of each group take no part from here on
    spare = written(copies.where("doc_id > rep").select("doc_id").distinct(), "spare")
    active = join_ids(base, spare, "doc_id", spare.count(), "left_anti")
    prints = active.mapInArrow(_fingerprints(block, n_buckets), "bucket int, roll binary, codes binary, owners binary, blocks binary")
    hits = prints.groupBy("bucket").applyInArrow(_hits, "doc_id long, block int")
    hits = written(hits.groupBy("doc_id").agg(F.array_sort(F.collect_set("block")).alias("hits")), "hits")
    reps = join_ids(active, hits.select("doc_id"), "doc_id", hits.count())
    reps = written(reps.join(hits, "doc_id"), "anchored")
    cands = reps.mapInArrow(_candidates(window, block, n_buckets), "bucket int, codes binary, owners binary, starts binary")
    starts = cands.groupBy("bucket").applyInArrow(_repeats(window), "doc_id long, starts binary")
    starts = written(starts.groupBy("doc_id").agg(F.collect_list("starts").alias("starts")), "starts")
    cut = reps.select("doc_id", "text").join(starts, "doc_id").mapInArrow(
        _cut(window), "doc_id long, n_words long, n_removed long, kept_text string")
    summary = summary.join(groups.select("all_sha256", "n_words", F.lit(True).alias("copied")), ["all_sha256", "n_words"], "left")
    return summary.select("own_id", "doc_id", "n_words", "all_sha256",
                          (F.coalesce("copied", F.lit(False)) & (F.col("n_words") >= window)).alias("copied")), cut


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def removed_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    summary, cut = repeated_passages(docs, window)
    cut = cut.where("n_removed > 0").select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("cut_sha256"))
    return summary.join(cut.distinct(), ["doc_id", "n_words"], "left").select(
        F.col("own_id").alias("doc_id"), "n_words",
        F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copied"), F.lit(EMPTY_SHA256)).otherwise(F.coalesce("cut_sha256", "all_sha256")).alias("kept_sha256"))
