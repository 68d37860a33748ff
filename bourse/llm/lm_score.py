"""Language-model score: likelihood over the subword lattice.

The vocabulary is an existing one (pieces and scores of a public tokenizer,
never trained here).  A word, with a mark for its start, can be cut into
pieces in many ways; its probability is the sum over all of them, computed by
forward recursion in log space over the lattice of matching pieces.  Single
bytes are pieces too, so every text has a probability.  No piece crosses a
word, so a text's probability is the product over its words and its end.

Learnt from the training documents (all but those with crc32(doc_id) mod 7 =
2), over all of their text:

* piece probabilities: the existing scores are a prior (Zipf by rank) of
  ``PRIOR`` counts, to which ``STEPS`` rounds of expected counts over all
  segmentations of all distinct training words (forward-backward) are added -
  each word once, because pieces mainly have to account for unseen words;
* one more edge per word spans it whole, with its training frequency; its
  weight is the Good-Turing estimate 1 - (words seen once) / tokens.

On Spark: one pass turns the texts into slices of at most ``SLICE_BYTES``
text (distinct words, and each document's words as numbers into them).  The
distinct words of all slices are counted by a shuffle on the word; pieces and
scores are computed once per distinct word, never per token; the scores go
back to the slices by word and are summed per document there.  A frequent
word is one row per slice.  To the driver come only vocabulary-sized counts.

Defined results: null text is an empty document, which still has its end; a
null doc_id is a training document; without training documents all counts are
0 and the prior scores; repeated rows are scored and counted each; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import narrow, written
from .text import text_slices, words_of

VOCABULARY = "piece_bpe_32k.model"
SLICE_BYTES = 32 << 20
SLICE_DOCS = 1 << 17
STEPS = 2
PRIOR = 1_000.0
LONG = 64  # longer words are done one by one
FOLDS, HELD_OUT = 7, 2

_K = 0x9E3779B97F4A7C15


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """(surfaces, prior probabilities).  A word start is a space; a score of
    -r states rank r, whose prior is in proportion to 1 / (1 + r)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    last = 1.0 / (1.0 + model.get_piece_size())
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        surface = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        if any(x in b" \t\n\x0b\x0c\r" for x in surface[1:]):
            continue  # would cross a word
        weight[surface] = weight.get(surface, 0.0) + (last if model.is_byte(i) else 1.0 / (1.0 - min(0.0, model.get_score(i))))
    for b in range(256):
        weight.setdefault(bytes([b]), last)
    p = np.array(list(weight.values()))
    return list(weight), p / p.sum()


class Lattice:
    """Marginal log probabilities of words and expected piece counts."""

    def __init__(self, surfaces: list[bytes], p: np.ndarray):
        self.most = max(map(len, surfaces))
        self.logp = np.log(p)
        self.by_surface = {s: i for i, s in enumerate(surfaces)}
        key = np.array([self._hash(s) for s in surfaces], np.uint64)
        self.order = np.argsort(key)
        self.key = key[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(key >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _hash(s: bytes) -> int:
        h = 0
        for b in s:
            h = ((h ^ (h >> 29)) * _K + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _edges(self, m: np.ndarray):
        """(start, end, rows, pieces) of all matches in rows of one length."""
        n, size = m.shape
        cols = [m[:, j].astype(np.uint64) + np.uint64(1) for j in range(size)]
        for i in range(size):
            h = np.zeros(n, np.uint64)
            for j in range(i, min(size, i + self.most)):
                h = (h ^ (h >> np.uint64(29))) * np.uint64(_K) + cols[j]
                rows = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
                if len(rows):
                    at = np.minimum(np.searchsorted(self.key, h[rows]), len(self.key) - 1)
                    ok = self.key[at] == h[rows]
                    if ok.any():
                        yield i, j + 1, rows[ok], self.order[at[ok]]

    def _groups(self, words: list[bytes]):
        size = np.array([len(w) for w in words])
        for length in np.unique(size):
            at = np.flatnonzero(size == length)
            if length <= LONG:
                yield at, np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(len(at), length), None
            else:
                for i in at:
                    w = words[i]
                    yield np.array([i]), None, [(a, b, k) for a in range(length) for b in range(a + 1, min(length, a + self.most) + 1)
                                                if (k := self.by_surface.get(w[a:b])) is not None]

    def _pass(self, edges, n: int, size: int) -> np.ndarray:
        """Forward: alpha[j] = log-sum over edges that end at j."""
        alpha = np.full((size + 1, n), -np.inf)
        alpha[0] = 0.0
        for i, j, rows, piece in edges:
            alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + self.logp[piece])
        return alpha

    def _as_edges(self, m, long):
        if long is None:
            return list(self._edges(m))
        zero = np.zeros(1, np.int64)
        return [(a, b, zero, np.array([k])) for a, b, k in long]

    def log_marginal(self, words: list[bytes]) -> np.ndarray:
        out = np.empty(len(words))
        for at, m, long in self._groups(words):
            if long is None:
                out[at] = self._pass(self._edges(m), len(at), m.shape[1])[-1]
            else:
                alpha = [0.0] + [-math.inf] * len(words[at[0]])
                for a, b, k in long:
                    x, y = alpha[b], alpha[a] + self.logp[k]
                    hi, lo = (x, y) if x > y else (y, x)
                    alpha[b] = hi + math.log1p(math.exp(lo - hi)) if hi > -math.inf else hi
                out[at] = alpha[-1]
        return out

    def expected(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Expected uses of every piece over all segmentations, weighted."""
        total = np.zeros(len(self.logp))
        for at, m, long in self._groups(words):
            size = len(words[at[0]])
            edges = self._as_edges(m, long)
            alpha = self._pass(edges, len(at), size)
            beta = np.full_like(alpha, -np.inf)
            beta[size] = 0.0
            # by falling start, every edge's end is finished before it is used
            for i, j, rows, piece in reversed(edges):
                through = beta[j, rows] + self.logp[piece]
                beta[i, rows] = np.logaddexp(beta[i, rows], through)
                total += np.bincount(piece, weights[at[rows]] * np.exp(alpha[i, rows] + through - alpha[size, rows]), len(total))
        return total


def _is_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def _slices(limit: int):
    def run(batches):
        part, held, size = TaskContext.get().partitionId(), [], 0
        count, docs = 0, 0

        def flush():
            nonlocal held, size, count, docs
            ids = [x for h in held for x in h[0]]
            hashes = np.concatenate([h[1] for h in held])
            known, code, n = np.unique(hashes, return_inverse=True, return_counts=True)
            rank = np.empty(len(known), np.int64)
            rank[np.argsort(-n, kind="stable")] = np.arange(len(known))  # frequent words get small numbers
            code = rank[code]
            words: list = [None] * len(known)
            for h in held:
                for x, w in zip(rank[np.searchsorted(known, h[3])], h[4]):
                    words[x] = w
            per = np.concatenate([h[2] for h in held])
            train = np.array([not _is_held_out(x) for x in ids], bool)
            seen = np.bincount(code[np.repeat(train, per)], minlength=len(known))
            out = pa.RecordBatch.from_arrays([
                pa.array([part << 32 | count], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([per.tolist()], pa.list_(pa.int64())),
                pa.array([code.astype("<u4").tobytes()], pa.binary()), pa.array([words], pa.list_(pa.binary())),
                pa.array([seen.tolist()], pa.list_(pa.int64()))], names=["slice", "ids", "n_words", "codes", "words", "seen"])
            held, size, count, docs = [], 0, count + 1, 0
            return out

        for batch in batches:
            for some in text_slices(batch):
                w = words_of(some.column("text"), fold=True)
                h, first = np.unique(w.hash, return_index=True)
                raw = w.data.tobytes()
                held.append((some.column("doc_id").to_pylist(), w.hash, np.bincount(w.doc, minlength=w.n_docs),
                             h, [raw[a:b] for a, b in zip(w.start[first].tolist(), w.end[first].tolist())]))
                size, docs = size + len(w.data), docs + some.num_rows
                if size >= limit or docs >= SLICE_DOCS:
                    yield flush()
        if held:
            yield flush()
    return run


def _expect(surfaces: list[bytes], p: np.ndarray):
    def run(batches):
        lattice, total = Lattice(surfaces, p), np.zeros(len(p))
        for batch in batches:
            words = [b" " + w for w in batch.column("word").to_pylist()]
            total += lattice.expected(words, np.ones(len(words)))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["piece", "uses"])
    return run


def _marginals(surfaces: list[bytes], p: np.ndarray, whole: float, n: int):
    """Adds the log10 probability of each word to (word, c)."""
    def run(batches):
        lattice = Lattice(surfaces, p)
        for batch in batches:
            c = np.asarray(batch.column("c"), dtype=np.float64)
            pieces = lattice.log_marginal([b" " + w for w in batch.column("word").to_pylist()]) + math.log1p(-whole)
            with np.errstate(divide="ignore"):
                known = np.log(whole * c / max(n, 1)) if whole else np.full(len(c), -np.inf)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(np.logaddexp(known, pieces) / math.log(10))],
                                             names=["word", "c", "score"])
    return run


def _sum(n: int, v: int, c_end: int, end_score: float):
    def run(slices: pa.Table, scores: pa.Table) -> pa.Table:
        """Per-document sums of one slice."""
        at = np.asarray(scores.column("at"))
        c, model = np.zeros(len(at), np.int64), np.zeros(len(at))
        c[at], model[at] = np.asarray(scores.column("c")), np.asarray(scores.column("score"))
        base = np.log10((c + 1.0) / (n + v + 1))
        end = math.log10((c_end + 1.0) / (n + v + 1))
        out = []
        for ids, per, codes in zip(slices.column("ids").to_pylist(), slices.column("n_words").to_pylist(), slices.column("codes").to_pylist()):
            code, per = np.frombuffer(codes, "<u4").astype(np.int64), np.array(per)
            doc = np.repeat(np.arange(len(ids)), per)
            out.append(pa.table({
                "doc_id": pa.array(ids, pa.int64()), "held_out": [_is_held_out(x) for x in ids], "n_tokens": pa.array(per + 1, pa.int64()),
                "n_known": pa.array(np.bincount(doc, c[code] > 0, len(ids)).astype(np.int64) + (c_end > 0)),
                "train_tokens": pa.array(np.full(len(ids), n, np.int64)),
                "base_score": np.bincount(doc, base[code], len(ids)) + end, "score": np.bincount(doc, model[code], len(ids)) + end_score}))
        return pa.concat_tables(out) if out else pa.table({k: pa.array([], t) for k, t in (
            ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
            ("base_score", pa.float64()), ("score", pa.float64()))})
    return run


def score(docs: DataFrame, vocabulary_path: str | None = None, steps: int = STEPS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every document; scores are log10 probabilities of the whole text."""
    if vocabulary_path is None:
        import public_tokenizers

        vocabulary_path = public_tokenizers.path(VOCABULARY)
    surfaces, prior = vocabulary(vocabulary_path)
    slices = written(narrow(docs).mapInArrow(
        _slices(slice_bytes), "slice long, ids array<long>, n_words array<long>, codes binary, words array<binary>, seen array<long>"), "slices")
    per_slice = slices.select("slice", F.posexplode(F.arrays_zip("words", "seen")).alias("at", "x")).select(
        "slice", "at", F.col("x.words").alias("word"), F.col("x.seen").alias("seen"))
    words = written(per_slice.groupBy("word").agg(F.sum("seen").alias("c")), "words")
    n_words, v, once = words.where("c > 0").agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum((F.col("c") == 1).cast("long")), F.lit(0))).first()
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    c_end = slices.select(F.explode("ids").alias("id")).where(~held).count()
    n, v = n_words + c_end, v + (c_end > 0)
    p = prior
    for _ in range(steps if n_words else 0):
        uses = words.where("c > 0").mapInArrow(_expect(surfaces, p), "piece int, uses double").groupBy("piece").agg(F.sum("uses"))
        new = PRIOR * prior
        for piece, x in uses.collect():  # at most one row per piece of the vocabulary
            new[piece] += x
        p = new / new.sum()
    whole = 1.0 - min(0.5, max(once, 1) / n) if n else 0.0
    stop = (c_end + 1.0) / (n + 1.0 + PRIOR)  # the end among pieces
    end_score = math.log10(whole * c_end / max(n, 1) + (1 - whole) * stop)
    known = words.mapInArrow(_marginals(surfaces, p * (1 - stop), whole, n), "word binary, c long, score double")
    back = per_slice.select("slice", "at", "word").join(known, "word").select(F.col("slice").alias("in_slice"), "at", "c", "score")
    return slices.select("slice", "ids", "n_words", "codes").groupBy("slice").cogroup(back.groupBy("in_slice")).applyInArrow(
        _sum(n, v, c_end, end_score),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
