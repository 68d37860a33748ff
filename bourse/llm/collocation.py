"""Collocations of 2 to 4 words, counted by prefix-free parsing.

A text is cut at sentence punctuation into pieces and those into words.  A
piece is parsed into chunks: wherever the hash of ``OVERLAP`` words in a row is
0 modulo ``TRIGGER``, a chunk ends with these words and the next one begins
with them.  Where a chunk is cut depends on its content only, so equal passages
give equal chunks, and the corpus becomes a dictionary of distinct chunks with
their parse frequencies; a passage that a third of all documents share is one
row of it.  Phrases are counted inside the distinct chunks, times the chunk's
frequency.  A phrase of up to OVERLAP + 1 words lies whole in the chunk in
which it starts; the starts within the last ``OVERLAP`` words belong to the
next chunk, unless the piece ends there, so each occurrence counts once.

Phrases are counted by length.  A phrase can only reach ``min_count`` if its
two parts of one word less do, so each length is counted where both parts may
be frequent.  What is frequent travels as a Bloom filter of ``FILTER_BITS``
bits, whatever the number of phrases: it lets too much through if it is
crowded, never too little, and the counts are made of the phrases themselves.

Everything after that is joins of counts: the weakest cut of each candidate by
an integer score, candidates that a longer one covers go, and the first
``top`` of each language are ranked per salted part before they meet.

Defined results: null text is empty, null lang is ``und``; rows count as often
as they stand, with or without a doc_id; a language without candidates has no
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written
from .text import buffers, mix, text_slices

LONGEST = 4
OVERLAP = LONGEST - 1
TRIGGER = 16
MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
COVER_PERCENT = 80
SALT = 32
SLICE = 2 << 20
SHORT = 48                  # bytes up to which words are hashed side by side
SEGMENT = 1 << 16           # bytes of one piece of the filter
FILTER_BITS = 1 << 27       # 16 MB
NO_LANG = "und"

_SPACE, _CUT = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _CUT
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def ended(strings: pa.Array, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array with ``mark`` after each."""
    raw, off = buffers(strings)
    return np.insert(raw, off[1:], np.uint8(mark)), off + np.arange(len(off))


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a large_binary array without nulls."""
    _, off, data = strings.buffers()
    off = np.frombuffer(off, np.int64)[strings.offset:strings.offset + len(strings) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def _strings(data: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_utf8(), len(off) - 1, [None, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings data[start:end]; they may overlap."""
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)])
    return _strings(data[np.repeat(start - off[:-1], size) + np.arange(off[-1])], off)


class Line:
    """Words of a slice joined by single spaces: word i is
    data[start[i]:end[i]], ``code[i]`` its number among ``distinct``."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.start, self.end = data, start, end
        gone = np.zeros(len(data) + 1, bool)
        gone[end] = True  # the space after each word
        off = np.concatenate([[0], np.cumsum(end - start)])
        found = _strings(data[~gone[:len(data)]], off).dictionary_encode()
        self.code = np.asarray(found.indices, np.int64)
        self.distinct = found.dictionary

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, the same wherever the word stands."""
        raw, off = _bytes_of(self.distinct.cast(pa.large_binary()))
        h = np.full(len(self.distinct), _PRIME)
        size, at = off[1:] - off[:-1], off[:-1].copy()
        live = np.flatnonzero(size <= SHORT)
        for i in np.flatnonzero(size > SHORT):
            h[i] = int.from_bytes(hashlib.blake2b(raw[off[i]:off[i + 1]].tobytes(), digest_size=8).digest(), "little")
        while len(live):  # one byte of every word that has one
            live = live[at[live] < off[live + 1]]
            h[live] = (h[live] ^ raw[at[live]]) * np.uint64(0x100000001B3)
            at[live] += 1
        return mix(h + size.astype(np.uint64))[self.code]

    def phrases(self, first: np.ndarray, n: int) -> pa.Array:
        return _spans(self.data, self.start[first], self.end[first + n - 1])


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (too short at the end)."""
    m = max(len(h) - n + 1, 0)
    acc = np.full(m, np.uint64(n))
    for t in range(n):
        acc = acc * _PRIME + h[t:t + m]
    return mix(acc)


def _normalised(texts: pa.Array) -> tuple[Line, np.ndarray, np.ndarray]:
    """(line, piece, document) of all words of a text column."""
    data, off = ended(texts, 0x0A)
    data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))
    kind = _KIND[data]
    ink = kind == 0
    start = np.flatnonzero(ink & ~np.concatenate([[False], ink[:-1]])) if len(ink) else np.zeros(0, np.int64)
    after = np.flatnonzero(~ink & np.concatenate([[False], ink[:-1]])) if len(ink) else np.zeros(0, np.int64)
    piece = np.cumsum(kind == _CUT)[start] if len(start) else start
    doc = np.searchsorted(off, start, "right") - 1
    keep = ink.copy()
    keep[after] = True
    line = data[keep]
    size = after - start
    at = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    line[at + size] = 0x20
    return Line(line, at, at + size), piece, doc


def parse(texts: pa.Array, langs: pa.Array, trigger: int = TRIGGER) -> pa.Table:
    """(lang, last, chunk, n): the distinct chunks of a slice; ``last`` if
    the piece ends with the chunk."""
    line, piece, doc = _normalised(texts)
    n = len(line.start)
    new = np.ones(n, bool)
    new[1:] = piece[1:] != piece[:-1]
    first = np.flatnonzero(new)                      # first word of each piece
    stop = np.append(first[1:], n)                   # word after its last
    own = np.cumsum(new) - 1
    hit = windows(line.hashes(), OVERLAP) % np.uint64(trigger) == 0
    cut = np.flatnonzero(hit)
    cut = cut[~new[cut] & (cut + OVERLAP <= stop[own[cut]])]
    begin = np.union1d(first, cut)
    last = np.ones(len(begin), bool)
    last[:-1] = own[begin[1:]] != own[begin[:-1]]
    finish = np.where(last, stop[own[begin]], np.append(begin[1:], 0) + OVERLAP) - 1
    chunks = _spans(line.data, line.start[begin], line.end[finish])
    table = pa.table({"lang": langs.take(pa.array(doc[begin])).dictionary_encode(), "last": pa.array(last),
                      "chunk": chunks.dictionary_encode(), "n": pa.array(np.ones(len(begin), np.int64))})
    return table.group_by(["lang", "last", "chunk"]).aggregate([("n", "sum")])


def _out(lang: pa.Array, phrase: pa.Array, n: np.ndarray, names: list[str], *more) -> pa.RecordBatch:
    cols = [lang.cast(pa.string()), *more, phrase.cast(pa.large_utf8()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(cols, names=names)


def _parse_all(trigger: int):
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, limit=SLICE):
                t = parse(part.column("text"), part.column("lang"), trigger).combine_chunks()
                for b in t.to_batches():
                    plain = [b.column(c).cast(pa.large_utf8()) for c in ("lang", "chunk")]
                    yield _out(plain[0], plain[1], np.asarray(b.column("n_sum")), ["lang", "last", "chunk", "n"], b.column("last"))
    return run


def _lines(chunks: pa.Array) -> tuple[Line, np.ndarray]:
    """The words of chunks, and the chunk of each word."""
    data, off = ended(chunks, 0x20)
    end = np.flatnonzero(data == 0x20)
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    return Line(data, start, end), np.searchsorted(off, start, "right") - 1


def _probe(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two bit positions of each hash."""
    return [(h % np.uint64(bits)).astype(np.int64), (mix(h) % np.uint64(bits)).astype(np.int64)]


def _may_hold(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits, ok = len(bitmap) * 8, np.ones(len(h), bool)
    for p in _probe(h, bits):
        ok &= (bitmap[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
    return ok


def _seeded(h: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Phrase hashes made different by language."""
    return mix(h ^ lang)


def _lang_hash(langs: pa.Array) -> np.ndarray:
    found = langs.dictionary_encode()
    names = [int.from_bytes(x.encode()[:64], "little") * 0x9E3779B97F4A7C15 + len(x) & (1 << 64) - 1 for x in found.dictionary.to_pylist()]
    return mix(np.array(names, np.uint64))[np.asarray(found.indices)] if len(langs) else np.zeros(0, np.uint64)


def _count(n: int, filters):
    """Occurrences of phrases of n words that start in each chunk, summed per
    slice; ``filters`` is the broadcast filter of the shorter phrases."""
    def run(batches):
        bitmap = np.frombuffer(filters.value, np.uint8) if filters is not None else None
        for batch in batches:
            for part in text_slices(batch, "chunk", SLICE):
                line, own = _lines(part.column("chunk"))
                total = np.bincount(own, minlength=part.num_rows)
                left = np.cumsum(total)[own] - np.arange(len(own))  # words from here to the end of the chunk
                last = np.asarray(part.column("last"))[own]
                ok = (left >= n) & (last | (left > OVERLAP))
                if bitmap is not None:
                    seed = _lang_hash(part.column("lang"))[own]
                    may = np.zeros(len(own), bool)
                    h = windows(line.hashes(), n - 1)
                    may[:len(h)] = _may_hold(bitmap, _seeded(h, seed[:len(h)]))
                    ok &= may & np.append(may[1:], False)
                first = np.flatnonzero(ok)
                t = pa.table({"lang": part.column("lang").take(pa.array(own[first])).dictionary_encode(),
                              "phrase": (line.phrases(first, n)).dictionary_encode(),
                              "n": pa.array(np.asarray(part.column("n"))[own[first]])})
                t = t.group_by(["lang", "phrase"]).aggregate([("n", "sum")]).combine_chunks()
                for b in t.to_batches():
                    yield _out(b.column("lang"), b.column("phrase"), np.asarray(b.column("n_sum")), ["lang", "phrase", "n"])
    return run


def _mark(bits: int):
    """Segments of the Bloom filter of the phrases."""
    def run(batches):
        bitmap = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            line, own = _lines(batch.column("phrase"))
            if not batch.num_rows:
                continue
            n = int(np.bincount(own)[0])  # all phrases have n words
            h = windows(line.hashes(), n)[::n]
            for p in _probe(_seeded(h, _lang_hash(batch.column("lang"))), bits):
                np.bitwise_or.at(bitmap, p >> 3, np.uint8(1) << (p & 7).astype(np.uint8))
        size = min(SEGMENT, len(bitmap))
        parts = [(i, bitmap[a:a + size].tobytes()) for i, a in enumerate(range(0, len(bitmap), size)) if bitmap[a:a + size].any()]
        cols = list(zip(*parts)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary())], names=["segment", "bits"])
    return run


def _merge(batches):
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, raw in zip(batch.column("segment").to_pylist(), batch.column("bits")):
            bits = np.frombuffer(raw.as_buffer(), np.uint8)
            held[i] = held[i] | bits if i in held else bits
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["segment", "bits"])


def bloom(phrases: DataFrame, count: int, bits: int = FILTER_BITS):
    """The broadcast filter of ``phrases`` (lang, phrase): at most ``bits``
    bits, fewer for few phrases."""
    bits = max(1 << 16, min(bits, 1 << (16 * max(count, 1) - 1).bit_length()))
    kinds = "segment int, bits binary"
    parts = phrases.select("lang", "phrase").mapInArrow(_mark(bits), kinds).repartition(16, "segment").mapInArrow(_merge, kinds)
    bitmap = np.zeros(bits // 8, np.uint8)
    size = min(SEGMENT, len(bitmap))
    for i, raw in parts.toLocalIterator():
        bitmap[i * size:(i + 1) * size] |= np.frombuffer(raw, np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(bitmap.tobytes())


def dictionary(docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """(lang, last, chunk, n): the distinct chunks of the corpus and how often
    each occurs in its parse."""
    base = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parsed = base.mapInArrow(_parse_all(trigger), "lang string, last boolean, chunk string, n long")
    return written(parsed.groupBy("lang", "last", "chunk").agg(F.sum("n").alias("n")), "chunks")


def frequent(chunks: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of k = 1..longest words that occur
    ``min_count`` times, and (lang, n): all words."""
    if longest > OVERLAP + 1:
        raise ValueError(f"chunks overlap by {OVERLAP} words: phrases have at most {OVERLAP + 1}")
    found, words, filters = [], None, None
    for k in range(1, longest + 1):
        counts = chunks.mapInArrow(_count(k, filters), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        if k == 1:
            counts = written(counts, "words")
            words = counts.groupBy("lang").agg(F.sum("f").alias("n"))
        often = written(counts.where(F.col("f") >= min_count), f"phrases-{k}")
        found.append(often.withColumn("k", F.lit(k)))
        if k < longest:
            filters = bloom(often, often.count())
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("lang", "phrase", "k", "f"), words


def _part(phrase, first: int, n: int):
    """Words first..first + n - 1 of a phrase."""
    return F.array_join(F.slice(F.split(phrase, " ", -1), first + 1, n), " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, score) of the candidates: the cut with the
    smallest floor(SCALE * a / (l + r)), ties to the first."""
    cand = counts.where("k > 1").withColumnRenamed("f", "a")
    cuts = cand.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    words = F.split("phrase", " ", -1)
    sides = cuts.select("lang", "phrase", "k", "a", "cut", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("part")),
        F.struct(F.lit(1).alias("side"), F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("part")))).alias("s")).select(
        "lang", "phrase", "k", "a", "cut", "s.side", "s.part")
    parts = counts.select("lang", F.col("phrase").alias("part"), "f")
    both = sides.join(parts, ["lang", "part"]).groupBy("lang", "phrase", "k", "a", "cut").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * {SCALE}BD) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = both.withColumn("score", score).groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "k", "a", "b.l", "b.r", "b.score")


def covered(cand: DataFrame, longest: int = LONGEST, percent: int = COVER_PERCENT) -> DataFrame:
    """(lang, phrase) of the candidates (lang, phrase, k, a) that lie inside a
    longer one with at least ``percent`` per cent of their count."""
    inner = [F.when(F.col("k") == k, F.array(*[_part("phrase", i, n) for n in range(2, k) for i in range(k - n + 1)]))
             for k in range(3, longest + 1)]
    longer = cand.where("k > 2").select("lang", F.explode(F.coalesce(*inner)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    big = [F.col(c).cast("decimal(20,0)") for c in ("most", "a")]
    return cand.join(longer, ["lang", "phrase"]).where(F.lit(100) * big[0] >= F.lit(percent) * big[1]).select("lang", "phrase")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, longest: int = LONGEST, trigger: int = TRIGGER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of
    each language."""
    counts, words = frequent(dictionary(docs, trigger), min_count, longest)
    cand = written(scored(counts), "candidates")
    left = cand.join(covered(cand, longest), ["lang", "phrase"], "left_anti").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALT)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(min_count: int = MIN_COUNT, top: int = TOP) -> str:
    """DuckDB SQL for the query on ``documents``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, array_to_string(w[i:i + {k - 1}], ' ') AS phrase "
        f"FROM (SELECT lang, w, unnest(generate_series(1, len(w) - {k - 1})) AS i FROM p WHERE len(w) >= {k})" for k in range(1, LONGEST + 1))
    return f"""
WITH t AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
      FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t)),
g AS ({grams}),
c AS (SELECT lang, phrase, k, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, phrase, k),
tot AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND f >= {min_count}),
cut AS (SELECT lang, phrase, k, a, w, unnest(generate_series(1, k - 1)) AS cut FROM cand),
s AS (SELECT x.lang, x.phrase, x.k, x.a, x.cut, y.f AS l, z.f AS r, ({SCALE} * x.a) // (y.f + z.f) AS score FROM cut x
      JOIN c y ON y.lang = x.lang AND y.phrase = array_to_string(x.w[1:x.cut], ' ')
      JOIN c z ON z.lang = x.lang AND z.phrase = array_to_string(x.w[x.cut + 1:x.k], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sub AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, a, w, m, unnest(generate_series(1, k - m + 1)) AS i
              FROM (SELECT lang, a, w, k, unnest(generate_series(2, k - 1)) AS m FROM cand WHERE k > 2))),
cover AS (SELECT lang, phrase, max(a) AS most FROM sub GROUP BY lang, phrase),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
           FROM best b LEFT JOIN cover v ON v.lang = b.lang AND v.phrase = b.phrase WHERE v.most IS NULL OR 100 * v.most < {COVER_PERCENT} * a)
SELECT r.lang, r.rank, r.phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN tot ON tot.lang = r.lang WHERE r.rank <= {top}"""
