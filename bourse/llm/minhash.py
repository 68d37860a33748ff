"""Near-duplicate documents: one-permutation hashing with optimal
densification, banded buckets, star-shaped candidate edges.

A document is its set of distinct word 5-shingles (A-Z lower-cased; a shorter
document is one shingle, its whole word sequence; a document without words
has an empty set).  Two documents are linked if 100 * |A & B| >= 75 * |A | B|.

* One pass hashes every shingle once; the top bits choose one of 128 bins and
  each bin keeps its smallest hash.  An empty bin copies a bin found by a
  fixed pseudo-random probe sequence (optimal densification).
* 32 bands of 4 bins each give bucket keys.  A pair at the threshold shares
  no bucket with probability (1 - 0.75^4)^32 = 5e-6.
* Documents with equal sets are one class before buckets are formed, so
  groups of copies never meet in a bucket.
* Each round compares the members of a bucket with its hub only, so a round
  has fewer pairs than bucket memberships.  The hub is the member that shares
  its buckets with the most others: in a group of edited copies that is one
  close to the original.
* A bucket whose rest still holds several components is split by further bins
  (``SPLITS`` of them by round), so what is not similar parts instead of being
  compared; the hub leaves.  From the second round on, buckets of at most
  ``PAIRED`` members are compared in full and closed.  Pairs thus grow with
  the memberships, not with the square of a group, and every bucket ends with
  one component or used up.
* Splitting may part a pair at the threshold in one bucket; it stays together
  in others.  What that loses is measured (README).
* Pairs whose 128 bins agree in fewer than ``AGREE`` are no links (a pair at the
  threshold falls below with probability 1e-7); all others are confirmed on
  the full shingle sets.

Defined results: null text counts as empty; an empty set is linked with
nothing; rows that share a doc_id count as one document; rows without one are
kept; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop, narrow, written
from .text import grams, mix, text_slices, words_of

SHINGLE = 5
BINS = 128
ROWS = 4
PROBES = 1024
PERCENT = 75
SPLITS = (1, 2, 3, 4, 8)      # further bins by round, the last for all later ones
PAIRED = (0, 8, 16, 32, 64)   # bucket sizes that are compared in full
AGREE = 70                    # of 128 bins
CODE = 64                     # further bins that a bucket can be split by


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) of the distinct shingles, sorted by both."""
    w = words_of(texts, fold=True)
    h, d = grams(w, k)
    ok = d >= 0
    h, d = h[ok], d[ok]
    n_words = np.bincount(w.doc, minlength=w.n_docs)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        first = np.searchsorted(w.doc, short)
        acc = n_words[short].astype(np.uint64)
        for t in range(k - 1):
            has = n_words[short] > t
            acc[has] = acc[has] * np.uint64(0xD6E8FEB86659FD93) + w.hash[first[has] + t]
        d, h = np.concatenate([d, short]), np.concatenate([h, mix(acc ^ np.uint64(0xA5A5A5A5A5A5A5A5))])
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]


def _probes(bins: int) -> np.ndarray:
    i = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    t = np.arange(1, PROBES + 1, dtype=np.uint64)[None, :] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mix(mix(i + np.uint64(1)) + t) % np.uint64(bins)).astype(np.int64)


def signatures(doc: np.ndarray, h: np.ndarray, n_docs: int, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation signatures (n_docs x bins) after densification, and
    which documents have one.  ``doc``/``h`` as from ``shingle_sets``."""
    width = np.uint64(64 - bins.bit_length() + 1)
    cell = doc * bins + (h >> width).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    sig = np.zeros(n_docs * bins, np.uint64)
    full = np.zeros(n_docs * bins, bool)
    sig[cell[first]] = h[first]
    full[cell[first]] = True
    has = full.reshape(n_docs, bins).any(axis=1)
    probes = _probes(bins)
    base = full.copy()  # copies come from bins filled by a shingle
    todo = np.flatnonzero(~full & np.repeat(has, bins))
    for t in range(PROBES):
        if not len(todo):
            break
        src = todo // bins * bins + probes[todo % bins, t]
        hit = base[src]
        sig[todo[hit]] = sig[src[hit]]
        todo = todo[~hit]
    for c in todo:  # never met in PROBES draws: the next filled bin
        row = c // bins * bins
        steps = np.flatnonzero(np.roll(base[row:row + bins], -(c - row)))
        sig[c] = sig[row + (c - row + steps[0]) % bins]
    return sig.reshape(n_docs, bins), has


def _sketch(batches):
    for batch in batches:
        for part in text_slices(batch):
            n = part.num_rows
            d, h = shingle_sets(part.column("text"))
            sig, has = signatures(d, h, n)
            bands = BINS // ROWS
            acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
            for r in range(ROWS):
                acc = mix(acc * np.uint64(0xD6E8FEB86659FD93) + sig[:, r::ROWS])
            size = np.bincount(d, minlength=n)
            one = np.zeros(n, np.uint64)
            two = np.zeros(n, np.uint64)
            np.add.at(one, d, mix(h))
            np.add.at(two, d, mix(h ^ np.uint64(0x5851F42D4C957F2D)))
            # one byte of each bin, in an order that mixes the bands
            byte = (sig >> np.uint64(7)).astype(np.uint8)[:, np.arange(BINS) * 37 % BINS]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]), pa.int32()),
                                             pa.array(acc[has].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), lists,
                 pa.array([x.tobytes() for x in byte], pa.binary())],
                names=["doc_id", "n_shingles", "h1", "h2", "bands", "bins"])


def _sets(batches):
    for batch in batches:
        for part in text_slices(batch):
            d, h = shingle_sets(part.column("text"))
            at = np.searchsorted(d, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([h[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())],
                names=["node", "shingles"])


def _confirm(batches):
    for batch in batches:
        a, b = batch.column("a_set"), batch.column("b_set")
        ok = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            x, y = np.frombuffer(a[i].as_buffer(), np.uint64), np.frombuffer(b[i].as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok[i] = 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))


def _plausible(batches):
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("a_bins", "b_bins"))
        ok = (a == b).sum(1) >= AGREE
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable, for every node of
    ``edges`` (a, b).  Every node points to its smallest neighbour and on to
    that one's, the edges are contracted to the nodes pointed to, until none is
    left: at most log2(nodes) rounds, one for stars.  Minima are aggregated
    before the shuffle, so a node may have any number of edges."""
    out, level, left = None, edges.where("a <> b"), None
    while left != 0:
        ends = level.select("a", "b").unionByName(level.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = written(ends.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m")), "parents")
        if near.isEmpty():
            break
        onto = near.select(F.col("u").alias("m"), F.col("m").alias("component"))
        step = written(near.join(onto, "m").select(F.col("u").alias("node"), "component"), "parents")
        new = step if out is None else written(
            out.join(step.select(F.col("node").alias("component"), F.col("component").alias("c")), "component", "left").select(
                "node", F.coalesce("c", "component").alias("component")), "components")
        ends, others = step.select(F.col("node").alias("a"), F.col("component").alias("x")), step.select(F.col("node").alias("b"), F.col("component").alias("y"))
        rest = written(level.join(ends, "a").join(others, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        left = rest.count()
        drop(near, level, *([out] if out is not None else []), *([step] if new is not step else []))
        out, level = new, rest
    drop(level)
    return out if out is not None else edges.sparkSession.createDataFrame([], "node long, component long")


def _merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """``comp`` (node, component) after ``links`` (a, b): only the components
    that the links join are worked on."""
    if comp is None:
        return components(links)
    ends = links
    for c in ("a", "b"):
        ends = ends.join(comp.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")), c, "left").withColumn(c, F.coalesce(f"c{c}", c)).drop(f"c{c}")
    onto = components(ends.where("a <> b").select("a", "b").distinct())
    if onto.isEmpty():
        return comp
    to = onto.select(F.col("node").alias("component"), F.col("component").alias("c"))
    old = comp.join(to, "component", "left").select("node", F.coalesce("c", "component").alias("component"))
    out = written(old.unionByName(onto.join(comp, "node", "left_anti")), "components")
    drop(comp, onto)
    return out


def _candidates(state: DataFrame, keys: DataFrame, paired: int) -> DataFrame:
    """(a, b): members of open buckets with their hub, and all pairs of
    buckets with at most ``paired`` members; of different components and of
    sizes that allow a link."""
    may = (F.col("component") != F.col("ca")) & (100 * F.least("n_shingles", "na") >= PERCENT * F.greatest("n_shingles", "na"))
    star = state.join(keys.where(F.col("size") > paired).select(
        "key", F.col("hub.node").alias("a"), F.col("hub.n_shingles").alias("na"), F.col("hub.component").alias("ca")), "key")
    pairs = star.where((F.col("node") != F.col("a")) & may).select("a", F.col("node").alias("b"))
    if paired:
        few = state.join(keys.where(F.col("size") <= paired).select("key"), "key")
        left = few.select("key", F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("component").alias("ca"))
        pairs = pairs.unionByName(few.join(left, "key").where((F.col("node") > F.col("a")) & may).select("a", F.col("node").alias("b")))
    return pairs.distinct()


def _confirmed(pairs: DataFrame, bins: DataFrame, sets: DataFrame) -> DataFrame:
    """The linked ones of ``pairs``."""
    for c in ("a", "b"):
        pairs = pairs.join(bins.select(F.col("node").alias(c), F.col("bins").alias(f"{c}_bins")), c)
    likely = written(pairs.select("a", "b", "a_bins", "b_bins").mapInArrow(_plausible, "a long, b long"), "pairs")
    needed = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    some = sets.join(needed, "node", "left_semi")
    both = (likely.join(some.select(F.col("node").alias("b"), F.col("shingles").alias("b_set")), "b")
            .join(some.select(F.col("node").alias("a"), F.col("shingles").alias("a_set")), "a"))
    # a repeated doc_id may stand for several texts: each of them counts
    out = written(both.select("a", "b", "a_set", "b_set").mapInArrow(_confirm, "a long, b long").distinct(), "links")
    drop(likely)
    return out


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, components): ``members`` is (doc_id, n_shingles, node), node
    the smallest doc_id with the same shingle set; ``components`` is (node,
    component) for the nodes with a confirmed link."""
    base = narrow(docs)
    sketch = written(base.mapInArrow(_sketch, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, bins binary"), "sketch")
    same = ["n_shingles", "h1", "h2"]
    shared = written(sketch.where("n_shingles > 0").groupBy(*same).agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"), "classes")
    members = sketch.join(shared, same, "left").withColumn("node", F.coalesce("node", "doc_id"))
    # only keys and nodes meet here: 32 rows of each document
    rows = members.where("doc_id = node").select("node", F.posexplode("bands").alias("band", "key"))
    crowded = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    crowded = written(crowded.where("lo <> hi").select("key", "size"), "crowded")
    rows = written(rows.join(crowded, "key").select("key", "node", F.col("band").cast("byte").alias("band"), "size").distinct(), "buckets")
    # what a node shares its buckets with: the hub of a bucket has the most
    known = written(rows.groupBy("node").agg(F.sum(F.col("size") - 1).alias("shared")), "nodes")
    bins = members.where("doc_id = node").select("node", "n_shingles", "bins").join(known, "node")
    bins = written(bins.dropDuplicates(["node"]), "bins")
    sets = written(base.join(known.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").mapInArrow(_sets, "node long, shingles binary"), "sets")
    start = F.pmod(F.col("band").cast("int") * 61 + 17, F.lit(BINS))
    state = written(rows.join(bins, "node").select(
        "key", "node", "n_shingles", F.substring(F.concat("bins", "bins"), start + 1, F.lit(CODE)).alias("code"),
        F.struct(-F.col("shared"), F.xxhash64("node", F.lit(7))).alias("priority"), F.col("node").alias("component")), "state")
    drop(rows, crowded, known)
    comp, n_round, used = None, 0, 0
    while True:
        paired, split = PAIRED[min(n_round, len(PAIRED) - 1)], SPLITS[min(n_round, len(SPLITS) - 1)]
        keys = written(state.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi"),
            F.min(F.struct("priority", "node", "n_shingles", "component")).alias("hub")).where("lo <> hi").drop("lo", "hi"), "keys")
        if keys.isEmpty():
            break
        found = _confirmed(_candidates(state, keys, paired), bins, sets)
        if not found.isEmpty():
            comp = _merged(comp, found)
        # hubs and buckets compared in full leave, the rest is split
        rest = state.join(keys.where(F.col("size") > paired).select("key", F.col("hub.node").alias("hub")), "key").where("node <> hub")
        rest = rest.withColumn("key", F.xxhash64("key", F.substring("code", used + 1, split))).drop("hub", "component")
        if comp is None:
            rest = rest.withColumn("component", F.col("node"))
        else:
            rest = rest.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
        new = written(rest.select(state.columns), "state")
        drop(state, keys, found)
        state, used, n_round = new, used + split, n_round + 1
    drop(state, keys, bins, sets)
    members = members.select("doc_id", "n_shingles", "node")
    return members, comp if comp is not None else docs.sparkSession.createDataFrame([], "node long, component long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document;
    component_id is the smallest doc_id reachable over links."""
    members, comp = links(docs)
    return members.join(comp, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component,
    and all rows without a doc_id."""
    gone = written(near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
