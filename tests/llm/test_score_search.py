"""Operators 3 and 4 against brute force."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from bourse.llm import ann, lm_score


@pytest.fixture(scope="module")
def vocabulary():
    return lm_score.vocabulary(public_tokenizers.path(lm_score.VOCABULARY))


def test_forward_recursion_sums_all_segmentations(vocabulary):
    surfaces, p = vocabulary
    assert p.sum() == pytest.approx(1)
    prob = dict(zip(surfaces, p))

    def total(w):  # every segmentation, one by one
        return prob.get(w, 0) + sum(prob[w[:i]] * total(w[i:]) for i in range(1, len(w)) if w[:i] in prob)

    words = [b" the", b" in", " été".encode(), b" x1", b" market", b" \xff"]
    got = lm_score.Lattice(surfaces, p).log_marginal(words)
    assert got == pytest.approx([math.log(total(w)) for w in words], rel=1e-9)


def test_expected_pieces_cover_the_text_and_long_words_agree(vocabulary):
    surfaces, p = vocabulary
    lattice = lm_score.Lattice(surfaces, p)
    long = b" " + b"abcdefghij" * 9
    uses = lattice.expected([b" price", long], np.array([2.0, 1.0]))
    assert sum(len(s) * u for s, u in zip(surfaces, uses)) == pytest.approx(2 * 6 + len(long))
    short = b" " + b"abcdefghij" * 4
    one = [(a, b, k) for a in range(len(short)) for b in range(a + 1, min(len(short), a + lattice.most) + 1)
           if (k := lattice.by_surface.get(short[a:b])) is not None]
    zero = np.zeros(1, np.int64)
    slow = lattice._pass([(a, b, zero, np.array([k])) for a, b, k in one], 1, len(short))[-1, 0]
    assert lattice.log_marginal([short])[0] == pytest.approx(slow)


def test_base_scores_equal_brute_force(docs, rows):
    got = {r.doc_id: r for r in lm_score.score(docs, steps=1, slice_bytes=3000).collect()}
    words = {d: (t or "").encode().lower().split() for d, t, *_ in rows}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in words}
    c = collections.Counter(w for d, ws in words.items() if not held[d] for w in ws)
    ends = sum(not h for h in held.values())
    n, v = sum(c.values()) + ends, len(c) + 1
    for d, ws in words.items():
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n)
        assert r.base_score == pytest.approx(base)
        assert -math.inf < r.score < 0
    # one slice for all gives the same
    whole = {r.doc_id: r.score for r in lm_score.score(docs, steps=1).collect()}
    assert whole == pytest.approx({d: r.score for d, r in got.items()})


def test_score_without_training_documents(spark, no_docs):
    assert lm_score.score(no_docs).collect() == []
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    r = lm_score.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score < 0


def vectors(spark, n=1500, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 8)).round(3).astype(np.float32)
    x[40:80] = x[7]  # one vector that many rows share
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(n)]
    bad = [(n + 1, None, 1), (n + 2, [0.0] * 8, 1), (n + 3, [float("nan")] + [1.0] * 7, 1), (n + 4, [float("inf")] + [1.0] * 7, 1),
           (n + 5, [None] + [1.0] * 7, 1), (n + 6, [1.0], 1), (None, [1.0] * 8, 1)]
    return spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int"), x.astype(float)


def exact(x, ids, k):
    out = {}
    for i in ids:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:k]
        out[i] = [(j, d[j]) for j in order]
    return out


def test_search_recall_and_exact_scores(spark):
    table, x = vectors(spark)
    v = ann.valid(table)
    got = collections.defaultdict(list)
    for r in ann.search(v, v.where("id % 10 = 0"), half=16).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    want = exact(x, range(0, len(x), 10), 10)
    assert set(got) == set(want)
    hit = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hit >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert [s for _, s in found] == pytest.approx([np.sqrt(((x[v] - x[q]) ** 2).sum()) for v, _ in found])
        assert found == sorted(found, key=lambda t: (t[1], t[0]))


def test_search_of_few_vectors_is_exhaustive_with_ties_by_id(spark):
    rows = [(i, [float(i % 3), 1.0, 2.0, 0.0]) for i in range(9)]
    v = ann.valid(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = [(r.query_id, r.rank, r.vec_id) for r in ann.search(v, v.where("id = 0"), k=20).collect()]
    assert sorted(got) == [(0, i + 1, v) for i, v in enumerate([3, 6, 1, 4, 7, 2, 5, 8])]
    none = ann.valid(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert ann.search(none, none).collect() == []


def test_walk_visits_cells_by_rising_distance():
    da, db = np.array([3.0, 0.0, 1.0]), np.array([0.5, 0.0])
    counts = np.ones(6, int)
    sums = (da[:, None] + db).ravel()
    order = ann.walk(da, db, counts, 6)
    assert sorted(order) == list(range(6)) and [sums[i] for i in order] == sorted(sums)
    assert len(ann.walk(da, db, counts, 2)) == 2
