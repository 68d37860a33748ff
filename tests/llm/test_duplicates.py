"""Operators 7 and 8 against brute force."""

import collections
import hashlib

import pytest

from bourse.llm import minhash, substring


def near_brute(rows):
    sets = {}
    for d, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[d] = set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def passages_brute(rows, size):
    words = {d: (t or "").encode().split() for d, t, *_ in rows}
    seen = collections.Counter(tuple(w[i:i + size]) for w in words.values() for i in range(len(w) - size + 1))
    out = {}
    for d, w in words.items():
        covered = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                covered[i:i + size] = [True] * size
        kept = b" ".join(x for x, c in zip(w, covered) if not c)
        out[d] = (len(w), sum(covered), hashlib.sha256(kept).hexdigest())
    return out


def test_near_duplicates_equal_brute_force(docs, rows):
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(docs).collect()}
    assert got == near_brute(rows)
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.select("doc_id").collect()} == {d for d, v in got.items() if v[2]}


def test_near_duplicates_of_a_group_linked_through_its_base(spark):
    """Variants far from each other but near a common base: one component,
    though most hubs of a bucket are not near most members."""
    base = [f"w{i}" for i in range(200)]
    rows = [(1000, " ".join(base))]
    for k in range(30):
        w = list(base)
        w[6 * k + 3] = f"v{k}"  # costs 5 of 196 shingles
        w[(6 * k + 95) % 200] = f"u{k}"
        w[(6 * k + 50) % 200] = f"t{k}"
        rows.append((k, " ".join(w)))
    got = {r[0]: tuple(r[1:]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_brute(rows)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (20, 30), (25, 30), (4, 4), (40, 41), (41, 42), (42, 40)]
    got = {r.node: r.component for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 20: 20, 25: 20, 30: 20, 40: 40, 41: 40, 42: 40}
    path = [(i, i + 1) for i in range(9)]
    assert {r.component for r in minhash.components(spark.createDataFrame(path, "a long, b long")).collect()} == {0}


@pytest.mark.parametrize("size", [35, 6])
def test_passages_equal_brute_force(docs, rows, size):
    got = {r[0]: tuple(r[1:]) for r in substring.removed_words(docs, size).collect()}
    assert got == passages_brute(rows, size)


def test_repeated_and_null_ids_are_documents_of_their_own(spark, rows):
    """Texts of one id, texts without id, ids beyond 2^53."""
    word = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    p, q = word("p", 60), word("q", 50)
    odd = [(1, word("a", 80)), (2, word("a", 80)), (2, f"{word('b', 30)} {p}"), (3, f"{word('c', 20)} {p} {word('d', 5)}"),
           (None, f"{word('e', 10)} {q}"), (5, f"{word('f', 12)} {q}"), (None, "short"), (None, None), (2**60 + 1, f"{word('g', 9)} {q}"), (-7, word("h", 99)),
           (8, word("i", 50)), (8, word("i", 50)), (9, "x y"), (9, "x y z")]
    texts = {i: t for i, (_, t) in enumerate(odd)}
    want = passages_brute([(i, t) for i, t in texts.items()], 35)
    got = [tuple(r) for r in substring.removed_words(spark.createDataFrame(odd, "doc_id long, text string").repartition(3)).collect()]
    assert sorted(got, key=str) == sorted([(odd[i][0], *v) for i, v in want.items()], key=str)
    assert want[2][1] == want[3][1] == 60 and want[4][1] == want[5][1] == want[8][1] == 50


def test_words_that_a_linear_hash_confuses(spark):
    """The Thue-Morse word over ab and its complement."""
    t = "a"
    for _ in range(10):
        t += t.translate(str.maketrans("ab", "ba"))
    u = t.translate(str.maketrans("ab", "ba"))
    from bourse.llm.text import words_of
    import pyarrow as pa
    assert len(set(words_of(pa.array([f"{t} {u} {t}"])).hash.tolist())) == 2
    fill = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{t} {t} {t} {t} {t} {fill}"), (2, f"{u} {u} {u} {u} {u}"), (3, f"{t} {t} {t} {t} {t}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 3}
    got = {r[0]: tuple(r[1:]) for r in substring.removed_words(docs, 4).collect()}
    assert got == passages_brute(rows, 4)


def pairs_of_group(spark, monkeypatch, n):
    """Pairs compared in a group of n documents of 120 words, 3 of them edited
    at random."""
    import random

    rnd = random.Random(n)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(n):
        w = list(base)
        for i in rnd.sample(range(120), 3):
            w[i] = f"e{k}-{i}"
        rows.append((k, " ".join(w)))
    seen = []
    old = minhash._candidates
    monkeypatch.setattr(minhash, "_candidates", lambda *a: (lambda df: (seen.append(df.count()), df)[1])(old(*a)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    monkeypatch.setattr(minhash, "_candidates", old)
    want = {d: v[1] for d, v in near_brute(rows).items()}
    return sum(seen), got, want


def test_pairs_grow_with_the_group_not_its_square(spark, monkeypatch):
    small, got, want = pairs_of_group(spark, monkeypatch, 150)
    # components found of those there are
    assert len(set(got.values())) - len(set(want.values())) <= 0.1 * (150 - len(set(want.values())))
    large, *_ = pairs_of_group(spark, monkeypatch, 300)
    assert large <= 2.6 * small, (small, large)


def test_empty_tables_and_null_ids(spark, no_docs):
    assert minhash.near_duplicates(no_docs).collect() == []
    assert substring.removed_words(no_docs).collect() == []
    lost = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c")], "doc_id long, text string")
    assert all(r.kept for r in minhash.near_duplicates(lost).collect())
    assert minhash.drop_near_duplicates(lost).count() == 3
