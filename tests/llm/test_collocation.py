"""Operator 12 against plain counting."""

import collections
import random
import re

import pyarrow as pa
import pytest

from bourse.llm import collocation

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if a >= min_count and " " in p}
        most = collections.Counter()
        for p, a in cand.items():
            w = p.split(" ")
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    q = " ".join(w[i:i + k])
                    most[q] = max(most[q], a)
        rows = []
        for p, a in cand.items():
            if 100 * most[p] >= 80 * a:
                continue
            w = p.split(" ")
            cuts = [(2_000_000 * a // (c[x] + c[y]), i, c[x], c[y]) for i in range(1, len(w)) for x, y in [(" ".join(w[:i]), " ".join(w[i:]))]]
            score, _, l, r = min(cuts)
            rows.append((p, a, l, r, n[lang], score))
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i, *x) for i, x in enumerate(rows[:top], 1)]
    return sorted(out)


def corpus(seed, size=400):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in ("Tal", "re", "mi", "ço", "x", "漢") for b in ("", "a", "o-", "'s")]
    fixed = [" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 12))) for _ in range(12)]
    rows = []
    for i in range(size):
        parts = [rnd.choice(fixed) if rnd.random() < 0.5 else " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(0, 6))]
        text = "".join(p + rnd.choice([". ", ", ", "  ", "\t", "\n", " \r\n", "!?", " "]) for p in parts)
        rows.append((None if i % 50 == 0 else i, text if i % 37 else None, rnd.choice(["en", "en", "fr", None, "und", ""]), "s", len(text)))
    return rows + rows[:60]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS n", "'x' AS phrase", "2 AS chunk", "true AS last").repartition(5)


@pytest.mark.parametrize("trigger,min_count,top", [(16, 30, 2000), (2, 8, 25), (1, 12, 2000), (10**9, 12, 7)])
def test_equals_plain_counts(spark, trigger, min_count, top):
    rows = corpus(trigger % 97)
    want = brute(rows, min_count, top)
    assert len(want) > 10
    got = collocation.collocations(frame(spark, rows), min_count, top, trigger=trigger).collect()
    assert sorted(map(tuple, got)) == want


def test_awkward_documents(spark, docs, rows):
    got = collocation.collocations(docs, 5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 2000)


def test_slices_of_one_batch(spark, monkeypatch):
    """A batch is worked on in slices; each must give its own texts."""
    rows = corpus(11, 300)
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] or "" for r in rows])], names=["lang", "text"])

    def counted():
        c = collections.Counter()
        for part in collocation._parse_all(4)([batch]):
            for r in part.to_pylist():
                c[r["lang"], r["last"], r["chunk"]] += r["n"]
        return c

    whole = counted()
    monkeypatch.setattr(collocation, "SLICE", 700)
    assert counted() == whole


def test_empty_and_wordless(spark, no_docs):
    out = collocation.collocations(no_docs)
    assert out.collect() == [] and out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocation.collocations(frame(spark, [(1, " . ,\t\n", "en", "s", 5), (2, "", None, "s", 0), (3, None, None, None, None)])).collect() == []


def test_crowded_filter_changes_nothing(spark):
    rows = corpus(5)
    chunks = collocation.dictionary(frame(spark, rows))
    old = collocation.FILTER_BITS
    counts = {tuple(r) for r in collocation.frequent(chunks, 10)[0].collect()}
    big = collocation.bloom
    try:
        collocation.bloom = lambda p, n, bits=old: spark.sparkContext.broadcast(b"\xff" * 8192)
        assert {tuple(r) for r in collocation.frequent(chunks, 10)[0].collect()} == counts
    finally:
        collocation.bloom = big


def test_equal_passages_share_chunks():
    words = [f"w{i * 7919 % 1000}" for i in range(200)]
    texts = pa.array([" ".join(words), "other start " + " ".join(words), " ".join(words)], pa.string())
    t = collocation.parse(texts, pa.array(["en"] * 3)).to_pylist()
    once, all_three = [r for r in t if r["n_sum"] == 1], [r for r in t if r["n_sum"] == 3]
    assert len(all_three) >= 5 and len(once) <= 2
    # every start but those of the overlap counts once
    starts = sum(r["n_sum"] * (len(r["chunk"].split(" ")) - (0 if r["last"] else 3)) for r in t)
    assert starts == 602
