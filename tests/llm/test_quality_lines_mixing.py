"""Operators 9, 6 and 1 against brute force."""

import collections
import math
import random

import pytest

from bourse.llm import line_dedup, mixing, quality

SPACE = " \t\n\x0b\x0c\r"


def base_counts(text):
    words = (text or "").encode().split()
    n = len(words)
    grams = [tuple(words[i:i + 5]) for i in range(n - 4)]
    seen, covered = collections.Counter(grams), [False] * n
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered[i:i + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    return (n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), sum(covered))


def test_base_rule_equals_brute_force(spark, docs, rows):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(docs, labels, stratum="lang").collect()}
    assert len(got) == len(rows)
    for d, t, *_ in rows:
        want = base_counts(t)
        r = got[d]
        assert tuple(r[1:6]) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed)  # too few labels to certify anything
    left = quality.keep_good(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got.values())


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 20, 0.05), (7, 7, 0.5), (12, 400, 0.02)])
def test_binomial_tail(k, n, p):
    want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
    assert quality.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)


def test_rules_reject_the_bad_and_respect_the_bound(spark):
    """Held-out documents: junk is found, few good ones are lost."""
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(6000):
        good = i % 4 != 0
        text = " ".join(rnd.choice(words) + ("" if good else "###") for _ in range(30))
        if i % 500 == 0:  # good documents with symbols, within the allowed risk
            text = text.replace(" ", " ## ")
        rows.append((i, text, "en"))
        if i < 4000:
            labels.append((i, int(good or i % 500 == 0), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.kept for r in quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held_out = range(4000, 6000)
    bad = [i for i in held_out if i % 4 == 0 and i % 500]
    good = [i for i in held_out if i % 4]
    assert sum(not got[i] for i in bad) >= 0.95 * len(bad)
    assert sum(not got[i] for i in good) <= quality.ALPHA * len(good)


def test_quality_of_nothing(spark, no_docs, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(no_docs, labels).collect() == []
    assert quality.judge(docs, labels).count() == docs.count()


def lines_brute(rows, ratio, least):
    hosts, pages = collections.Counter(), collections.Counter()
    for _, t, _, h, _ in rows:
        hosts[h] += 1
        for x in {x for x in (t or "").split("\n") if x.strip(SPACE)}:
            pages[h, x] += 1
    out = {}
    for d, t, _, h, _ in rows:
        gone = [x.strip(SPACE) != "" and pages[h, x] >= least and pages[h, x] > ratio * hosts[h] for x in (t or "").split("\n")]
        out[d] = (None if t is None else "\n".join(x for x, g in zip(t.split("\n"), gone) if not g), sum(gone))
    return out


def test_lines_equal_brute_force(docs, rows):
    out = line_dedup.drop_boilerplate(docs, host="source", ratio=0.1, min_pages=3, count_as="__n")
    got = {r["doc_id"]: (r["text"], r["__n"]) for r in out.collect()}
    want = lines_brute(rows, 0.1, 3)
    assert got == want and any(n for _, n in want.values())
    assert line_dedup.drop_boilerplate(docs).columns == docs.columns


def test_lines_of_nothing(no_docs):
    assert line_dedup.drop_boilerplate(no_docs).collect() == []


def test_copies_are_no_boilerplate(spark):
    """A copy group and a near-copy group above the ratio keep their text
    through line dedup and near-dedup; a line of distinct pages still goes."""
    import corpus_pipeline

    rnd = random.Random(5)
    body = lambda: "\n".join(" ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(25)) for _ in range(4))
    texts = [body() + ("\nread more of this" if i < 40 else "") for i in range(300)]
    copied, near = body(), body()
    texts += [copied] * 30
    for i in range(30):  # another word is changed in each
        w = near.split(" ")
        w[3 * i + 1] = f"changed{i}"
        texts.append(" ".join(w))
    rows = [(i, t, "s", len(t)) for i, t in enumerate(texts)] + [(None, copied, "s", len(copied))] * 9 + [(990 + i, None, "s", None) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    lines = corpus_pipeline.line_dedup_by_source(spark, docs, "")
    got = collections.defaultdict(list)
    for r in lines.collect():
        got[r.doc_id].append(r.text)
    for i, t in enumerate(texts):
        assert got[i] == [t.removesuffix("\nread more of this")]
    assert got[None] == [copied] * 9 and got[990] == [None]
    left = {r.doc_id: r.text for r in corpus_pipeline.near_dedup(spark, lines, "").where("doc_id < 990").collect()}
    assert set(left) == set(range(300)) | {300, 330}
    assert left[300] == copied and left[330] == texts[330]


def test_mixing_meets_targets(spark, docs):
    targets = {
        "source": spark.createDataFrame([("a", 0.5), ("b", 0.3), ("\0", 0.2), ("absent", 9.0)], "value string, share double").where("value <> 'absent'"),
        "lang": 0.5, "topic": 1.0}
    out = mixing.weigh(docs, targets, budget=0.2, sweeps=40).cache()
    assert out.count() == docs.count()
    total = out.selectExpr("sum(__tokens * __weight)").first()[0]
    share = {r[0]: r[1] / total for r in out.groupBy("__source").agg({"__tokens": "sum"}).join(
        out.selectExpr("__source", "__tokens * __weight AS w").groupBy("__source").sum("w"), "__source").selectExpr("__source", "`sum(w)`").collect()}
    assert share["a"] == pytest.approx(0.5, abs=0.01) and share["b"] == pytest.approx(0.3, abs=0.01)
    expected = out.selectExpr("sum(__tokens * __p)").first()[0]
    tokens = out.selectExpr("sum(__tokens)").first()[0]
    assert expected == pytest.approx(0.2 * tokens, rel=1e-6)
    again = mixing.sample(docs.repartition(3), targets=targets, budget=0.2, sweeps=40)
    assert again.columns == docs.columns
    assert sorted(r.doc_id for r in again.select("doc_id").collect()) == sorted(r.doc_id for r in out.where("__kept").select("doc_id").collect())


def test_full_budget_keeps_all_tokens_and_nothing_from_nothing(docs, no_docs):
    out = mixing.weigh(docs, budget=1.0)
    assert out.where("__tokens > 0 AND NOT __kept").count() == 0
    assert mixing.weigh(no_docs).collect() == []
