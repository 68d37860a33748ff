"""The pipeline against plain Python, stage by stage on each stage's input."""

import collections
import hashlib
import random

import pytest

import corpus_pipeline
from bourse.llm import line_dedup, mixing, packing
from tests.llm.conftest import SCHEMA, small_documents
from tests.llm.test_duplicates import near_brute
from tests.llm.test_quality_lines_mixing import SPACE, base_counts


def fixture_rows():
    """The awkward documents, copy groups above the line ratio, a hot source,
    a boilerplate line on distinct pages, rows without id or text."""
    rnd = random.Random(12)
    body = lambda k=4: "\n".join(" ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(25)) for _ in range(k))
    rows = list(small_documents())
    texts = [body() + ("\nsubscribe to this page" if i % 3 else "") for i in range(150)] + [body(1)] * 12
    copied, near = body(), body()
    texts += [copied] * 30 + [f"{copied}\nsubscribe to this page"] * 3
    for i in range(40):
        w = near.split(" ")
        w[2 * i + 1] = f"changed{i}"
        texts.append(" ".join(w))
    rows += [(100 + i, t, ["en", "fr"][i % 2], "hot" if i % 5 else "cold", len(t)) for i, t in enumerate(texts)]
    return rows + [(None, copied, "en", "hot", len(copied))] * 6 + [(900 + i, None, "en", "hot", None) for i in range(4)]


def by_content(rows, ratio=line_dedup.RATIO, least=line_dedup.MIN_PAGES):
    """The boilerplate lines of each source, counted by contents."""
    pages = collections.defaultdict(list)
    for d, t, _, h, _ in rows:
        pages[h].append((("id", d) if d is not None else ("text", t), {x for x in (t or "").split("\n") if x.strip(SPACE)}))
    out = set()
    for h, found in pages.items():
        n = collections.Counter(x for _, lines in found for x in lines)
        # rows count here: an id of its own per row with an id, one per text without
        often = {x for x, k in n.items() if k >= least and k > ratio * len(found)}
        names = {}
        for key, lines in found:
            common = lines & often
            copy = common and 2 * sum(map(len, common)) >= sum(map(len, lines))
            names[key] = min(hashlib.md5(x.encode()).digest() for x in common) if copy else key
        total = len({names[k] for k, lines in found if lines}) + any(not lines for _, lines in found)
        for x in often:
            k = len({names[key] for key, lines in found if x in lines})
            if k >= least and k > ratio * total:
                out.add((h, x))
    return out


def without_lines(rows):
    gone = by_content(rows)
    out = []
    for d, t, lang, h, n in rows:
        kept = None if t is None else [x for x in t.split("\n") if not (x.strip(SPACE) and (h, x) in gone)]
        if d is None or t is None or len(kept) == len(t.split("\n")):
            out.append((d, t, lang, h, n))
        else:
            text = "\n".join(kept)
            out.append((d, text, lang, h, len(text)))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(fixture_rows(), SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def collected(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_stages_equal_plain_python(spark, folder, monkeypatch):
    """run() with every stage's input and result kept."""
    kept = []
    stages = [(name, lambda s, d, f, stage=stage: kept.append((d, stage(s, d, f))) or kept[-1][1]) for name, stage in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    pieces = corpus_pipeline.run(spark, folder)
    docs = fixture_rows()
    ins, outs = [collected(d) for d, _ in kept], [collected(o) for _, o in kept[:-1]]
    assert key(ins[0]) == key(docs)
    for before, (_, after) in zip(outs, [(i, x) for i, x in enumerate(ins)][1:]):
        assert key(before) == key(after)  # each stage works on what the last one kept
    # quality: too few labels to certify a rule, so the base rule alone rejects
    good = [r for r in docs if not ((c := base_counts(r[1]))[0] < 10 or 100 * c[4] > 20 * c[0])]
    assert key(outs[0]) == key(good) and len(good) < len(docs)
    # lines
    want = without_lines(good)
    assert key(outs[1]) == key(want) and want != good
    assert all(r[1] for r in outs[1]), "a document lost its whole text"
    # near-duplicates: the smallest of each component, and rows without an id
    parent = near_brute([r for r in want if r[0] is not None])
    assert key(outs[2]) == key([r for r in want if r[0] is None or parent[r[0]][2]])
    # mixing: the SQL form of the operator on this stage's input
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(outs[2], columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"}))
    chosen = {r[0] for r in con.sql(f"SELECT doc_id FROM ({mixing.oracle_sql()}) WHERE kept").fetchall()}
    assert {r[0] for r in outs[3]} == chosen and 0 < len(chosen) < len(outs[2])
    # packing: every id of what is left, once
    enc = packing._encoder(packing.TOKENIZER, packing.RANKS)
    need = collections.Counter((d, len(enc.raw(t or "")) // 4 + 1) for d, t, *_ in outs[3])
    spans, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces.collect():
        spans[r.doc_id, r.doc_tokens].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(spans) == set(need)
    for k, found in spans.items():
        covered = collections.Counter(i for a, n in found for i in range(a, a + n))
        assert covered == collections.Counter({i: need[k] for i in range(k[1])})
    for found in windows.values():
        at = 0
        for a, n in sorted(found):
            assert a == at
            at += n
        assert at <= packing.CAPACITY


def test_empty_tables(spark, tmp_path):
    for name, kinds in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
