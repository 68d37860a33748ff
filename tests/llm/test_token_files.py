"""Operator 11: the coder, the encoder and the round trip."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from bourse.llm import ans, token_files

MARKS = ["it's (the end). \"Quoted,\" said 'he'.S we'll!ve I'd", "a.b,c;d:e!f?g 3.14 1,000.5 x.'s 'S.T ...'t",
         "é.à ç,x ß! Ünḯcödé á.b .́a İstanbul ΑΣ. ΑΣ x", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>.x <| |>",
         "nb sp em sp line\x1cfs\x85nel.a", "😀.😀 漢字,漢字 a漢.b ²x½.y ①.1", "", " \t\n", ".", "a", "...a", "a...", "A.B C"]


@pytest.fixture(scope="module")
def own():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))


def brute(rows, own):
    """By ascending doc_id; rows that share one in any order."""
    return [(d, own.encode(t or "", add_special_tokens=False).ids + [1]) for d, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


def test_encoder_equals_the_tokenizer(own):
    rnd = random.Random(1)
    alphabet = ["a", "B", "s", "'", ".", ",", "!", "9", " ", "\n", "é", "é", "-", "<|", "(", "\"", "漢", " ", "'s", "İ", "…", "H", "\u0331", "É", "×", "Þ"]
    texts = MARKS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    ids, off = token_files.Encoder(token_files.TOKENIZER).many(pa.array(texts), 1)
    for t, a, b in zip(texts, off, off[1:]):
        assert ids[a:b].tolist() == own.encode(t, add_special_tokens=False).ids + [1], t


@pytest.mark.parametrize("n,k,lanes,every", [(1, 1, 4, 2), (7, 3, 4, 2), (1000, 50, 16, 4), (513, 1, 256, 1), (70000, 40000, 256, 256), (8 * 16, 9, 16, 4)])
def test_coder_round_trip_and_checkpoints(n, k, lanes, every):
    ids = np.minimum((np.random.default_rng(n).pareto(0.7, n) * 2).astype(np.int64), k - 1)
    table = ans.scaled(dict(zip(*(a.tolist() for a in np.unique(ids, return_counts=True)))))
    assert table.freq.sum() == 1 << ans.BITS and table.freq.min() >= 1
    coder = ans.Coder(ans.Table.from_bytes(table.to_bytes()), lanes, every)
    raw = coder.encode(ids)
    assert (coder.decode(raw) == ids).all()
    step = lanes * every
    for a in range(-(-n // step)):
        assert (coder.decode(raw, a, a + 1) == ids[a * step:(a + 1) * step]).all()
    if n >= 70000:  # close to the entropy, besides checkpoints
        p = np.unique(ids, return_counts=True)[1] / n
        assert len(raw) < 1.01 * -(p * np.log2(p)).sum() * n / 8 + 2 * (8 * lanes + 4) + 64


def test_skewed_and_crowded_tables():
    table = ans.scaled({i: 1 for i in range(1000)} | {7: 10**15})
    assert table.freq.sum() == 1 << ans.BITS and table.freq[table.ids == 7] == (1 << ans.BITS) - 999
    assert ans.scaled({3: 5}).freq.tolist() == [1 << ans.BITS]
    assert ans.scaled({}).freq.tolist() == []
    with pytest.raises(ValueError):
        ans.scaled({i: 1 for i in range(5)}, bits=2)


def test_damage_is_found():
    coder = ans.Coder(ans.scaled({0: 3, 1: 5}), 4, 2)
    raw = bytearray(coder.encode(np.array([0, 1, 1, 0, 1, 1, 1, 0, 1])))
    for i in range(0, len(raw), 3):
        bad = raw.copy()
        bad[i] ^= 4
        with pytest.raises(ans.CorruptFile):
            coder.decode(bytes(bad))
    with pytest.raises(ans.CorruptFile):
        coder.decode(bytes(raw[:-1]))


@pytest.fixture(scope="module")
def odd_rows(rows):
    rnd = random.Random(5)
    out = list(rows) + [(100 + i, t, "en", "s", 0) for i, t in enumerate(MARKS)]
    out += [(None, "no id", None, None, 5), (None, "nor here", None, None, 5), (7, "same id, other text", None, None, 1), (2**60 + 1, "large id", None, None, 1),
            (-5, "negative", None, None, 1)] + [(500, "the same row", "en", "s", 1)] * 30
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("file_ids,part_ids", [(token_files.FILE, token_files.PART), (3000, 9000)])
def test_files_hold_all_documents_in_order(spark, odd_rows, own, file_ids, part_ids):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS ids", "'x' AS n").repartition(6)
    manifest = token_files.write_files(docs, file_ids=file_ids, part_ids=part_ids)
    got = sorted(token_files.read_files(manifest, with_ids=True).collect(), key=lambda r: r.start)
    want = brute(odd_rows, own)
    assert [r.doc_id for r in got] == [d for d, _ in want]
    at, stream = 0, []
    by_id = {}
    for d, ids in want:
        by_id.setdefault(d, []).append(tuple(ids))
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        by_id[r.doc_id].remove(tuple(ids.tolist()))
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(r.ids))
        at += len(ids)
        stream += ids.tolist()
    assert not any(by_id.values())
    if file_ids == 3000:
        assert manifest.count() > 3
    for a, n in ((0, 5), (at // 2, 4000), (at - 3, 100), (at, 5), (2900, 200)):
        assert token_files.read_span(spark, manifest, a, n).tolist() == stream[a:a + n]


def test_cut_off_file_is_refused(spark, docs, tmp_path):
    manifest = token_files.write_files(docs, str(tmp_path)).collect()
    raw = open(manifest[0].path, "rb").read()
    with open(manifest[0].path, "wb") as f:
        f.write(raw[:-10])
    with pytest.raises(ans.CorruptFile):
        token_files.Reader(manifest[0].path, token_files._table_of(manifest[0].table))


def test_empty_table(spark, no_docs):
    out = token_files.round_trip(no_docs)
    assert out.collect() == [] and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
