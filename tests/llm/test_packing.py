"""Operator 2: the plan on random histograms, and pieces against the tokenizer."""

import collections
import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bourse.llm import packing


def test_best_fill_is_the_largest_sum():
    rnd = random.Random(1)
    for _ in range(200):
        counts = {rnd.randint(1, 20): rnd.randint(1, 3) for _ in range(4)}
        room = rnd.randint(1, 40)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
        used = packing.best_fill(counts, room)
        assert sum(k * v for k, v in used.items()) == max(sums)
        assert all(v <= counts[k] for k, v in used.items())


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_every_id_once(seed):
    rnd = random.Random(seed)
    cap = rnd.choice([16, 64, 1024])
    counts = {rnd.randint(1, cap - 1): rnd.choice([1, 2, 3, 10, 500]) for _ in range(rnd.choice([1, 2, 5, 40]))}
    plan = packing.Plan(counts, cap)
    windows = collections.defaultdict(list)
    for length, n in counts.items():
        for rank in range(n):
            at = 0
            for start, take, window, offset in plan.find(length, rank):
                assert start == at
                at += take
                windows[window].append((offset, take))
            assert at == length
    assert sorted(windows) == list(range(plan.windows))
    for parts in windows.values():
        at = 0
        for offset, take in sorted(parts):
            assert offset == at
            at += take
        assert at == cap or at & (at - 1) == 0  # full, or a power of two: no padding


def test_pieces_equal_the_tokenizer(docs, rows):
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = {d: tok.encode(t or "", add_special_tokens=False).ids + [0] for d, t, *_ in rows}
    pieces = packing.pack(docs, capacity=128)
    per, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces.collect():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *part))
        per[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length, part))
    for d, want in ids.items():
        at = 0
        for start, length in sorted(per[d]):
            assert start == at
            at += length
        assert at == len(want)
    got = {r.sequence_id: (r.length, r.ids) for r in packing.sequences(docs, pieces, capacity=128).collect()}
    assert set(got) == set(windows)
    for s, parts in windows.items():
        flat = [x for _, _, p in sorted(parts) for x in p]
        length, full = got[s]
        assert length == len(flat) <= 128 and full[:length] == flat and not any(full[length:])
        assert len(full) == (length if length & (length - 1) == 0 else 128)


def test_odd_texts_encode_as_a_whole():
    def want(t):
        return tok.encode(t, add_special_tokens=False).ids

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    enc = packing._encoder(packing.TOKENIZER, packing.RANKS)
    for t in ["", " ", "  ", "a  b", "a \n b", "\n a", "x\n  y", "it's we'll", "漢字 かな", "a  b", "end ", "end  ", "a <|endoftext|> b",
              "tab\t x", "\x1c y", "1 22 333", "é è", " lead"]:
        assert enc.ids(t) == struct.pack(f"<{len(want(t))}I", *want(t)), repr(t)


def test_empty_and_repeated(spark, no_docs):
    assert packing.pack(no_docs).collect() == []
    twice = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None)], "doc_id long, text string")
    got = packing.pack(twice).collect()
    assert sum(r.length for r in got) == 4 + 4 + 1
