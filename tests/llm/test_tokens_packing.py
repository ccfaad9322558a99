"""Token counts and packing against the library and exact invariants."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from usagelens.llm.packing import BestFit, pack
from usagelens.llm.token_counts import token_counts
from usagelens.llm.tokens import IdCache

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", "Hello, world!", "it's 2nd² É\x85é\xa0x", "a<|endoftext|>b", "\x1cx\x1dy",
         "漢字 kana ｶ", "word " * 5000, "<|ENDOFTEXT|> ...%%% a.b", "Hello, world!"]
SCHEMA = "doc_id long, text string, score double, n_tokens string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 0.5, "x") for i, t in enumerate(texts)], SCHEMA)


def test_ids_equal_the_library(library):
    cache = IdCache(PATH, limit=50)
    rng = np.random.default_rng(3)
    letters = list("abst'. ,%²½É\x85\xa0\x1c1 \nİ漢<|")
    texts = ["".join(rng.choice(letters, 25)) for _ in range(3000)] + [t or "" for t in TEXTS]
    for t in texts:
        assert np.frombuffer(cache.ids(t), "<u2").tolist() == library.encode(
            t, add_special_tokens=False).ids


def test_ids_equal_the_library_over_all_planes(library):
    cache = IdCache(PATH, limit=50)
    rng = np.random.default_rng(7)
    ranges = [(32, 127), (0x80, 0x250), (0x300, 0x370), (0x370, 0x590), (0x600, 0x700), (0x900, 0xE00),
              (0x1100, 0x1200), (0x1E00, 0x2100), (0x3000, 0x3100), (0x4E00, 0x5000), (0xAC00, 0xAD00),
              (0xFB00, 0xFE00), (0x1D400, 0x1D500), (0x1F300, 0x1F700), (0x20000, 0x20100)]
    marks = ["’", "“", "—", "ΣΑΣ", "İı", "ﬁ", "e\u0301", "\u0308", " \u0301", "<|endoftext|>", "<|x", "\u2003", "\u200d",
             "\x1c", "\x85", "\xa0", " ", "\n", "'s", "3½", "가", "\u1100\u1161"]
    for _ in range(4000):
        lo, hi = ranges[rng.integers(len(ranges))]
        chars = [chr(c) for c in rng.integers(lo, hi, 8)] + list(rng.choice(marks, 6)) + ["a", "Q", " ", "z"]
        t = "".join(rng.permutation(chars))
        assert np.frombuffer(cache.ids(t), "<u2").tolist() == library.encode(
            t, add_special_tokens=False).ids, ascii(t)


def test_only_unproven_pieces_go_to_the_library(monkeypatch):
    cache, asked = IdCache(PATH), []
    whole = cache.whole
    monkeypatch.setattr(cache, "whole", lambda piece: asked.append(piece) or whole(piece))
    plain_words = "Plain words with CAPS, numbers 12.5 and été stand here "
    for odd in ("don’t", "“quoted”", "1990–1999", "漢字", "<|endoftext|>x", "a<|b"):
        asked.clear()
        cache.clear()
        cache.ids(plain_words * 50 + odd + " " + plain_words * 50 + odd)
        assert asked == [odd]
    asked.clear()
    cache.ids("漢" * 400 + " " + "漢" * 400)
    assert len(asked) == 2 and not any(len(k) > 256 for k in cache)


def test_repeated_and_long_rows(spark, library):
    long_text = "naïve — word’s end. " * 60_000
    texts = [long_text, "same", "same", "x" * 300_000]
    got = {}
    for r in token_counts(frame(spark, texts).union(frame(spark, texts[:2])), PATH, 2048).collect():
        got.setdefault(r.doc_id, []).append(r.n_tokens)
    assert got[0] == [len(library.encode(long_text, add_special_tokens=False).ids)] * 2 and len(got[1]) == 2
    rows = pack(frame(spark, texts).union(frame(spark, texts[:2])), PATH, 2048).collect()
    assert sum(r.length for r in rows if r.doc_id == 0) == 2 * (got[0][0] + 1)


def test_token_counts(spark, library):
    rows = token_counts(frame(spark, TEXTS), PATH, 2048).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        t = TEXTS[r.doc_id] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 2048)
    assert token_counts(frame(spark, []), PATH).collect() == []


def check_packing(rows, texts, library, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for d, t in enumerate(texts):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(by_doc[d], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(-(-len(ids) // capacity)))
        for p in pieces:
            assert p.start == p.piece * capacity
            assert p.length == min(capacity, len(ids) - p.start)
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    for members in by_seq.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_seq


def test_pack_round_trip(spark, library, sf_dir):
    check_packing(pack(frame(spark, TEXTS), PATH, 16, open_bins=4).collect(), TEXTS, library, 16)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    by_seq = check_packing(pack(docs, PATH, 2048).collect(), texts, library, 2048)
    used = sum(r.length for m in by_seq.values() for r in m)
    assert used / (2048 * len(by_seq)) > 0.9
    assert pack(frame(spark, []), PATH).collect() == []


def test_best_fit_rules():
    fit = BestFit(10, 2)
    assert fit.place(6) == (0, 0)          # bin 0: 4 free
    assert fit.place(7) == (1, 0)          # bin 1: 3 free
    assert fit.place(3) == (1, 7)          # fullest bin that holds it; bin 1 is full
    assert fit.place(5) == (2, 0)          # bin 2: 5 free
    assert fit.place(6) == (3, 0)          # none holds it: fullest (bin 0) closes
    assert fit.open_ids() == {2, 3}
