"""Suffix-array dedup against a dictionary of all windows, and its oracle."""

import hashlib
import random

import numpy as np
import pytest

from tests_llm_helpers import compare_with_oracle
from usagelens.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, n_bytes string, score double"


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept sha) per text, in order."""
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - S.WINDOW + 1):
            w = raw[i:i + S.WINDOW]
            if w in seen:
                gone[i:i + S.WINDOW] = b"\x01" * S.WINDOW
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["alpha", "é", "beta", "漢字", "of", "the", "gamma-ray", "\n", "\0", "zzz"]
    base = [" ".join(rng.choices(words, k=rng.randint(0, 120))) for _ in range(n // 3)]
    shared = [" ".join(rng.choices(words, k=40)) for _ in range(3)]
    texts = []
    for _ in range(n):
        t = rng.choice(base)
        kind = rng.randrange(6)
        if kind == 0 and t:
            i = rng.randrange(len(t))
            t = t[:i] + rng.choice("xyé") + t[i + 1:]
        elif kind == 1:
            t = t[rng.randrange(len(t) + 1):] + rng.choice(shared) + " ".join(rng.choices(words, k=9))
        elif kind == 2:
            t = "".join(rng.choices(words, k=20)) + rng.choice(shared)
        elif kind == 3:
            t = (rng.choice(words) + " ") * rng.randint(1, 80)
        texts.append(t)
    return texts + [None, "", "a" * 99, "a" * 100, "a" * 300, "a" * 99, shared[0], shared[0]]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, ["x"] * len(ids), [1.0] * len(ids))), SCHEMA)


def check(spark, texts, monkeypatch=None):
    df = frame(spark, texts).drop("n_bytes").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in S.remove_repeats(df).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_anchor_entries_cover_every_window_once():
    texts = [t.encode() for t in corpus(1) if t and len(t.encode()) >= S.WINDOW]
    end = np.cumsum([len(t) for t in texts])
    begin = end - [len(t) for t in texts]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    owner, first, last, anchor, key, _ = S.anchors(buf, begin, end)
    for i in range(len(texts)):
        mine = owner == i
        covered = [s for a, b in zip(first[mine], last[mine]) for s in range(a, b + 1)]
        assert covered == list(range(begin[i], end[i] - S.WINDOW + 1))
    assert ((anchor >= last) & (anchor - first <= S.SPAN)).all()
    grams = S.gather(buf, anchor, S.GRAM)
    assert (S.hash_rows(grams) == key).all()


def long_texts(seed):
    rng = random.Random(seed)
    passage = "".join(rng.choices("abcdé 漢", k=500))
    return ["".join(rng.choices("abcdé 漢", k=3000)) + passage + "y" * 700 + passage,
            passage * 4, "z" * 2000, "".join(rng.choices("xyz", k=1500)) + passage]


def test_long_texts_in_pieces_have_the_entries_of_whole_texts(monkeypatch):
    texts = [t.encode() for t in long_texts(5)]
    whole = S.Entries(8)
    whole.add(np.arange(len(texts)), texts)
    want = sorted(zip(*(np.concatenate(x).tolist() for x in zip(*whole.parts, strict=True)),
                      strict=True))
    monkeypatch.setattr(S, "POSITION_BITS", 10)
    with pytest.raises(ValueError):
        S.Entries(8).add(np.arange(len(texts)), texts)
    for limit in (S.WINDOW + S.SPAN + 1, 400, 500):
        pieces = S.Entries(8)
        for _ in pieces.fill(list(enumerate(texts)), limit):
            pass
        got = zip(*(np.concatenate(x).tolist() for x in zip(*pieces.parts, strict=True)), strict=True)
        assert sorted(got) == want and pieces.size == len(want)


def test_long_texts_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "RUN_BYTES", 300)
    check(spark, long_texts(6) + corpus(7) + long_texts(6)[1:])


def test_stack_scan_lists_the_interval_tree():
    assert sorted(S.stack_scan([-1, 5, 5, 2, 7], 1)) == [(2, 0, 4), (5, 0, 2), (7, 3, 4)]
    assert list(S.stack_scan([-1], 0)) == []
    assert list(S.stack_scan([-1, 0, 0], 0)) == [(0, 0, 2)]
    assert list(S.stack_scan([-1, 3, 9, 3], 4)) == [(9, 1, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_by_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_hot_anchors_are_split(spark, monkeypatch):
    monkeypatch.setattr(S, "LOCAL_CONTEXTS", 2)
    monkeypatch.setattr(S, "GROUP_CONTEXTS", 3)
    rng = random.Random(9)
    passage = " ".join(rng.choices(["red", "green", "blue", "ultraviolet"], k=60))
    texts = [f"{rng.random()} {passage} {rng.random()}" for _ in range(40)] + corpus(4)
    check(spark, texts)


def test_repeated_and_null_ids(spark):
    a, b = "abc " * 40, "xyz" * 50
    df = frame(spark, [a, b, a, a, None], [5, None, 5, 3, 3]).drop("n_bytes")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed)
                 for r in S.remove_repeats(df).collect())
    n = brute([a])[0][1]
    assert got == [(-1, 150, brute([b])[0][1]), (3, 0, 0), (3, 160, n), (5, 160, 160), (5, 160, 160)]
    cut = {r.text for r in S.remove_repeats(df).collect()}
    assert "" in cut and all(len(t) < 160 for t in cut)
    assert S.remove_repeats(df.limit(0)).collect() == []


def test_columns_of_any_name_survive(spark):
    rows = [(1, "q" * 250, "r1", 1.5, [1], "x"), (2, "plain", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, `rest.c0` double, spans array<int>, n_spans string")
    got = S.remove_repeats(df)
    assert got.columns == ["doc_id", "text", "row", "rest.c0", "spans", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    first, second = sorted(got.collect(), key=lambda r: r.doc_id)
    assert (first.row, first["rest.c0"], first.spans, first.n_removed) == ("r1", 1.5, [1], brute([rows[0][1]])[0][1])
    assert (second.text, second.row, second.spans, second.n_spans) == ("plain", None, None, 0)
    bare = S.remove_repeats(df.select("text", "doc_id"))
    assert bare.columns[:2] == ["text", "doc_id"] and bare.count() == 2


def test_oracle(spark, sf_dir):
    compare_with_oracle(spark, sf_dir, "op7_suffix_dedup")
