"""Ranked search against plain scoring of all documents, its pruning, odd rows, the oracle."""

import math
import random
import re
from collections import Counter

import pytest

from tests_llm_helpers import compare_with_oracle
from usagelens.llm import ranked_search as S

DOCS = "doc_id long, text string, rank string, score double, row int, item int"
ITEMS = "item_id long, text string, doc_id string, place long"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top=10):
    said = [(d, Counter(terms(t))) for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    full = [sum(c.values()) for _, c in said]
    n_docs, n_terms = sum(n > 0 for n in full), sum(full)
    df = Counter(t for _, c in said for t in c)
    out = []
    for item, text in items:
        scored = []
        for at, (doc, c) in enumerate(said):
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 10 + 90 * full[at] * n_docs // n_terms
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, at, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(sorted(scored)[:top])]
    return Counter(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocab = ["the"] + [f"w{i}" for i in range(400)] + ["Été", "x\xa0y", "日本", "ß"]
    weights = [400] + [400 / (i + 1) for i in range(len(vocab) - 1)]
    docs = []
    for i in range(n):
        words = rng.choices(vocab, weights, k=rng.choice([0, 1, 5, 40, 40, 200]))
        docs.append((i, rng.choice([" ", "-", "\n", "_"]).join(rng.choice([w, w.upper()]) for w in words)))
    docs += [(n, None), (n + 1, "\0 .;"), (n + 2, docs[7][1]), (n + 3, docs[7][1]), (n + 4, "the " * 30_000)]
    items = [(i, " ".join(rng.choices(vocab, weights, k=rng.choice([1, 3, 30])))) for i in range(30)]
    items += [(30, None), (31, "  "), (32, "unknown words only"), (33, "the"), (34, docs[7][1]), (35, "日本 THE the")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "x", 0.5, 1, 2) for d in docs], DOCS).repartition(6),
            spark.createDataFrame([(*i, "y", 3) for i in items], ITEMS))


def found(spark, docs, items):
    got = S.ranked_search(*frames(spark, docs, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in got.collect())


def test_ranks_by_brute_force(spark):
    docs, items = corpus(1)
    want = brute(docs, items)
    assert found(spark, docs, items) == want and len(want) > 250


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)
    monkeypatch.setattr(S, "BLOCK_BYTES", 4000)
    docs, items = corpus(2)
    assert found(spark, docs, items) == brute(docs, items)


def test_repeated_and_null_ids(spark):
    docs = [(5, "a b"), (5, "a b"), (5, "a c"), (None, "a"), (2, "z")]
    items = [(1, "a b"), (None, "c"), (1, "z z")]
    assert found(spark, docs, items) == brute(docs, items)


def test_no_rows(spark):
    docs, items = frames(spark, [(1, "a b"), (2, "c")], [(1, "a")])
    assert S.ranked_search(docs.limit(0), items).collect() == []
    assert S.ranked_search(docs, items.limit(0)).collect() == []
    blank, _ = frames(spark, [(1, None), (2, "..")], [])[0], None
    assert S.ranked_search(blank, items).collect() == []


def test_dropped_accumulators_cannot_reach_the_result():
    """After every stage, what is left holds the exact result although most accumulators go."""
    rng = random.Random(5)
    n_docs, size = 3000, 12
    found = {t: (max(1, n_docs >> (size - t)), 700_000) for t in range(size)}
    routes = S.Routes([list(range(size))], found, n_docs)
    assert sum(len(a.get(0, ())) for a in routes.at) == sum(w > 0 for w in routes.weight.values())
    score = [0] * n_docs
    alive, floor = set(range(n_docs)), 1
    for stage in range(S.STAGES):
        for t in routes.at[stage].get(0, ()):
            for d in rng.sample(range(n_docs), found[t][0]):
                score[d] += routes.weight[t] * rng.randrange(600_000, 700_001)
        kth = sorted(score)[-S.TOP]
        floor = max(floor, kth)
        alive = {d for d in alive if score[d] + routes.rest[0][stage + 1] >= floor}
    best = sorted(range(n_docs), key=lambda d: (-score[d], d))[:S.TOP]
    assert set(best) <= alive and len(alive) < n_docs / 10


@pytest.mark.parametrize("length", [5, 10 ** 12])
def test_norms_beyond_64_bits(length):
    import numpy as np
    got = S.norms(np.array([length, 0]), 10 ** 9, 10 ** 13).tolist()
    assert got == [10 + 90 * length * 10 ** 9 // 10 ** 13, 10]


def test_oracle(spark, sf_dir):
    compare_with_oracle(spark, sf_dir, "op11_ranked_search")
