"""Jaccard classes against all pairs, components against union-find, and the oracle."""

import random
import re

import numpy as np
import pytest

from tests_llm_helpers import compare_with_oracle
from usagelens.llm import jaccard_join as J
from usagelens.llm.components import components

SCHEMA = "doc_id long, text string, n string, token double"


def union_find(nodes, edges):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(texts):
    sets = [shingles(t) for t in texts]
    edges = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and
             100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    comp = union_find(range(len(texts)), edges)
    return {i: (len(s), comp[i]) for i, s in enumerate(sets)}, edges


def corpus(seed, groups=6, copies=14):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Été", "x\xa0y"]
    passage = rng.choices(vocab, k=60)
    texts = []
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.randint(30, 160))
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            sep = rng.choice([" ", "\n", " \t "])
            t = sep.join(w)
            texts.append(t.upper() if rng.random() < 0.1 else t)
    texts += [" ".join(passage + rng.choices(vocab, k=rng.randint(0, 40))) for _ in range(25)]
    texts += [None, "", " \n", "a", "A", "a b c", "a  b c", "a b c d", "a b c d e", "A b c d e", "é"]
    rng.shuffle(texts)
    return texts


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 0.0) for i, t in enumerate(texts)], SCHEMA)


def check(spark, texts):
    want, edges = brute(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in J.jaccard_classes(frame(spark, texts).repartition(3)).collect()}
    assert got == want and len(edges) > 50


def test_classes_by_brute_force(spark):
    check(spark, corpus(1))


def test_large_clusters_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_DOCS", 6)
    check(spark, corpus(2, groups=4, copies=30))


def test_copies_met_in_descending_order(spark, monkeypatch):
    monkeypatch.setattr(J, "RUN_BYTES", 1)
    texts = corpus(3)
    texts = texts[:60] + texts + texts[30:]
    want, edges = brute(texts)
    df = frame(spark, texts).coalesce(1).sortWithinPartitions("doc_id", ascending=False)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(df).collect()}
    assert got == want and len(edges) > 50


def test_prefixes_of_similar_sets_meet_under_every_order():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        pool = rng.integers(1, 1 << 62, 3 * n + 5).astype(np.uint64)
        cls = rng.integers(8, 40, len(pool)).astype(np.uint8)
        a = rng.choice(len(pool), n, replace=False)
        b = np.unique(np.concatenate((a[int(0.15 * n):], rng.choice(len(pool), n // 12 + 1))))
        if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        for k in range(J.ORDERS):
            sides = []
            for s in (a, b):
                o = np.lexsort((pool[s], cls[s]))
                sides.append(set(J.prefix(len(s), pool[s][o], cls[s][o], k).tolist()))
            assert sides[0] & sides[1]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_by_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]
    edges += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 540)]
    df = spark.createDataFrame(edges, "a long, b long")
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    got = {r.node: r.component for r in components(df).collect()}
    assert got == union_find(nodes, [e for e in edges if e[0] != e[1]])
    assert components(df.limit(0)).collect() == []


def test_repeated_null_and_no_ids(spark):
    t = "one two three four five six seven"
    df = spark.createDataFrame([(5, t), (5, t + " eight"), (None, t), (3, None), (5, "other")],
                               "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id or -1)
                 for r in J.jaccard_classes(df).collect())
    assert got == [(-1, 3, -1), (3, 0, 3), (5, 1, 5), (5, 3, -1), (5, 4, 5)]
    kept = J.keep_one_per_class(df)
    assert kept.columns == df.columns and kept.count() == 4
    assert J.jaccard_classes(df.limit(0)).collect() == []


def test_columns_of_any_name_survive(spark):
    t = "one two three four five six seven"
    df = spark.createDataFrame([(2, t, "b", 1, [2.0]), (1, t, "a", 0, None), (3, None, "c", None, None)],
                               "doc_id long, text string, row string, component int, rest array<double>")
    kept = J.keep_one_per_class(df)
    assert kept.dtypes == df.dtypes
    assert {tuple(r) for r in kept.collect()} == {(1, t, "a", 0, None), (3, "", "c", None, None)}


def test_packed_rows_do_not_follow_the_partitions(spark):
    """Four times the partitions, the same packed rows (and the same entries in them)."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("8", "32", "128"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            J.prepare(spark)
            found.append([(d.count(), d.selectExpr("sum(octet_length(row))").first()[0])
                          for d in J.packed_posts(J.numbered(docs))])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for (rows, entries), (first_rows, first_entries) in zip(sum(found, []), found[0] * 3, strict=True):
        assert abs(rows - first_rows) <= first_rows / 10 and entries == first_entries


def test_oracle(spark, sf_dir):
    compare_with_oracle(spark, sf_dir, "op6_jaccard_join")
