"""License scans against all pairs of blocks and templates."""

import random
import re
import textwrap

import duckdb

from tests_llm_helpers import compare_with_oracle
from usagelens.llm import queries
from usagelens.llm import license_scan as S

SCHEMA = "doc_id long, text string, score string, labels long"
TEXTS = [None, "", "Released under the MIT License.", "Under THE mit\nlicense",
         "x\0Apache License, Version 2.0\nAPACHE license version 2 apache license version 2",
         "cc by nc by nc cc by nc", "cc-by-nc é under the mit licenseé",
         "this work is under GNU general public license, version 3", "Kelvin K cc by nC",
         "gnu gnu gnu general public", "unencumbered software released into the public domain free is"]


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    find = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    words, places, labels, score = find(lower), [], set(), 0.0
    for phrase, label in S.PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    more = set(labels)
    for label, body in S.TEMPLATES:
        t, n = set(body.split()), len(body.split())
        share = max((len(t & set(words[i:i + n])) / len(t) for i in range(len(words))), default=0)
        if 100 * round(share * len(t)) >= S.PERCENT * len(t):
            more.add(label)
            score = max(score, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)), ",".join(sorted(more)), 1.0 if places else score)


def test_scan_by_brute_force(spark):
    rng = random.Random(3)
    pool = [w for _, t in S.TEMPLATES for w in t.split()] + ["é", "\n", "THE", "x-y"]
    texts = list(TEXTS)
    for _ in range(150):
        t = rng.choice(S.TEMPLATES)[1].split()
        rng.shuffle(t)
        texts.append(" ".join(t[rng.randrange(len(t) // 3 + 1):] + rng.choices(pool, k=5)))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = S.license_scan(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:8] == brute(texts[r.doc_id]), texts[r.doc_id]
        assert {b.label for b in r.notices} <= set(r.labels.split(","))
    assert S.license_scan(df.limit(0)).collect() == []
    assert [r.labels for r in S.license_scan(df.limit(3), templates=()).collect()] == ["", "", "mit"]


def test_templates_wrapped_at_72_columns(spark):
    texts = []
    for _, body in S.TEMPLATES:
        lines = textwrap.wrap("some words before it " + body + " and after it", 72)
        texts.append("int x;\n" + "\n".join(" * " + x for x in lines) + "\nint y;")
    texts += ["the software is free of charge and is provided to the public\n" * 5, None]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in S.license_scan(df).collect()}
    for i, (label, body) in enumerate(S.TEMPLATES):
        assert (6, label, 1.0) in {tuple(b) for b in got[i].notices}
        assert label in got[i].labels.split(",") and got[i].score == 1.0
    assert got[len(texts) - 2].notices == got[len(texts) - 1].notices == []


def test_the_query_labels_wrapped_notices(spark, tmp_dir):
    """What op9 returns, as its SQL does, for notices wrapped over lines and in comments."""
    rows = [(i, "x = 1\n" + "\n".join("# " + x for x in textwrap.wrap(body, 40 + 8 * (i % 5))))
            for i, (_, body) in enumerate(S.TEMPLATES)]
    rows += [(99, None), (100, "the software is free of charge\n" * 9), (100, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.QUERIES["op9_license_scan"](spark, tmp_dir).collect()
    by = {r.doc_id: r for r in got}
    assert all(label in by[i].labels.split(",") for i, (label, _) in enumerate(S.TEMPLATES))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    result = con.execute(queries.ORACLE["op9_license_scan"])
    names = [d[0] for d in result.description]
    want = [tuple(dict(zip(names, row, strict=True))[c] for c in got[0].asDict()) for row in result.fetchall()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_repeated_and_long_rows(spark):
    long_text = "lorem ipsum " * 400_000 + "Released under\nthe MIT // License " + "dolor " * 1000
    rows = [(1, long_text, "x", 1), (1, long_text, "x", 1), (2, "the " * 300_000, "x", 1)]
    got = S.license_scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.labels for r in sorted(got, key=lambda r: r.doc_id)] == ["mit", "mit", ""]
    assert got[0].first_word == 800_001 or got[0].doc_id == 2


def brute_windows(words):
    """Labels of the templates that some window of their length holds."""
    out = set()
    for label, body in S.TEMPLATES:
        n, t = len(body.split()), set(body.encode().split())
        if any(100 * len(t & set(words[i:i + n])) >= S.PERCENT * len(t) for i in range(len(words))):
            out.add(label)
    return out


def test_notices_by_brute_force():
    rng = random.Random(4)
    pool = [w for _, t in S.TEMPLATES for w in t.split()] + ["other"] * 20
    vocabulary = sorted({w.encode() for w in pool})
    index = S.Templates(S.TEMPLATES, {w: rng.randrange(9) for w in vocabulary}, S.PERCENT)
    hits = 0
    for _ in range(400):
        t = rng.choice(S.TEMPLATES)[1].split()
        for _ in range(rng.randrange(4)):
            t.insert(rng.randrange(len(t)), rng.choice(pool))
        words = " ".join(rng.choices(pool, k=9) + t + rng.choices(pool, k=9)).encode().split()
        want = brute_windows(words)
        assert {b["label"] for b in index.notices(words)} == want
        hits += bool(want)
    assert 100 < hits


def test_oracle(spark, sf_dir):
    compare_with_oracle(spark, sf_dir, "op9_license_scan")
