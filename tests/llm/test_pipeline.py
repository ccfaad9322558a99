"""The pipeline's stages against brute force, each on what the stage before it kept."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_jaccard_join import brute as jaccard_brute
from test_native import shingles as item_shingles
from tokenizers import Tokenizer

import corpus_pipeline as P
from usagelens.llm import suffix_dedup as S
from usagelens.llm.common import DOCUMENT_COLUMNS


def cut_text(texts):
    """Texts without repeated 100-byte strings, and whether nothing is left of them."""
    seen, out = set(), []
    for t in texts:
        raw, gone = t.encode(), bytearray(len(t.encode()))
        for i in range(len(raw) - S.WINDOW + 1):
            if raw[i:i + S.WINDOW] in seen:
                gone[i:i + S.WINDOW] = b"\x01" * S.WINDOW
            seen.add(raw[i:i + S.WINDOW])
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((left.decode("utf-8", "ignore"), bool(raw) and not left))
    return out


def test_stages_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame(
        [(10_000, None, "en", "x", 0), (10_001, "123 ...", "en", "x", 7), (10_002, "", None, "x", 0)],
        docs.schema)
    docs = docs.unionByName(extra)
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in P.STAGES[:-1]:
        before = sorted(docs.collect(), key=lambda r: r.doc_id)
        docs = P.materialize(stage(spark, docs, sf_dir), "test-" + name.replace(" ", "-"))
        assert docs.columns == DOCUMENT_COLUMNS
        after = {r.doc_id: r for r in docs.collect()}
        if name == "language ID":
            want = {r.doc_id: r.text for r in before if r.text and any(c.isalpha() for c in r.text)}
        elif name == "n-gram Jaccard join":
            classes, edges = jaccard_brute([r.text for r in before])
            want = {r.doc_id: r.text for i, r in enumerate(before) if classes[i][1] == i}
            assert len(want) < len(before)
        elif name == "suffix-array dedup":
            want = {r.doc_id: t for r, (t, empty) in
                    zip(before, cut_text([r.text for r in before]), strict=True) if not empty}
            assert any(want.get(r.doc_id) != r.text for r in before)
        else:
            def leaks(text):
                own = item_shingles(text)
                return any(100 * len(s & own) >= 80 * len(s) for s in map(item_shingles, items) if s)
            want = {r.doc_id: r.text for r in before if not leaks(r.text)}
            assert len(want) < len(before)
        assert {d: r.text for d, r in after.items()} == want, name
        assert all(r.n_chars == len(r.text) for r in after.values()) or name != "suffix-array dedup"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    fill = defaultdict(int)
    pieces = P.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in pieces} == set(texts)
    for r in pieces:
        ids = np.array(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [0], "<u4")
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= P.SEQUENCE_TOKENS


def test_run_keeps_the_order_of_stages(spark, sf_dir):
    assert [n for n, _ in P.STAGES] == ["language ID", "n-gram Jaccard join", "suffix-array dedup",
                                        "benchmark decontamination", "best-fit packing"]
    assert P.ORACLE_SQL is None
    got = P.run(spark, sf_dir)
    assert got.columns[:2] == ["doc_id", "piece"] and got.count() > 0


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES])
def test_empty_table(spark, sf_dir, stage):
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    assert stage(spark, empty, sf_dir).collect() == []
