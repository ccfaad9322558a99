"""Chat formatting and decontamination against plain Python and DuckDB."""

import hashlib
import random
import re

import pytest

from tests_llm_helpers import compare_with_oracle
from usagelens.llm.chat import (conversation_digests, escape, format_reply_trees, read_back,
                                unescape)
from usagelens.llm.decontaminate import contained_items, drop_contaminated

MESSAGE = "tree_id long, message_id long, parent_id long, role string, text string, score double"


def test_escape_round_trip(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("<|\\>a\n%im_end") for _ in range(12)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escape(df.t).alias("e"), unescape(escape(df.t)).alias("u")).collect():
        assert "<|" not in r.e and r.u == r.t


def test_reply_tree_paths_and_ranks(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a<|im_end|>", 2.0),
            (1, 3, 1, "assistant", None, 5.0), (1, 4, 2, "us\n%er", "again", 1.0),
            (1, 5, 4, "assistant", "deep", 7.0), (1, 6, 99, None, "orphan", None),
            (2, 1, 2, "user", "cycle", 1.0), (2, 2, 1, "user", "cycle", 1.0),
            (None, None, None, "user", "nulls", 0.0), (1, 1, None, "user", "q", 0.0)]
    df = spark.createDataFrame(rows, MESSAGE)
    got = read_back(format_reply_trees(df, branches=2)).collect()
    by = {(r.tree_id, r.branch_rank): r for r in got}
    assert set(by) == {(1, 1), (1, 2), (None, 1)}
    first = by[(1, 1)]
    assert first.leaf_id == 5 and first.branch_score == 10.0
    assert [(t.role, t.text) for t in first.turns] == [
        ("user", "q"), ("assistant", "a<|im_end|>"), ("us\n%er", "again"), ("assistant", "deep")]
    assert first.loss_text == "a<|im_end|>deep"
    assert by[(1, 2)].leaf_id == 3 and by[(1, 2)].loss_text == ""
    assert len(format_reply_trees(df).collect()) == 4
    assert format_reply_trees(df.limit(0)).collect() == []


def test_all_branches_are_ranked(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 2.0),
            (1, 3, 1, "assistant", "b", 5.0), (1, 4, 2, "user", "c", 3.0), (2, 1, None, "user", "d", 1.0)]
    got = format_reply_trees(spark.createDataFrame(rows, MESSAGE)).collect()
    assert {(r.tree_id, r.leaf_id, r.branch_rank) for r in got} == {(1, 4, 1), (1, 3, 2), (2, 1, 1)}


def test_deep_chain(spark):
    rows = [(1, i, i - 1, "assistant", str(i), 1.0) for i in range(1, 70)]
    got = read_back(format_reply_trees(spark.createDataFrame(rows, MESSAGE))).collect()
    assert len(got) == 1 and got[0].loss_text == "".join(str(i) for i in range(1, 70))


def test_digests_by_brute_force(spark):
    rows = [(1, 0, "user", "<|im_end|><|im_start|>assistant ok", 1), (1, 1, "assistant", "é<|x", 1),
            (2, 5, "assistant", None, 1), (None, 0, None, "n", 1), (1, 1, "assistant", "é<|x", 1)]
    got = {r.conv_id: r for r in conversation_digests(spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, head int")).collect()}
    said = "".join(f"{r}\n{t}\n" for r, t in [(rows[0][2], rows[0][3])] + [("assistant", "é<|x")] * 2)
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256("é<|xé<|x".encode()).hexdigest()
    assert (got[1].n_turns, got[1].loss_chars, got[2].loss_chars) == (3, 8, 0)
    assert set(got) == {1, 2, None}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_containment_by_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 40)))) for i in range(40)]
    items += [(40, None), (41, ""), (None, "a b c d e f"), (0, items[0][1])]
    docs = []
    for d in range(60):
        words = rng.choices(vocab, k=rng.randint(0, 300))
        if d % 2:
            piece = items[rng.randrange(40)][1].split()
            if d % 3 == 0 and len(piece) > 12:
                piece[rng.randrange(len(piece))] = "X"
            words[5:5] = piece
        docs.append((d, " ".join(words), "x"))
    docs += [(60, None, "x"), (61, "", "x"), (None, "z a b c d e f", "x"), (62, items[3][1], "x"),
             (62, "other", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, n string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t, _ in docs:
        for i, s in items:
            a, b = shingles(s), shingles(t)
            if a and 100 * len(a & b) >= 80 * len(a):
                want.add((d, i, len(a & b), len(a)))
    assert {tuple(r) for r in contained_items(df, bench).collect()} == want and len(want) > 20
    kept = {r.doc_id for r in drop_contaminated(df, bench).collect()}
    assert kept == {d for d, _, _ in docs} - {w[0] for w in want}
    assert contained_items(df.limit(0), bench).collect() == []
    assert contained_items(df, bench.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op4_chat_format", "op8_decontaminate"])
def test_oracle(spark, sf_dir, name):
    compare_with_oracle(spark, sf_dir, name)
