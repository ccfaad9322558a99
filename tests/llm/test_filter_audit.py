"""Filter masks and their audit by brute force, the radix trie, heavy prefixes, the oracle."""

import random
import re
from collections import Counter
from itertools import permutations

from tests_llm_helpers import compare_with_oracle
from usagelens.llm import filter_audit as A

SCHEMA = "doc_id long, text string, source string, mask string, n double, slot int"
LABELS = "doc_id long, quality int, toxic int, part string"


def corpus(seed, head="", n=260):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "x\xa0y", "CAPS", "a#b", "日本"]
    pool = ["", None, " \n", "AB", "ABCé", "a", "x" * 40, "é"]
    for k in range(60):
        words = rng.choices(vocab[:rng.choice([5, 300, 305])], k=rng.choice([0, 3, 199, 200, 260]))
        pool.append(head + " ".join(words))
        pool.append(head + " ".join(words) + rng.choice(["", " ", "!", "\0"]))
    rows = [(i if rng.random() < 0.9 else rng.randrange(n), rng.choice(pool),
             rng.choice(["a", "b", "", None, "é"]), "x", 1.0, 2) for i in range(n)]
    rows += [(None, pool[8], "a", None, None, None)] * 3 + [rows[0]] * 5
    labels = [(i, rng.randrange(2), rng.randrange(2), "z") for i in range(0, n, 2)]
    return rows, labels + [(0, 1, None, "z"), (0, None, 1, "z"), (None, 1, 1, None)]


def brute_masks(rows):
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", r[0]), r[0])
    out = []
    for doc_id, text, source, *_ in rows:
        text = text or ""
        w = re.findall("[^\x20\x09-\x0D]+", text)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w),
                 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 bool(re.search(r"[#$%&*|]", text)), doc_id is not None and doc_id > least[text]]
        out.append((doc_id, source or "", "".join(f for f, x in zip("ABCDE", fails, strict=True) if x)))
    return out


def brute_audit(rows, labels):
    good = {d for d, q, _, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t, _ in labels if t == 1 and d is not None}
    masks = brute_masks(rows)
    out, shapley = {}, Counter()
    for part in {p for _, p, _ in masks}:
        for order in map("".join, permutations("ABCDE")):
            left, gone = [m for m in masks if m[1] == part], []
            for step, f in enumerate(order, 1):
                hit = [m for m in left if f in m[2]]
                redundant = sum(f in m[2] for m in gone)
                gone += hit
                left = [m for m in left if f not in m[2]]
                shapley[part, f] += len(hit)
                out[part, order, step] = [
                    len(left), len(hit), redundant, sum(m[1] == part and m[2] == f for m in masks),
                    sum(m[0] in good for m in hit), sum(m[0] in toxic for m in hit)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def check(spark, rows, labels):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = Counter()
    for r in A.filter_masks(docs).collect():
        letters = "".join(f for f in A.FILTERS if r["mask"] & A.BIT[f])
        got[r["doc_id"], r["part"], letters] += r["n"]
    assert got == Counter(brute_masks(rows))
    audit = A.filter_audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in audit} == brute_audit(rows, labels)
    assert len(audit) == 600 * len({r[2] or "" for r in rows})


def test_audit_by_brute_force(spark):
    check(spark, *corpus(1))


def test_heavy_prefixes_and_full_local_tries(spark, monkeypatch):
    monkeypatch.setattr(A, "SLOT_BYTES", 600)
    monkeypatch.setattr(A, "SLOTS_PER_TASK", 1000)
    monkeypatch.setattr(A, "LOCAL_BYTES", 3000)
    monkeypatch.setattr(A, "LEVELS", (4, 16, 64))
    rows, labels = corpus(2, head="one common passage at the head of all texts, longer than any prefix " * 2)
    texts = spark.createDataFrame(rows, SCHEMA).select("text")
    heavy, cuts = A.slot_plan(texts)
    assert {len(k) for k in heavy} == {1, 2, 3} and len(cuts) > 20 and cuts == sorted(set(cuts))
    check(spark, rows, labels)


def test_trie_holds_the_smallest_id_of_every_text():
    rng = random.Random(3)
    trie, least, nodes = A.RadixTrie(), {}, {}
    for _ in range(5000):
        text, key = bytes(rng.choices(b"ab\0", k=rng.randrange(9))), rng.randrange(1000)
        nodes[text] = trie.insert(text, key)
        least[text] = min(key, least.get(text, key))
    assert {t: n[2] for t, n in nodes.items()} == least

    def walk(node, before):
        yield from [(before + node[0], node[2])] if node[2] is not None else []
        for first, child in node[1].items():
            assert child[0][0] == first and (child[2] is not None or len(child[1]) > 1)
            yield from walk(child, before + node[0])
    assert dict(walk(trie.root, b"")) == least


def test_no_rows_and_a_long_text(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], LABELS)
    assert A.filter_audit(docs, labels).collect() == []
    long_text = "Word é " * 700_000
    rows = [(2, long_text, "a", "", 0.0, 0), (1, long_text, "a", "", 0.0, 0), (3, long_text + "x", "a", "", 0.0, 0)]
    got = {r.doc_id: r["mask"] for r in A.filter_masks(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: A.BIT["B"] | A.BIT["C"], 2: A.BIT["B"] | A.BIT["C"] | A.BIT["E"], 3: A.BIT["B"] | A.BIT["C"]}


def test_oracle(spark, sf_dir):
    compare_with_oracle(spark, sf_dir, "op13_filter_audit")
