"""Language ID, quality classifier and quality rules against brute force and held-out rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from usagelens.llm import language_id as L
from usagelens.llm import quality_classifier as C
from usagelens.llm import quality_rules as Q
from usagelens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score double, held_out string"
ODD = [None, "", " \n\t", "123 !!", "é", "漢字かな", "x" * 5000, "a b " * 3000]


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- language ID ---

def phrases(text, reference):
    """Greedy longest-match phrase count by substring search."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in reference:
            size += 1
        n, at = n + 1, at + size
    return n


def test_cross_parsing_equals_substring_search():
    rng = random.Random(1)
    samples = (("aa", "the cat sat on the mat and the rat " * 3), ("bb", "der hund und die katze im haus"))
    m = L.Model(samples)
    texts = ["".join(rng.choice("the andrcoukizm zq") for _ in range(rng.randint(0, 2500)))
             for _ in range(40)] + [t or "" for t in ODD]
    cost, lengths = m.costs(texts)
    for i, t in enumerate(texts):
        letters = "".join(map(chr, L.normalised(t)))
        assert lengths[i] == len(letters)
        for k, (_, sample) in enumerate(samples):
            ref = "".join(map(chr, L.normalised(sample)))
            n = sum(phrases(letters[b:b + L.BLOCK], ref) for b in range(0, len(letters), L.BLOCK))
            assert cost[i, k] == pytest.approx(n * math.log2(len(ref)))


def script(rng, first, letters, n):
    """Words of a script of many letters, frequent ones first."""
    return "".join(" " if rng.random() < 0.1 else chr(first + int(letters ** rng.random()) - 1)
                   for _ in range(n))


def test_every_language_has_all_letters_of_its_reference(monkeypatch):
    rng = random.Random(5)
    samples = tuple((lang, script(rng, first, 1500, 6000)) for lang, first in
                    (("aa", 0x4E00), ("bb", 0x4E00 + 700), ("cc", 0xAC00)))
    texts = [script(rng, first, 1500, 200) for first in (0x4E00, 0x4E00 + 700, 0xAC00)] + [
        samples[1][1][3000:3100], "漢zzz漢字", "abc", samples[2][1][:50] + "qq" + samples[0][1][9:60]]
    for dense in (L.DENSE_LETTERS, 3):
        monkeypatch.setattr(L, "DENSE_LETTERS", dense)
        m = L.Model(samples)
        cost, _ = m.costs(texts)
        for i, t in enumerate(texts):
            text = "".join(map(chr, L.normalised(t)))
            for k, (_, sample) in enumerate(samples):
                ref = "".join(map(chr, L.normalised(sample)))
                assert cost[i, k] == pytest.approx(phrases(text, ref) * math.log2(len(ref)))


def test_reference_takes_evenly_from_all_texts():
    texts = [f"{chr(0x4E00 + i)} " + "some words " * 300 for i in range(48)] + ["short", ""]
    letters = set(L.normalised(L.even_reference(texts))[:L.REFERENCE_CHARS].tolist())
    assert {0x4E00 + i for i in range(48)} <= letters
    assert len(L.normalised(L.even_reference(texts))) > 0.99 * L.REFERENCE_CHARS
    assert L.even_reference(["a b!", "c"]) == "a b c"


def test_language_held_out_accuracy(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, sf_dir).collect()}
    truth = documents(spark, sf_dir).collect()
    assert len(rows) == len(truth)
    for d in truth:
        assert rows[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1)
    out = [d for d in truth if rows[d.doc_id].held_out and d.lang]
    assert sum(rows[d.doc_id].lang_pred == d.lang for d in out) >= 0.95 * len(out)


def test_language_odd_rows(spark):
    rows = [(i, t, "en", 0.0, "x") for i, t in enumerate(ODD)] + [(None, "the cat", None, 0.0, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    learned = spark.createDataFrame([("the cat sat", "en"), (None, "de"), ("und", None)],
                                    "text string, lang string")
    got = {r.doc_id: r for r in L.identify(df, learned).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(ODD):
        assert got[i].lang_pred == ("en" if t and any(c.isalpha() for c in t) else "und")
        assert 0 <= got[i].score <= 1
    kept = L.keep_identified(df, learned)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {None, 4, 5, 6, 7}
    assert {r.lang_pred for r in L.identify(df, learned.limit(0)).collect()} == {"und"}
    assert L.identify(df.limit(0), learned).collect() == []


def test_language_of_repeated_and_long_rows_and_ties(spark):
    learned = spark.createDataFrame([("the cat sat on the mat", "en"), ("der hund und die katze", "de"),
                                     ("der hund und die katze", "nl")], "text string, lang string")
    long_text = "the cat sat on the mat " * 150_000
    rows = [(1, long_text, "x"), (2, "der hund", "x"), (2, "der hund", "x"), (None, "the mat", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [(r.doc_id, r.lang_pred) for r in L.identify(df, learned).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (2, "de"), (2, "de"), (None, "en")], key=str)


# --- quality classifier ---

def test_quality_held_out(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert len(rows) == documents(spark, sf_dir).count()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    out = [x for x in labels if x.doc_id in rows and rows[x.doc_id].held_out]
    assert sum(rows[x.doc_id].predicted == x.quality for x in out) >= 0.85 * len(out)


def test_indicators_by_brute_force():
    cls, _ = C.tables()
    texts = ["Hello, World! hello", "", "AB!! ab&& ab&& \n x", "é 漢"]
    m = C.indicators(texts)
    for row, t in zip(m, texts, strict=True):
        k = [0, 0, 0] + [int(cls[ord(c)]) for c in t] + [0, 0, 0]
        want = {(((k[i] << 18 | k[i + 1] << 12 | k[i + 2] << 6 | k[i + 3]) * 2654435761) % 2 ** 32)
                >> (32 - C.CHAR_BITS) for i in range(len(t) + 3)}
        got = set(np.flatnonzero(row[:C.CHARS]).tolist())
        assert {f for f in want} - got <= set() and len(got - want) <= 1
    assert m[0, C.CHARS:].sum() == 2 and m[1, C.CHARS:].sum() == 0


def test_hinge_solution_is_optimal_enough():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(30, 8, replace=False)) for _ in range(200)]
    y = np.array([1.0 if 3 in r or 7 in r else -1.0 for r in rows])
    w = C.dual_coordinate_descent(rows, y, np.ones(30), epochs=60)
    assert (np.sign(C.margins(rows, np.ones(30), w)) == y).mean() > 0.97


def test_quality_odd_rows(spark):
    df = spark.createDataFrame([(i, t, "en", 0.5, "x") for i, t in enumerate(ODD)], SCHEMA)
    labels = spark.createDataFrame([(0, 1), (3, 0), (6, 1), (None, 1), (4, None), (5, 7), (99, 0)],
                                   "doc_id long, label int")
    got = C.quality_scores(df, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in C.quality_scores(df, labels.where("label = 1")).collect()} == {1.0}
    assert {r.score for r in C.quality_scores(df, labels.limit(0)).collect()} == {0.5}
    assert C.quality_scores(df.limit(0), labels).collect() == []


def test_quality_of_repeated_and_long_rows(spark):
    rows = [(i, "good prose of many words " * 9, "en", 0.5, "x") for i in range(6)]
    rows += [(i, "#$% !! 99 " * 20, "en", 0.5, "x") for i in range(6, 12)]
    rows += [(20, "good prose of many words " * 120_000, "en", 0.5, "x")] * 2
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(12)] + [(0, 1)], "doc_id long, label int")
    got = C.quality_scores(spark.createDataFrame(rows, SCHEMA), labels).collect()
    long_rows = [r.score for r in got if r.doc_id == 20]
    assert len(got) == len(rows) and len(long_rows) == 2 and long_rows[0] == long_rows[1] > 0.5


# --- quality rules ---

def brute_counts(text):
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search("[^\x20\x09-\x0D]", x) and x in lines[:i])
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_surface_counts_by_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        t = "".join(rng.choice("ab #%\n\t\x0b\x85\xa0<é ") for _ in range(rng.randint(0, 80)))
        assert Q.surface_counts(t) == brute_counts(t)


def brute_model(texts):
    """Modified Kneser-Ney with dictionaries, one n-gram at a time."""
    grams = {Q.ORDER: Counter()}
    for t in texts:
        f = brute_fold(t)
        grams[Q.ORDER].update(f[i:i + Q.ORDER] for i in range(len(f) - Q.ORDER + 1))
    for n in range(Q.ORDER - 1, 0, -1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    info = {}
    for n, c in grams.items():
        held = Counter(c.values())
        d = Q.discounts(*(held[k] for k in (1, 2, 3, 4)))
        ctx = defaultdict(lambda: [0, 0.0])
        for g, k in c.items():
            ctx[g[:-1]][0] += k
            ctx[g[:-1]][1] += d[min(k, 3)]
        info[n] = (c, d, ctx)

    def p(g):
        if not g:
            return 1 / (len(grams[1]) + 1)
        c, d, ctx = info[len(g)]
        total, cut = ctx[g[:-1]]
        return (c[g] - d[min(c[g], 3)]) / total + cut / total * p(g[1:])
    return p


def brute_fold(text):
    out = re.sub("[\x20\x09-\x0D]+", " ", text.lower()).removeprefix(" ")
    out = re.sub("[0-9]", "0", out)
    out = "".join("#" if c in "#*$%&|<>" else "." if "!" <= c <= "~" and not c.isalnum() else c for c in out)
    return Q.START * (Q.ORDER - 1) + out


def test_hash_arrays_find_what_they_hold():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        held = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        held = np.sort(np.concatenate((held, held[:5] + np.uint64(1)))) if n else held
        logp = rng.random(len(held)).astype(np.float32)
        wanted = np.concatenate((held, rng.integers(0, 1 << 63, 50).astype(np.uint64), [np.uint64(0)]))
        got, there = Q.HashArrays(held, logp).find(wanted)
        assert there.tolist() == np.isin(wanted, held).tolist()
        assert got[:len(held)].tolist() == logp.astype(float).tolist()


@pytest.mark.parametrize("hot", [Q.HOT, 40, 0])
def test_kneser_ney_by_brute_force(spark, monkeypatch, hot):
    """Whatever is broadcast and whatever is joined: the same scores as with dictionaries."""
    monkeypatch.setattr(Q, "HOT", hot)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abca b,1$7É漢字\U0001F600\n") for _ in range(120)) for _ in range(40)]
    texts += ["", " ", "é漢", "aa" * 5000, None]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    p = brute_model([t or "" for t in texts if t])
    got = {r.doc_id: r.log_ppl for r in Q.quality_rules(df.repartition(3)).collect()}
    for i, t in enumerate(texts):
        f = brute_fold(t or "")
        n = len(f) - Q.ORDER + 1
        want = -sum(math.log(p(f[j:j + Q.ORDER])) for j in range(n)) / max(n, 1)
        assert got[i] == pytest.approx(want, abs=1e-4)


def test_ngrams_follow_the_input_and_every_letter_counts(spark):
    """More text, more n-grams: no bound of an alphabet; letters of any script are told apart."""
    rng = random.Random(9)
    han = [chr(0x4E00 + i) for i in range(900)]

    def model(n):
        docs = [("".join(rng.choices(han, k=400)),) for _ in range(n)]
        return Q.train(spark.createDataFrame(docs, "text string")).count()
    small, large = model(20), model(200)
    assert large > 9 * small and large > 40 ** 4 / 40
    same = Q.folded("ж ш щ")
    assert len(set(same.tolist())) == 5          # three letters, the space, the mark in front


def test_word_order_matters(spark):
    """The same words in another order are less likely."""
    rng = random.Random(10)
    subject, verb, thing = (["sky", "sea", "ox", "elm"], ["hums", "roars", "eats", "grows"], ["oats", "ash", "ice", "up"])
    said = [" ".join(f"{rng.choice(subject)} {rng.choice(verb)} {rng.choice(thing)}." for _ in range(30))
            for _ in range(60)]
    words = said[0].split()
    rng.shuffle(words)
    rows = [(i, t, "en") for i, t in enumerate([*said, " ".join(words)])]
    got = {r.doc_id: r.log_ppl for r in Q.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[len(said)] > 1.3 * max(got[i] for i in range(len(said)))


def test_rules_query(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, sf_dir).collect()}
    docs = documents(spark, sf_dir).collect()
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.quality == 1}
    assert len(got) == len(docs)
    logs = {d.doc_id: got[d.doc_id].log_ppl for d in docs}
    for d in docs:
        r = got[d.doc_id]
        n = brute_counts(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert r.kept == (not r.base_failed and r.low <= logs[d.doc_id] <= r.high)
    clean = [d for d in good if not got[d].base_failed]
    assert sum(got[d].kept for d in clean) >= 0.99 * len(clean)


def test_noise_and_boilerplate_are_rejected(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").collect()
    rng = random.Random(6)
    english = [d.text for d in docs if d.lang == "en" and len(d.text.split()) >= 60]
    common = "the that this then than them they there these other another and in".split()
    noise, boilerplate = [], []
    for t in english[:8]:
        words = t.split()
        some = set(rng.sample(range(len(words)), len(words) // 2))
        noise.append(" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=len(w)))
                              if i in some else w for i, w in enumerate(words)))
        boilerplate.append(" ".join(rng.choices(common, k=120)))
    rows = [(d.doc_id, d.text, d.lang) for d in docs]
    rows += [(-1 - i, t, "en") for i, t in enumerate(noise + boilerplate)]
    got = {r.doc_id: r for r in Q.quality_rules(spark.createDataFrame(
        rows, "doc_id long, text string, lang string")).collect()}
    planted = [got[-1 - i] for i in range(16)]
    assert all(r.log_ppl > r.high for r in planted[:8])
    assert all(r.log_ppl < r.low and not r.base_failed for r in planted[8:])
    assert not any(r.kept for r in planted)


def test_low_quality_labels_are_rejected(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()
              if not got[r.doc_id].base_failed]
    low = [got[r.doc_id].kept for r in labels if r.quality == 0]
    clean = [got[r.doc_id].kept for r in labels if r.quality == 1]
    assert sum(low) <= 0.5 * len(low) and sum(clean) >= 0.99 * len(clean)


def test_rules_of_repeated_and_long_rows(spark):
    text = "some words that make a sentence of their own here . " * 20
    rows = [(1, text, "en"), (1, text, "en"), (2, text + "and more " * 400_000, "en"), (3, "漢字 " * 100, None)]
    got = Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    same = [r for r in got if r.doc_id == 1]
    assert len(got) == 4 and len(same) == 2 and same[0] == same[1]
    assert next(r for r in got if r.doc_id == 2).n_words == len(text.split()) + 800_000


def test_rules_odd_rows(spark):
    df = spark.createDataFrame([(i, t, None, 0.5, "x") for i, t in enumerate(ODD)], SCHEMA)
    got = Q.quality_rules(df).collect()
    assert len(got) == len(ODD)
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert Q.quality_rules(df.limit(0)).collect() == []
