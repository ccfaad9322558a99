"""The mix of sources against its SQL, a plain water-filling and odd rows."""

import random
import re
from collections import Counter

import pytest

from tests_llm_helpers import compare_with_oracle
from usagelens.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string, copies double, doc long, target int"


def targets(sizes: dict):
    """Water filling by hand: shared by weight, what is above the cap is shared again."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    got, left, open_ = {s: 0.0 for s in names}, 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        w = sum(weight[s] for s in open_)
        spare = 0.0
        for s in sorted(open_, key=str):
            got[s] += left * weight[s] / w
            if got[s] >= 2 * sizes[s]:
                spare += got[s] - 2 * sizes[s]
                got[s] = 2.0 * sizes[s]
                open_.discard(s)
        left = spare
    return got


def corpus(spark, seed=3, n=600):
    rng = random.Random(seed)
    names = ["b", "a", "é", "", None, "Z", "src10", "src9", "tiny"]
    rows = []
    for i in range(n):
        source = rng.choices(names, [200, 90, 60, 40, 30, 80, 50, 49, 1])[0]
        text = " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 60)))
        rows.append((i, rng.choice([text, text, text + " \t\n", "x\xa0y\x1cz", None, ""]), source, "s", 1.0, 2, 3))
    rows += [rows[5], rows[5], (None, "a b c", "a", None, None, None, None), (None, "a b", None, "", 0.0, 1, 1),
             (n, "one " * 50_000, "b", "s", 1.0, 2, 3)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def words(text):
    return len(re.findall("[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_copies_by_hand(spark):
    rows, df = corpus(spark)
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += words(r[1])
    want = targets(sizes)
    plan = M.mixing_plan(df)
    got = plan.collect()
    assert plan.columns == ["doc_id", "size", "source_size", "target", "copies", "taken"]
    assert len(got) == len(rows)
    by = {(r.doc_id, r.size): r for r in got}
    for r in rows:
        g = by[(r[0], words(r[1]))]
        rate = want[r[2]] / sizes[r[2]]
        assert g.source_size == sizes[r[2]] and g.target == pytest.approx(want[r[2]])
        assert g.copies in (int(rate), int(rate) + 1) or g.copies == 2 and rate > 1.999
        assert g.taken == g.copies * g.size <= 2 * g.size
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert sorted(map(str, got)) == sorted(map(str, M.mixing_plan(df.repartition(5)).collect()))


def test_mix_holds_the_planned_copies(spark):
    rows, df = corpus(spark, 4, 200)
    mix = M.mixed(df)
    assert mix.columns == df.columns
    want = Counter()
    for r in M.mixing_plan(df).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mix.collect()) == +want


def test_taken_words_come_near_the_target(spark):
    docs = spark.range(40_000).selectExpr(
        "id as doc_id", "repeat('w ', 1 + cast(pmod(xxhash64(id), 200) as int)) as text",
        "case when id % 3 = 0 then 'hot' else concat('s', id % 7) end as source")
    got = M.mixing_plan(docs).groupBy("source_size").agg({"target": "max", "taken": "sum"}).collect()
    assert len(got) == 8
    for r in got:
        assert r["sum(taken)"] == pytest.approx(r["max(target)"], rel=0.05)


def test_few_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mixing_plan(none).collect() == [] and M.mixed(none).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.doc_id, r.target, r.taken) for r in M.mixing_plan(blank).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
    one = spark.createDataFrame([(1, "a b", "a")], "doc_id long, text string, source string")
    assert M.mixing_plan(one).first().target == 3.0


def test_oracle(spark, sf_dir):
    compare_with_oracle(spark, sf_dir, "op12_mix_sources")
