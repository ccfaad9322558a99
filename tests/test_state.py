"""Sinks, sources and streams that keep state: slices replaced by predicate, breakpoints,
compaction by partition, late slots, a stored base, vendors in one scan, exact ratios."""

import datetime as dt
import os
import random
import uuid
from fractions import Fraction

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from usagelens.operators import sessions as SS
from usagelens.operators import windows as W
from usagelens.sources import readers as R
from usagelens.sources import sinks as K
from usagelens.streaming import ingest as ST
from usagelens.streaming import late as LT
from usagelens.streaming import online as ON


def files_of(path):
    return {os.path.relpath(os.path.join(d, n), path) for d, _, names in os.walk(path)
            for n in names if n.endswith(".parquet")}


# --- SNK-7 ---------------------------------------------------------------------------
def slice_table(spark, path):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "x"), ("c", 4, "y"), ("d/1 %", 5, "x"), (None, 6, "x"), ("e", 7, None)]
    K.write_partitioned(spark.createDataFrame(rows, "d string, v long, kind string"), path, ["d"])


def test_replace_where_touches_only_its_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    slice_table(spark, path)
    before = files_of(path)
    new = spark.createDataFrame([("a", 10, "x"), ("f", 11, "x")], "d string, v long, kind string")
    for _ in range(2):      # the second run replaces what the first one wrote
        K.replace_where(new, path, F.col("kind") == "x", ["d"])
        got = {(r.d, r.v, r.kind) for r in spark.read.parquet(path).collect()}
        assert got == {("a", 2, "y"), ("a", 10, "x"), ("c", 4, "y"), ("e", 7, None), ("f", 11, "x")}
    after = files_of(path)
    same = {f for f in before if f.startswith(("d=c", "d=e"))}
    assert len(same) == 2 and same <= after
    # Partitions of which nothing is left are gone, whatever their name needed escaping.
    assert {f.split("/")[0] for f in after} == {"d=a", "d=c", "d=e", "d=f"}


def test_replace_where_refuses_rows_outside_the_predicate(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    slice_table(spark, path)
    new = spark.createDataFrame([("a", 10, "y")], "d string, v long, kind string")
    with pytest.raises(ValueError):
        K.replace_where(new, path, F.col("kind") == "x", ["d"])
    K.replace_where(new.limit(0), path, F.lit(False), ["d"])
    assert spark.read.parquet(path).count() == 7


# --- SNK-11 --------------------------------------------------------------------------
def test_compaction_gives_every_partition_its_files(spark, tmp_dir):
    path, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    skewed = spark.range(30_000).selectExpr("id", "uuid() as v", "CASE WHEN id % 100 < 90 THEN 'hot /1' "
                                            "WHEN id % 100 < 99 THEN 'b' END AS p", "id % 2 AS q")
    skewed.repartition(7).write.partitionBy("p", "q").parquet(path)
    target = 60_000
    largest = K.compact(spark, path, out, target_bytes=target, partition_cols=["p", "q"])
    want, got = {}, {}
    for into, root in ((want, path), (got, out)):
        for f in files_of(root):
            into.setdefault(os.path.dirname(f), []).append(os.path.getsize(os.path.join(root, f)))
    assert {k: -(-sum(v) // target) for k, v in want.items()} == {k: len(v) for k, v in got.items()}
    assert largest == max(-(-sum(v) // len(got[k])) for k, v in want.items()) <= target
    assert max(len(v) for v in got.values()) > 5
    a, b = spark.read.parquet(path), spark.read.parquet(out)
    assert a.count() == b.count() and a.exceptAll(b.select(a.columns)).isEmpty()


# --- SNK-12 --------------------------------------------------------------------------
def fold(state, cycle):
    """The rule cycle by cycle: (current, last)."""
    if state is None:
        return cycle, None
    curr, last = state
    if last is not None and cycle < last:
        return state
    return (curr, cycle) if cycle < curr else (cycle, curr)


def test_kept_breakpoints_equal_the_fold(spark, tmp_dir):
    rng = random.Random(4)
    path = os.path.join(tmp_dir, "breaks")
    assert K.stored_breakpoints(spark, path).collect() == []
    want = {}
    for step in range(5):
        batch = [(rng.choice("abc"), f"{rng.randrange(60):04d}") for _ in range(6)]
        for name, cycle in batch:
            want[name] = fold(want.get(name), cycle)
        df = spark.createDataFrame([*batch, ("a", None)], "name string, cycle string")
        for _ in range(2):
            K.advance_stored_breakpoint(df, path, step)
        got = {r.name: (r.curr, r.last) for r in K.stored_breakpoints(spark, path).collect()}
        assert got == want
    K.advance_stored_breakpoint(df.limit(0), path, 9)
    assert {r.name for r in K.stored_breakpoints(spark, path).collect()} == set(want)


# --- SRC-5, SRC-8, SRC-13 ------------------------------------------------------------
def test_encoded_lines_come_back(spark, tmp_dir):
    lines = ["", "状态|结束", "\x07\x1f \t", "é", "", "plain "]
    path = os.path.join(tmp_dir, "gbk")
    df = spark.createDataFrame([(x,) for x in [*lines, None]], "value string")
    K.write_encoded(df, path, "GBK")
    raw = b"".join(open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.startswith("part"))
    assert "状态|结束".encode("gbk") in raw and "状态".encode() not in raw
    assert sorted(r.value for r in R.scan_encoded(spark, path, "GBK").collect()) == sorted([*lines, ""])
    for bad in ("two\nlines", "\U0001F600"):
        with pytest.raises(Exception):
            K.write_encoded(spark.createDataFrame([(bad,)], "value string"), os.path.join(tmp_dir, "bad"), "GBK")


def test_dropped_lines_are_counted_in_the_same_pass(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines")
    os.makedirs(path)
    with open(os.path.join(path, "a.txt"), "w") as f:
        f.write("1|a\n2|b|c\n\n3\n4|d\n")
    seen = Observation()
    rows = R.scan_delimited_observed(spark, path, "|", ["k", "v"], seen).collect()
    assert {tuple(r) for r in rows} == {("1", "a"), ("4", "d")}
    assert seen.get == {"lines": 5, "kept": 2, "dropped": 3, "short": 2, "long": 1}


def test_vendors_in_one_scan(spark, tmp_dir):
    for folder, text in {"x/hw_1": "1|a\nbad\n", "x/zt_1": "b;2\n", "y/other": "3|c\n"}.items():
        os.makedirs(os.path.join(tmp_dir, folder))
        with open(os.path.join(tmp_dir, folder, "f.log"), "w", encoding="gbk") as f:
            f.write(text.replace("a", "状"))

    def fields(sep, k, v):
        def run(line):
            p = F.split(line, sep, -1)
            return F.when(F.size(p) == 2, F.struct(p[k].alias("k"), p[v].alias("v")))
        return run
    df = R.scan_vendors(spark, tmp_dir, {"/hw_": fields("[|]", 0, 1), "/zt_": fields(";", 1, 0),
                                         "/never_": fields(",", 0, 1)}, "GBK")
    assert {tuple(r) for r in df.collect()} == {("1", "状"), ("2", "b")}
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


# --- WN-4 ----------------------------------------------------------------------------
def test_ratios_rank_exactly(spark):
    big = 10 ** 17
    rows = [("g", i, n, d) for i, (n, d) in enumerate([
        (1, 3), (2, 6), (big, 3 * big), (big + 1, 3 * big), (big, 3 * big + 1), (0, 5), (0, 9), (7, 7), (5, 2)])]
    rng = random.Random(1)
    rows += [("r", i, rng.randrange(40), rng.randrange(1, 40)) for i in range(300)]
    rows += [("g", 99, 1, 0), ("g", 98, 1, None)]
    df = spark.createDataFrame(rows, "g string, id long, n long, d long")
    got = {(r.g, r["id"]): r["rank"] for r in W.rank_by_ratio(df, ["g"], "n", "d", tiebreak=["id"]).collect()}
    for g in "gr":
        mine = [r for r in rows if r[0] == g]
        order = sorted(mine, key=lambda r: (not r[3], -Fraction(r[2], r[3]) if r[3] else 0,
                                            -(r[3] if r[3] is not None else -1), r[1]))
        assert [got[r[0], r[1]] for r in order] == list(range(1, len(mine) + 1))
    assert W.rank_by_ratio(df, ["g"], "n", "d", below=3, tiebreak=["id"]).count() == 4


# --- ST-6, ST-8, ST-9 ----------------------------------------------------------------
def test_word_count_goes_on_after_a_restart(spark, tmp_dir):
    src, out, name = os.path.join(tmp_dir, "w"), os.path.join(tmp_dir, "c"), f"wc_{uuid.uuid4().hex[:6]}"
    for k, (text, want) in enumerate([("a b a", {"a": 2, "b": 1}), ("c  a", {"a": 3, "b": 1, "c": 1}),
                                      ("b", {"a": 3, "b": 2, "c": 1})]):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(src)
        ST.complete_results(ST.word_count(R.text_stream(spark, src)), out, name).awaitTermination()
        assert {r.word: r["count"] for r in ST.newest_complete(spark, out).collect()} == want
        assert len([d for d in os.listdir(out) if d.startswith("batch_id")]) == min(k + 1, 2)


EVENT = StructType([StructField("key", StringType()), StructField("net", StringType()),
                    StructField("status", StringType()), StructField("time", TimestampNTZType())])


def test_running_online_on_a_base_equals_the_batch_count(spark, tmp_dir):
    rng = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    events = sorted(((rng.choice("ab"), rng.choice(["3g", None]), rng.choice(["Start", "Stop", "Interim"]),
                      t0 + dt.timedelta(minutes=rng.randrange(3 * 24 * 60))) for _ in range(400)), key=lambda r: r[3])
    base = spark.createDataFrame(
        [(t0.date(), "a", "3g", 5), (t0.date(), "idle", None, 3), ((t0 + dt.timedelta(days=1)).date(), "b", None, 2)],
        "day date, key string, net string, base_cnt long")
    timed = base.withColumn("base_time", F.col("day").cast("timestamp_ntz"))
    src, out, name = os.path.join(tmp_dir, "e"), os.path.join(tmp_dir, "o"), f"on_{uuid.uuid4().hex[:6]}"
    for part in (events[:150], events[150:]):
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(src)
        stream = ON.online_since_base(R.file_stream(spark, src, EVENT), timed, ["key", "net"])
        ST.upsert_batches(stream, out, name, ["day", "key", "net"]).awaitTermination()
    got = {(r.day, r.key, r.net): r.online for r in ON.with_idle_keys(
        ST.latest_versions(spark, out, ["day", "key", "net"]), timed, ["key", "net"]).collect()}
    batch = SS.online_count(spark.createDataFrame(events, EVENT).withColumn("day", F.to_date("time"))
                            .withColumn("slot", F.date_format("time", "HH")), base, ["key"], "day", "slot")
    last = {}
    for r in batch.where("net is null or net <> '-1'").collect():
        at = (r.day, r.key, r.net)
        if at not in last or ("" if r.slot == "base" else r.slot) > last[at][0]:
            last[at] = ("" if r.slot == "base" else r.slot, r.online)
    assert got == {k: v[1] for k, v in last.items()} and (t0.date(), "idle", None) in got


def test_events_before_the_base_time_are_in_the_base(spark, tmp_dir):
    noon = dt.datetime(2024, 1, 1, 12)
    rows = [("a", "3g", "Start", noon - dt.timedelta(hours=1)), ("a", "3g", "Start", noon), ("a", "3g", "Stop", noon)]
    base = spark.createDataFrame([(noon.date(), "a", "3g", noon, 4)],
                                 "day date, key string, net string, base_time timestamp_ntz, base_cnt long")
    src, out = os.path.join(tmp_dir, "e"), os.path.join(tmp_dir, "o")
    spark.createDataFrame(rows, EVENT).write.parquet(src)
    stream = ON.online_since_base(R.file_stream(spark, src, EVENT), base, ["key", "net"])
    ST.upsert_batches(stream, out, f"on_{uuid.uuid4().hex[:6]}", ["day", "key", "net"]).awaitTermination()
    assert [r.online for r in ST.latest_versions(spark, out, ["day", "key", "net"]).collect()] == [4]


def test_late_rows_refresh_only_their_slots(spark, tmp_dir):
    schema = StructType([StructField("d", StringType()), StructField("h", StringType()), StructField("v", LongType())])
    src, rows, out = (os.path.join(tmp_dir, x) for x in ("in", "rows", "sum"))
    name = f"late_{uuid.uuid4().hex[:6]}"

    def total(df):
        return df.groupBy("d", "h").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))

    def feed(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        LT.refresh_touched_slots(R.file_stream(spark, src, schema), rows, out, name, total, ["d", "h"]).awaitTermination()

    feed([("240101", "00", 1), ("240101", "01", 2), ("240102", "00", 3)])
    first = files_of(out)
    feed([("240101", "00", 10), ("240103", "05", 4)])       # two days late, and a new slot
    assert {(r.d, r.h): (r.v, r.n) for r in spark.read.parquet(out).collect()} == {
        ("240101", "00"): (11, 2), ("240101", "01"): (2, 1), ("240102", "00"): (3, 1), ("240103", "05"): (4, 1)}
    untouched = {f for f in first if not f.startswith("d=240101/h=00")}
    assert len(untouched) == 2 and untouched <= files_of(out)
    assert not {f for f in first if f.startswith("d=240101/h=00")} & files_of(out)
