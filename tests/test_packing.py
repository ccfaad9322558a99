"""Packed shuffles: the same rows in fewer bytes, also where values are null, extreme or repeated."""

import datetime as dt
import random
import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import duck, rows_digest, spark_rows
from usagelens.operators import joins as J
from usagelens.operators import outliers as O
from usagelens.operators import packing as P
from usagelens.operators import summaries as S
from usagelens.plans import catalog as C
from usagelens.session import DROP_SHUFFLES, stored_step

DAY = dt.date(2024, 1, 31)
SCHEMA = "k long, a long, b int, s string, t string, d date, wide long, x double, one string"


def _sorted(df):
    return sorted(map(str, df.collect()))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def many(spark, monkeypatch):
    """The small tables count as many records, and no dimension fits a broadcast."""
    monkeypatch.setattr(J, "ROWS_PER_TASK", 300)
    J._SIZE_CHECKED.clear()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    yield
    J._SIZE_CHECKED.clear()
    (spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before) if before
     else spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))


def test_packed_rows_come_back(spark, monkeypatch):
    monkeypatch.setattr(P, "TEXTS_KEPT", 3)
    rows = spark.createDataFrame(
        [(1, -5, 2147483647, "x", "t1", DAY, -2**63, 0.5, None), (None, 2**40, -2147483648, "", "t2", None, 2**63 - 1, None, None),
         (3, None, None, None, "t3", dt.date(1969, 12, 31), None, float("nan"), None), (3, 0, 0, "x", "t4", DAY, 0, -1.0, None)], SCHEMA)
    codes = P.codes_of(rows, rows.columns)
    assert set(codes) == {"k", "a", "b", "s", "d", "one"}  # too wide, too many texts and no whole number stay
    dealt = P.spread_packed(rows, 3, ["k"], codes)
    assert dealt.dtypes == rows.dtypes and _sorted(dealt) == _sorted(rows)
    assert "__word_1" in _plan(dealt) and "__word_3" not in _plan(dealt)
    empty = rows.where("k = 77")
    assert _sorted(P.spread_packed(empty, 3, ["k"], P.codes_of(empty, rows.columns))) == []


def test_daily_dimension_summary_deals_packed_records_once_per_level(spark, sf_dir, many):
    out = C.QUERIES["daily_dimension_summary"](spark, sf_dir)
    plan = _plan(out)
    dealt = re.findall(r"hashpartitioning\(([^)]*), \d+\), REPARTITION_BY_NUM", plan)
    keys = {re.sub(r"#\d+L?", "", d) for d in dealt}
    assert keys == {"summ_cycle, custid", "tac"} and len(dealt) == 3
    assert not re.search(r"hashpartitioning\([^)]*(enbid|mdn)", plan)  # station rows are summed where they are ranked
    for below in plan.split("REPARTITION_BY_NUM")[1:]:
        assert "__word_0" in below.split("\n")[1]
    con = duck(sf_dir)
    want = con.execute(C.ORACLE["daily_dimension_summary"])
    assert rows_digest(*spark_rows(out)) == rows_digest([c[0] for c in want.description], want.fetchall())


@pytest.mark.parametrize("tasks,records_a_row", [(None, 2), (3, 2), (3, 0)])
def test_daily_dimension_summary_with_repeated_and_null_keys(spark, many, monkeypatch, tasks, records_a_row):
    monkeypatch.setattr(S, "RECORDS_A_ROW", records_a_row)
    usage = spark.createDataFrame(
        [("202401", m, s, e, p, t, u, 10 * u) for m, s, e, p, t, u in
         [(1, 1, 7, "P", 5, 3), (1, 1, 7, "P", 5, 3), (1, 2, 7, "Q", 5, 4), (2, None, 7, "P", None, 5), (2, 3, 8, "P", 6, 0),
          (None, 4, 7, "P", 5, 6), (3, 5, None, "P", 9, 7), (4, 6, 8, None, 5, 9), (5, 7, 10, "P", 6, 9)]],
        "day string, mdn long, session_id long, enbid long, prov string, tac long, upflow long, downflow long")
    users = spark.createDataFrame([(1, "c", "1"), (1, "c", "1"), (2, "c", "0"), (3, None, "1"), (5, "c", "1")],
                                  "mdn long, custid string, isnb string")
    stations = spark.createDataFrame([(7, "P", "x"), (7, "P", "y"), (7, "P", "y"), (8, "P", None), (None, "P", "z"), (10, "P", "x")],
                                     "enbid long, provname string, cityname string")
    devices = spark.createDataFrame([(5, "m"), (5, "m"), (5, "n"), (6, None), (None, "k"), (6, "a")], "tac long, modelname string")
    out = S.daily_dimension_summary(usage, users, stations, devices, F.col("day"), tasks=tasks)

    rows = (usage.join(users.where("isnb = '1'").select("mdn", "custid"), "mdn", "left")
            .join(stations.select("enbid", F.col("provname").alias("prov"), "cityname", F.lit(True).alias("hit")), ["enbid", "prov"], "left")
            .join(devices, "tac", "left")
            .select(F.col("day").alias("summ_cycle"), F.coalesce("custid", F.lit(S.UNKNOWN)).alias("custid"),
                    F.col("enbid").cast("string").alias("enbid"), F.when(F.col("hit"), F.col("prov")).alias("prov"),
                    F.coalesce("cityname", F.lit("-")).alias("city"), "modelname", F.col("tac").cast("string").alias("tac"),
                    "upflow", "downflow", "mdn", "session_id"))
    keys = {"BS": ["enbid", "prov", "city"], "CITY": ["prov", "city"], "PROV": ["prov"],
            "TERMDETAIL": ["prov", "city", "modelname", "tac"]}
    names = {"BS": "enbid", "CITY": "city", "PROV": "prov", "TERMDETAIL": "modelname"}
    want = []
    for level, cols in keys.items():
        agg = (rows.groupBy("summ_cycle", "custid", *cols)
               .agg(F.sum("upflow").alias("OUTFLOW"), F.sum("downflow").alias("INFLOW"), F.count_distinct("mdn").alias("ACTIVEUSERS"),
                    F.count("session_id").alias("SESSIONS")).withColumn("TOTALFLOW", F.col("OUTFLOW") + F.col("INFLOW")))
        for measure in (["OUTFLOW", "INFLOW", "ACTIVEUSERS", "SESSIONS", "TOTALFLOW"] if level != "TERMDETAIL" else ["ACTIVEUSERS"]):
            by = "INFLOW" if measure == "TOTALFLOW" else measure
            rank = F.row_number().over(Window.partitionBy("summ_cycle", "custid").orderBy(by, *cols))
            city = F.lit("-1") if level == "PROV" else F.col("city")
            want += (agg.select("summ_cycle", "custid", city.alias("city"), "prov", F.lit("-1").alias("district"),
                                F.lit(level).alias("dim_type"), F.col(names[level]).alias("dim_obj"),
                                F.lit(measure if level != "TERMDETAIL" else "-1").alias("meas_obj"),
                                F.col(measure).alias("meas_value"), rank.alias("meas_rank")).where("meas_value <> 0").collect())
    assert _sorted(out) == sorted(map(str, want))


def test_stored_step_leaves_no_shuffle_files(spark, tmp_dir):
    def shuffles():
        return {f.getName() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
                for sub in (d.listFiles() or []) for f in (sub.listFiles() or []) if f.getName().startswith("shuffle_")}
    before, was = shuffles(), spark.conf.get(DROP_SHUFFLES, None)
    rows = spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count()
    out = stored_step(rows, "test-step")
    until = time.time() + 20  # the files go in the background
    while (left := {n for n in shuffles() - before if n.endswith(".data")}) and time.time() < until:
        time.sleep(0.2)
    assert not left and out.where("count = 100").count() == 10
    assert spark.conf.get(DROP_SHUFFLES, None) == was


def _outliers_by_sorting(rows, min_users):
    """AN-7 on (custid, mdn, up, down) rows by sorting each peer group."""
    mean = lambda xs: sum(xs) / len(xs) if xs else None
    total = lambda r: None if r[2] is None or r[3] is None else r[2] + r[3]
    last = lambda v: (v is not None, v or 0)
    out = []
    for c in {r[0] for r in rows if r[0] and r[0].strip()}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (last(total(r)), last(r[1])))
        kept = [r for i, r in enumerate(own, 1) if 10 < i * 100 / len(own) < 90]
        if len({r[1] for r in kept} - {None}) <= min_users:
            continue
        peer = mean([total(r) for r in kept if total(r) is not None])
        for m in {r[1] for r in own}:
            of = [r for r in own if r[1] == m]
            means = [mean([x for x in v if x is not None]) for v in ([r[2] for r in of], [r[3] for r in of], [total(r) for r in of])]
            if peer and means[2] is not None and not 50 <= means[2] * 100 / peer <= 150:
                out.append(str((c, m, *means, peer)))
    return sorted(out)


@pytest.mark.parametrize("tasks", [None, 3])
@pytest.mark.parametrize("few", [2, 40])
def test_usage_outlier_period_finds_its_cuts_by_counts(spark, many, tasks, few):
    rng = random.Random(7 * few)
    some = lambda n: None if rng.random() < 0.08 else rng.randrange(n)
    rows = [(c, some(5 + n // 9), some(few), some(few)) for c, n in
            (("a", 90), ("b", 11), ("c", 1), ("d", 2), ("e", 10), (" ", 40), (None, 40), ("f", 230)) for _ in range(n)]
    rows += [("zero", m, 0, 0) for m in range(50)] + [("zero", m % 7, 900, m) for m in range(12)] + [("null", m, None, 1) for m in range(30)]
    rows += [("g", m, u * 10**11, 10**15 + u) for m in range(20) for u in (1, 5, 9)]
    df = spark.createDataFrame(rows, "custid string, mdn long, upflow long, downflow long")
    out = O.usage_outlier_period(df, ["custid"], ["mdn", "cycle"], min_users=1, tasks=tasks)
    assert out.columns == ["custid", "mdn", "avg_upflow", "avg_downflow", "avg_flow", "avg_total_flow"]
    found = sorted(str(tuple(r)) for r in out.collect())
    assert found == _outliers_by_sorting(rows, 1) and len(found) > 20


def test_usage_outlier_period_deals_packed_rows_once(spark, sf_dir, many):
    out = C.QUERIES["usage_outlier_period"](spark, sf_dir)
    plan = _plan(out)
    dealt = re.findall(r"hashpartitioning\(([^)]*), \d+\), REPARTITION_BY_NUM", plan)
    assert [re.sub(r"#\d+L?", "", d) for d in dealt] == ["mdn"] and "Window" not in plan
    assert "__word_0" in plan.split("REPARTITION_BY_NUM")[1].split("\n")[1]
    want = duck(sf_dir).execute(C.ORACLE["usage_outlier_period"])
    assert rows_digest(*spark_rows(out)) == rows_digest([c[0] for c in want.description], want.fetchall())
