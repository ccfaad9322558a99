"""Rules of the composed operators on small hand-made inputs."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from usagelens.operators import baselines as B
from usagelens.operators import dimensions as D
from usagelens.operators import joins as J
from usagelens.operators import multidim as M
from usagelens.operators import outliers as O
from usagelens.operators import sessions as SS
from usagelens.operators import windows as W
from usagelens.sources import sinks as K


def test_positions_within_skewed_group_match_window(spark):
    # one hot key holds a third of the rows; the rest spread over many keys
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"),
        ((F.col("id") * 7919) % 1000).alias("v"), F.col("id"))
    got = W.positions_within(df, ["k"], ["v", "id"])
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("v", "id"))) \
        .withColumn("cnt", F.count(F.lit(1)).over(Window.partitionBy("k")))
    j = got.join(ref, ["k", "v", "id"])
    assert j.count() == 30000
    assert j.where((F.col("__pos") != F.col("rn")) | (F.col("__n") != F.col("cnt"))).count() == 0


def test_positions_with_nulls_everywhere_match_window(spark):
    # null group keys, null, negative, tied and fractional values, descending order
    nul = lambda c, n: F.when(F.col("id") % n != 0, c)
    df = spark.range(0, 4000).select(
        nul((F.col("id") % 3).cast("string"), 5).alias("k"), nul(F.col("id") % 2, 7).alias("g"),
        nul(((F.col("id") * 31) % 40 - 20) / 8, 11).alias("v"),
        nul(F.concat(F.lit("s"), (F.col("id") % 97).cast("string")), 13).alias("s"), "id")
    for up in (True, False):
        got = W.positions_within(df, ["k", "g"], [("v", up), "s", "id"])
        order = [F.col("v").asc() if up else F.col("v").desc(), "s", "id"]
        ref = df.select("id", F.row_number().over(Window.partitionBy("k", "g").orderBy(*order)).alias("rn"),
                        F.count(F.lit(1)).over(Window.partitionBy("k", "g")).alias("cnt"))
        j = got.join(ref, "id")
        assert j.count() == 4000
        assert j.where((F.col("__pos") != F.col("rn")) | (F.col("__n") != F.col("cnt"))).count() == 0
    kept = W.position_trim_skew_safe(df, ["k", "g"], ["v", "s", "id"]).select("id")
    ref = W.position_trim(df, ["k", "g"], "v", tiebreak=["s", "id"]).select("id")
    assert kept.exceptAll(ref).count() == 0 and ref.exceptAll(kept).count() == 0


def test_null_network_is_not_the_total(spark):
    m = spark.createDataFrame([("c", 1, None, 5), ("c", 1, "3g", 7), (None, 1, "3g", 2)],
                              "cycle string, enbid long, net string, req long")
    st = spark.createDataFrame([(1, "p", "x")], "enbid long, provname string, cityname string")
    got = [(r.cycle, r.net, r.r_req) for r in M.area_rank(m, st, {"r": ("req", None)})
           .where("level = 'TOTAL'").collect()]
    assert sorted(got, key=str) == sorted([("c", None, 5), ("c", "3g", 7), ("c", "t", 12),
                                           (None, "3g", 2), (None, "t", 2)], key=str)


def test_positions_by_dates_and_texts_both_ways(spark):
    import datetime as dt
    import random
    from pyspark.sql import Window
    rng = random.Random(8)
    day = dt.datetime(1969, 12, 30)
    rows = [(rng.choice(["k", None]), rng.choice([None, day + dt.timedelta(hours=rng.randrange(150))]),
             rng.choice([None, "", "a", "abcd", "abcde", "abcf", "é", "zz"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, s string, id long")
    for order in ([("t", True), ("s", False), "id"], [("t", False), ("s", True), "id"],
                  [("s", False), ("t", False), "id"], [("s", True), ("t", True), "id"]):
        pairs = [(o, True) if isinstance(o, str) else o for o in order]
        w = Window.partitionBy("k").orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in pairs])
        want = {r.id: r.p for r in df.withColumn("p", F.row_number().over(w)).collect()}
        assert {r.id: r.p for r in W.positions_within(df, ["k"], order, "p").collect()} == want


def test_global_rank_matches_row_number(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 37) % 101).alias("v"), "id")
    got = W.global_rank(df, ["v"], "r", tiebreak=["id"])
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("v").desc(), "id")))
    assert got.join(ref, ["v", "id"]).where(F.col("r") != F.col("rn")).count() == 0
    assert got.agg(F.min("r"), F.max("r")).first() == (1, 5000)


def _series(spark, rows):
    return spark.createDataFrame([(k, dt.date.fromisoformat(d), s, v) for k, d, s, v in rows],
                                 "k string, day date, slot string, value bigint")


def test_baseline_fixed_divisor_with_missing_days(spark):
    # target 2024-01-08 sees only three of its seven days
    s = _series(spark, [("a", "2024-01-05", "0000", 10), ("a", "2024-01-06", "0000", 40),
                        ("a", "2024-01-07", "0000", 20)])
    b = B.baseline(s, ["k"], days=7).where(F.col("day") == "2024-01-08").first()
    assert b.baseline == (20 + 40) / 5  # ranks 2..6 of (10, 20, 40) over the fixed divisor 5
    o = B.baseline(s, ["k"], days=7, divisor="observed").where(F.col("day") == "2024-01-08").first()
    assert o.baseline == (20 + 40) / 2


def test_baseline_two_days_plain_sum(spark):
    s = _series(spark, [("a", "2024-01-05", "0000", 10), ("a", "2024-01-06", "0000", 40)])
    b = B.baseline(s, ["k"], days=2).where(F.col("day") == "2024-01-07").first()
    assert b.baseline == 25.0


def test_snapshot_merge_null_in_increment_wins(spark):
    prev = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "mdn int, a string, b int")
    incr = spark.createDataFrame([(2, None, 7), (3, "z", 8)], "mdn int, a string, b int")
    got = {r.mdn: (r.a, r.b) for r in D.snapshot_merge(prev, incr, ["mdn"]).collect()}
    assert got == {1: ("x", 5), 2: (None, 7), 3: ("z", 8)}


def test_outlier_day_drops_subjects_without_peer(spark):
    rows = [("c1", "p", "city", m, 100, 0) for m in range(5)] + [("c1", "p", "city", 99, 1000, 0),
                                                                 ("c2", "p", "city", 7, 5000, 0)]
    df = spark.createDataFrame(rows, "custid string, own_provid string, own_lanid string, mdn int, "
                                     "upflow bigint, downflow bigint")
    out = O.usage_outlier_day(df, ["custid", "own_provid", "own_lanid"], ["custid", "own_lanid"], min_users=3)
    assert [r.mdn for r in out.collect()] == [99]   # c2 has one user: no peer row, drops out


def test_online_sessions_start_without_stop(spark):
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    ev = spark.createDataFrame([
        (1, "s1", "Start", t(0, 10), 11, "3g"), (1, "s1", "Stop", t(0, 40), 12, "3g"),   # closed
        (2, "s2", "Start", t(0, 20), 21, "3g"), (2, "s2", "Interim", t(0, 50), 22, "4g"),  # open
    ], "mdn int, session_id string, status string, time timestamp_ntz, enbid int, net string")
    snap = SS.online_sessions(ev, lookback_hours=7).where(F.col("snapshot") == t(1, 0)).collect()
    assert [(r.mdn, r.enbid, r.net) for r in snap] == [(2, 22, "4g")]


def test_multi_dim_rows_owned_domain_single_row(spark):
    users = spark.createDataFrame([(1, "C1", "d1,d2", "1", "0")], "mdn int, companycode string, vpdndomain string, "
                                                                 "isvpdn string, isdirect string")
    t = dt.datetime(2024, 1, 1)
    v = spark.createDataFrame([("vpdn3g", 1, 9, 1, 1, t, "1@d2", "a"), ("vpdn3g", 1, 9, 1, 1, t, "1@zz", "a")],
                              "klass string, mdn int, bsid int, upflow bigint, downflow bigint, "
                              "starttime timestamp_ntz, nai string, apn string")
    apn = spark.createDataFrame([("d1", "a")], "vpdndomain string, apn string")
    rows = M.multi_dim_rows(v, users, apn).collect()
    assert sorted(r.vpdndomain for r in rows) == ["d1", "d2", "d2"]   # owned: 1 row; not owned: all domains


SERVICE_USERS = ("mdn int, companycode string, isvpdn string, isdirect string, iscommon string, vpdndomain string")


def test_auth_service_follows_the_records_own_domain(spark):
    users = spark.createDataFrame([(1, "C1", "1", "0", "0", "d1,d2"), (2, "C1", "1", "1", "0", "d1")], SERVICE_USERS)
    t = dt.datetime(2024, 1, 1)
    auth = spark.createDataFrame([(1, "3g", "success", t, "1@d1"), (1, "3g", "failed", t, "1@zz"),
                                  (2, "4g", "success", t, "2@d1")],
                                 "mdn int, net string, result string, starttime timestamp_ntz, nai string")
    out = [r for r in M.auth_summary(auth, users, F.lit("c")).collect() if r.type is None]
    got = {(r.servtype, r.vpdndomain): (r.req_cnt, r.req_card_cnt, r.req_card_f_cnt) for r in out}
    assert got == {(None, None): (3, 2, 1), ("C", None): (1, 1, 0), ("C", "d1"): (1, 1, 0),
                   ("P", None): (1, 1, 1), ("D", None): (1, 1, 0)}


def test_user_flags_are_tested_independently(spark):
    users = spark.createDataFrame([(1, "C1", "1", "1", "0", "d1,d2"), (2, "C1", "0", "0", "0", "d1"),
                                   (3, "C1", "0", "1", "1", "")], SERVICE_USERS)
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(m, "3g", "success", t) for m in (1, 2, 3)],
                                "mdn int, net string, result string, starttime timestamp_ntz")
    out = [r for r in M.mme_summary(log, users, F.lit("c"), F.lit(True)).collect() if r.type is None]
    assert {(r.servtype, r.vpdndomain): r.req_cnt for r in out} == {
        (None, None): 3, ("D", None): 2, ("C", None): 1, ("C", "d1"): 1, ("C", "d2"): 1, ("P", None): 1}
    ev = spark.createDataFrame([(m, "Start", None, "3g") for m in (1, 2, 3)],
                               "mdn int, status string, cause string, net string")
    out = [r for r in SS.login_logout_summary(ev, users, F.lit("c")).collect() if r.net == "-1"]
    # here the common flag only counts where the direct one is not set
    assert {(r.servtype, r.domain): r.logincnt for r in out} == {
        ("-1", None): 3, ("D", None): 2, ("C", None): 1, ("C", "d1"): 1, ("C", "d2"): 1}


def test_terminals_keep_users_of_unknown_devices(spark):
    users = spark.createDataFrame([(1, "00000007xxxxxxx", "C1", "1", "1", "a,b"), (2, "99999999xxxxxxx", "", "0", "1", ""),
                                   (3, None, "C9", "0", "0", "")],
                                  "mdn int, imei string, companycode string, isvpdn string, isdirect string, vpdndomain string")
    companies = spark.createDataFrame([("C1", "P1"), ("C9", None)], "companycode string, provincecode string")
    devices = spark.createDataFrame([(7, "phone", "m")], "tac int, devicetype string, modelname string")
    got = {tuple(r) for r in D.terminal_stats(users, companies, devices).collect()}
    assert got == {("phone", "m", "P1", "C1", "C", "-1", 1), ("phone", "m", "P1", "C1", "C", "a", 1),
                   ("phone", "m", "P1", "C1", "C", "b", 1), (None, None, "N999999999", "P999999999", "D", "-1", 1),
                   (None, None, "N999999999", "C9", "P", "-1", 1)}


def test_sector_lifecycle_dormant_resets_first_use(spark):
    t = dt.datetime
    prev = spark.createDataFrame([("p", "1", "b", "s", t(2023, 1, 1), t(2023, 2, 1), 6),
                                  ("p", "1", "b", "s2", t(2023, 1, 1), t(2024, 1, 1), 1)],
                                 "prov string, tac string, bsid string, sectid string, firstusetime timestamp_ntz, "
                                 "lastusetime timestamp_ntz, status int")
    today = spark.createDataFrame([("p", "1", "b", "s", t(2024, 1, 3), t(2024, 1, 4)),
                                   ("p", "1", "b", "s2", t(2024, 1, 2), t(2024, 1, 2))],
                                  "prov string, tac string, bsid string, sectid string, firstusetime timestamp_ntz, "
                                  "lastusetime timestamp_ntz")
    got = {r.sectid: r for r in D.sector_lifecycle(today, prev, "2024-01-20").collect()}
    assert got["s"].firstusetime == t(2024, 1, 3) and got["s"].status == 2     # dormant: reset; 16 idle days
    assert got["s2"].firstusetime == t(2023, 1, 1) and got["s2"].status == 2   # kept; 18 idle days


def test_breakpoint_ignores_out_of_order(spark):
    state = spark.createDataFrame([("job", "202401011000", "202401010955")], "name string, curr string, last string")
    upd = spark.createDataFrame([("job", "202401010950"), ("job", "202401011005")], "name string, cycle string")
    r = K.advance_breakpoint(state, upd).first()
    assert (r.curr, r.last) == ("202401011005", "202401011000")
    again = spark.createDataFrame([("job", "202401011000"), ("new", "1")], "name string, cycle string")
    got = {r.name: (r.curr, r.last) for r in K.advance_breakpoint(state, again).collect()}
    assert got == {"job": ("202401011000", "202401011000"), "new": ("1", None)}


def test_fits_broadcast_is_measured(spark):
    small = spark.range(10)
    assert J.fits_broadcast(small)
    assert not J.fits_broadcast(spark.range(1000), limit_bytes=64)


def test_rollup_period_adds_distinct_counts(spark):
    days = spark.createDataFrame([("2024-01-01", "u", 1, 1, 1, 1, 2), ("2024-01-02", "u", 1, 1, 1, 1, 3)],
                                 "cycle string, mdn string, upflow bigint, downflow bigint, sessions bigint, "
                                 "duration bigint, times bigint")
    from usagelens.operators import summaries as S
    out = S.rollup_period(days, F.substring("cycle", 1, 7), ["mdn"]).first()
    assert out.times == 5   # additive, as the reference


def test_open_close_classification(spark):
    op = spark.createDataFrame([
        ("1", "HLR", "open", "success", "P", "C"), ("1", "HSS", "open", "success", "P", "C"),
        ("2", "HLR", "open", "success", "P", "C"), ("3", "HSS", "close", "success", "P", "C"),
        ("4", "HLR", "open", "fail", "P", "C")],
        "mdn string, logtype string, opername string, oper_result string, custprovince string, vpdncompanycode string")
    got = {r.nettype: (r.opennum, r.closenum) for r in D.open_close(op).collect()}
    assert got == {"2/3/4G": (1, 0), "2/3G": (1, 0), "4G": (0, 1)}


def test_online_by_records_4g(spark):
    t = dt.datetime
    rec = spark.createDataFrame([
        ("1", "apn", t(2024, 1, 1, 9, 0), t(2024, 1, 1, 10, 30)),    # began before, ends within 2 h: online
        ("2", "apn", t(2024, 1, 1, 9, 0), t(2024, 1, 1, 13, 0)),     # ends later than 2 h
        ("3", "apn", t(2024, 1, 1, 10, 5), t(2024, 1, 1, 10, 30)),   # began after now
        ("1", "apn", t(2024, 1, 1, 8, 0), t(2024, 1, 1, 11, 0))],    # duplicate key
        "mdn string, apn string, starttime timestamp_ntz, stoptime timestamp_ntz")
    got = SS.online_by_records(rec, F.lit(t(2024, 1, 1, 10, 0)).cast("timestamp_ntz")).collect()
    assert [(r.mdn, r.apn) for r in got] == [("1", "apn")]


def test_rerun_slot_replaces_only_that_slot(spark, tmp_dir):
    import os
    from usagelens.streaming import ingest as ST
    path = os.path.join(tmp_dir, "summary")
    first = spark.createDataFrame([("240101", "00", 1), ("240101", "01", 2)], "d string, h string, n int")
    K.write_partitioned(first, path, ["d", "h"])
    recomputed = spark.createDataFrame([("240101", "00", 5), ("240101", "01", 99)], "d string, h string, n int")
    ST.rerun_slot(recomputed, (F.col("d") == "240101") & (F.col("h") == "00"), path, ["d", "h"])
    assert sorted((r.h, r.n) for r in spark.read.parquet(path).collect()) == [("00", 5), ("01", 2)]


def test_open_close_counts_pairs_without_materializing(spark):
    rows = ([("9", "HLR", "open", "success", "P", "C")] * 2 + [("9", "HSS", "open", "success", None, "C")] * 3
            + [("8", "HSS", "open", "success", "Q", "C")])
    op = spark.createDataFrame(rows, "mdn string, logtype string, opername string, oper_result string, "
                                     "custprovince string, vpdncompanycode string")
    got = {(r.custprovince, r.nettype): r.opennum for r in D.open_close(op).collect()}
    assert got == {("P", "2/3/4G"): 6, ("Q", "4G"): 1}   # 2 HLR × 3 HSS records, as the record join counts
