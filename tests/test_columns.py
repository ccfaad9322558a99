"""Column helpers (PRJ-*) on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from usagelens.functions import columns as C


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys())) if cols else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def test_vendor_result_and_attach(spark):
    df = spark.createDataFrame([("huawei", "0x0000", "0x18"), ("zte", "4294967295", "2102"),
                                ("ericsson", "nocausecode", "attach"), ("huawei", "0x0001", "0x01")],
                               ["v", "code", "proc"])
    got = df.select(C.vendor_result("v", "code").alias("r"), C.is_attach("v", "proc").alias("a")).collect()
    assert [(r.r, r.a) for r in got] == [("success", 1), ("success", 1), ("success", 1), ("failed", 0)]


def test_time_partition_and_quarter(spark):
    ts = dt.datetime(2024, 1, 2, 13, 59, 30)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    r = df.select(*[v.alias(k) for k, v in C.time_partition("t").items()], C.quarter_label("t").alias("q")).first()
    assert (r.d, r.h, r.m5, r.q) == ("240102", "13", "55", "00")


def test_bucket_ceil_boundary_is_own_bucket(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 30, 0),), (dt.datetime(2024, 1, 1, 0, 30, 1),)],
                               "t timestamp_ntz")
    got = [r.x for r in df.select(C.bucket_ceil("t", 1800).alias("x")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 30), dt.datetime(2024, 1, 1, 1, 0)]


def test_bucket_is_timezone_independent(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 9, 58),)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = df.select(C.bucket_floor("t", 300).alias("x")).first().x
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2024, 1, 1, 0, 5)


def test_defaults(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "c string")
    assert [r.x for r in df.select(C.default_if_blank("c", "-1").alias("x")).collect()] == ["-1", "-1", "x"]
    assert [r.x for r in df.select(C.default_if_null("c", "-").alias("x")).collect()] == ["-", "", "x"]


def test_text_transforms(spark):
    df = spark.createDataFrame([("861234567890123", "0x1A2B", "255", "user@vpdn.example", "abcdef",
                                 "00861390000", "2024-01-02 03:04:05")],
                               ["imei", "hexid", "dec", "nai", "s", "num", "ts"])
    r = df.select(C.tac_of("imei").alias("tac"), C.hex_to_dec("hexid").alias("h2d"),
                  C.dec_to_hex("dec").alias("d2h"), C.domain_of("nai").alias("dom"),
                  C.drop_last_n("s", 2).alias("dl"), C.normalize_number("num").alias("nn"),
                  C.section_key("num", 7).alias("sec"), C.digits_only("ts").alias("dig"),
                  C.extract_tag(F.lit("x;eNodeBId=4711;y"), r"eNodeBId=([0-9]+)").alias("tag"),
                  C.strip_words(F.lit("江苏省南京市"), ["省", "市"]).alias("sw")).first()
    assert r.tac == "86123456" and r.h2d == "6699" and r.d2h == "FF" and r.dom == "vpdn.example"
    assert r.dl == "abcd" and r.nn == "861390000" and r.sec == "0086139" and r.dig == "20240102030405"
    assert r.tag == "4711" and r.sw == "江苏南京"


def test_ratios_and_tiers(spark):
    df = spark.createDataFrame([(3, 4), (5, 4), (1, 0), (1, 3), (0, 0)], ["n", "d"])
    got = [tuple(r) for r in df.select(C.safe_ratio("n", "d").alias("s"), C.ratio_or_zero("n", "d").alias("z"),
                                       C.size_tier(F.col("n") * 300).alias("t")).collect()]
    assert got[0][0] == 0.75 and got[1][0] == 1.0 and got[2][0] == 0.0 and got[3][0] == 0.3333
    assert got[2][1] == 0.0 and got[0][1] == 0.75
    assert [g[2] for g in got] == ["B", "A", "B", "B", "C"]


def test_radius_result_and_service_type(spark):
    df = spark.createDataFrame([("Stop", "User-Request", "4g"), ("Stop", "7", "3g"), ("Stop", "99", "3g"),
                                ("Start", "1", "3g")], ["status", "cause", "net"])
    assert [r.x for r in df.select(C.radius_result("status", "cause", "net").alias("x")).collect()] == \
        ["s", "s", "f", " "]
    u = spark.createDataFrame([("1", "0", "a,b", "a"), ("0", "1", "a,b", "b"), ("0", "1", "a,b", "c"),
                               ("0", "0", "", "a")], ["d", "v", "doms", "dom"])
    assert [r.x for r in u.select(C.service_type("d", "v", "doms", "dom").alias("x")).collect()] == \
        ["D", "C", "P", "P"]


def test_lists_and_keys(spark):
    df = spark.createDataFrame([("k1", "a,b,a,", "1,2", "x,y")], ["k", "l", "p", "q"])
    assert sorted(r.l for r in C.explode_unique(df, "l").collect()) == ["a", "b"]
    assert [r.l for r in C.explode_csv(df, "l").collect()] == ["a", "b", "a", ""]
    assert [(r.p, r.q) for r in C.zip_explode(df, ["p", "q"]).collect()] == [("1", "x"), ("2", "y")]
    r = df.select(C.compose_key("k", "p", F.lit("0915")).alias("key")).first()
    assert r.key == "k1_1,2_0915"
    parts = df.select(*C.split_key(F.lit("c1_d_dom_0915"), ["c", "s", "rest"])).first()
    assert tuple(parts) == ("c1", "d", "dom_0915")


def test_time_text(spark):
    df = spark.createDataFrame([("20240102030405", "2024-01-03")], ["t", "d"])
    r = df.select(C.shift_time("t", "yyyyMMddHHmmss", 3600).alias("s"),
                  C.time_interval(F.lit("20240102000000"), "t", "yyyyMMddHHmmss").alias("i"),
                  *[v.alias(k) for k, v in C.week_bounds("d").items()],
                  *[v.alias(k) for k, v in C.month_bounds("d").items()]).first()
    assert r.s == "20240102040405" and r.i == 3 * 3600 + 4 * 60 + 5
    assert r.dow == 3 and str(r.week_first) == "2024-01-01" and str(r.week_last) == "2024-01-07"
    assert r.dom == 3 and str(r.month_first) == "2024-01-01" and str(r.month_last) == "2024-01-31"


def test_fingerprint_tolerates_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    fps = [r.f for r in df.select(C.row_fingerprint(["x", "y"]).alias("f")).collect()]
    assert fps[0] is not None and fps[0] != fps[1]


def test_predicates(spark):
    from usagelens.functions import predicates as P
    df = spark.createDataFrame([("240101", "00", "ctnb.a", "115.170.14.2", 0, None),
                                ("240101", "01", "psma.x", "115.170.15.9", 3, "-1"),
                                ("240102", "00", "", "10.0.0.1", 5, "d1")],
                               "d string, h string, apn string, gw string, v int, dom string")
    def ids(cond):
        return [r.v for r in df.where(cond).collect()]
    assert ids(P.partition_is({"d": "240101", "h": "00"})) == [0]
    assert ids(P.half_open("v", 0, 5)) == [0, 3]
    assert ids(P.in_set("h", ["01"])) == [3]
    assert ids(P.has_prefix("gw", ["115.170.14.", "115.170.15."])) == [0, 3]
    assert ids(P.matches("apn", r"^ctnb")) == [0] and ids(P.matches("apn", r"^ctnb", negate=True)) == [3, 5]
    assert ids(P.not_blank("apn")) == [0, 3] and ids(P.nonzero("v")) == [3, 5]
    assert ids(P.having("v", ">", 2)) == [3, 5] and ids(P.not_sentinel_group("dom")) == [0, 5]


def test_misc_helpers(spark):
    df = spark.createDataFrame([("2024-01-01 23:59:00", 120, "1", "x", "y")], "t string, dur int, c string, a string, b string")
    df = df.withColumn("t", F.to_timestamp_ntz("t"))
    r = df.select(C.stop_time("t", "dur").alias("stop"), C.decode("c", {"1": "3G", "2": "4G"}, "-").alias("net"),
                  C.default_via_if(F.col("c") == "1", "a", "b").alias("pick"),
                  C.bytes_to_gb(F.lit(3 * 1024 ** 3)).alias("gb"), C.avg_per_user(F.lit(7), F.lit(2)).alias("avg")).first()
    assert str(r.stop) == "2024-01-02 00:01:00" and r.net == "3G" and r.pick == "x" and r.gb == 3.0 and r.avg == 4.0
    t = C.tag(df, cycle="202401", dim_type="BS").first()
    assert t.cycle == "202401" and t.dim_type == "BS"
    pos = spark.createDataFrame([("1", "a")], "T0 string, T1 string")
    assert C.rename_positional(pos, {"T0": "mdn", "T1": "apn"}).columns == ["mdn", "apn"]
    assert dict(C.cast_all(spark.createDataFrame([(1, 2.5)], "a int, b double")).dtypes) == {"a": "string", "b": "string"}
