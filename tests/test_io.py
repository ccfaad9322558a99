"""Sources and sinks: write → read round trips and re-run idempotence."""

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from usagelens.sources import readers as R
from usagelens.sources import sinks as K


def _slots(spark):
    return spark.createDataFrame([("240101", "00", "05", 1), ("240101", "00", "10", 2), ("240101", "01", "00", 3),
                                  ("240102", "00", "00", 4)], "d string, h string, m5 string, v int")


def test_partitioned_write_is_idempotent_and_pruned(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    K.write_partitioned(_slots(spark), path, ["d", "h", "m5"])
    # re-run of one slot with new content replaces only that slot
    K.write_partition(spark.createDataFrame([(9,)], "v int"), path, {"d": "240101", "h": "00", "m5": "05"})
    got = sorted((r.d, r.h, r.m5, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("240101", "00", "05", 9), ("240101", "00", "10", 2), ("240101", "01", "00", 3),
                   ("240102", "00", "00", 4)]
    one = R.scan_partition(spark, path, d="240101", h="00")
    assert sorted(r.v for r in one.collect()) == [2, 9]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "240101" in plan
    rng = R.scan_range(spark, path, "d", "240101", "240101")
    assert rng.count() == 3
    both = R.scan_with_base(spark, path, ["d=240101/h=01", "d=240102"])
    assert sorted(r.v for r in both.collect()) == [3, 4] and "d" in both.columns


def test_load_id_keeps_other_loads(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([("240101", 1)], "d string, v int")
    K.write_partitioned(df, path, ["d"], load_id="a")
    K.write_partitioned(df.withColumn("v", F.lit(2)), path, ["d"], load_id="b")
    K.write_partitioned(df.withColumn("v", F.lit(3)), path, ["d"], load_id="a")
    assert sorted((r.load_id, r.v) for r in spark.read.parquet(path).collect()) == [("a", 3), ("b", 2)]


def test_delimited_with_header_malformed_and_gbk(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dim.txt")
    text = "enbid|prov|city\n1|江苏|南京\nbroken line\n2|江苏|无锡|extra\n3|浙江|杭州\n"
    with open(p, "wb") as f:
        f.write(text.encode("gbk"))
    df = R.scan_delimited(spark, p, "|", ["enbid", "prov", "city"], header_first_field="enbid", charset="GBK")
    assert sorted(tuple(r) for r in df.collect()) == [("1", "江苏", "南京"), ("3", "浙江", "杭州")]


def test_encoded_json(spark, tmp_dir):
    p = os.path.join(tmp_dir, "log.json")
    with open(p, "wb") as f:
        f.write('{"mdn": "1", "city": "南京"}\nnot json\n'.encode("gbk"))
    schema = StructType([StructField("mdn", StringType()), StructField("city", StringType())])
    df = R.scan_encoded(spark, p, "GBK", fmt="json", schema=schema)
    assert [tuple(r) for r in df.collect()] == [("1", "南京")]


def test_scan_json_and_optional(spark, tmp_dir):
    p = os.path.join(tmp_dir, "j")
    spark.createDataFrame([("1", "a")], "x string, y string").write.json(p)
    schema = StructType([StructField("x", StringType()), StructField("y", StringType())])
    assert R.scan_json(spark, p, schema).count() == 1
    missing = R.scan_optional(spark, os.path.join(tmp_dir, "nope"), schema)
    assert missing.count() == 0 and missing.columns == ["x", "y"]


def test_multi_vendor_skips_missing(spark, tmp_dir):
    a = os.path.join(tmp_dir, "hw.txt")
    with open(a, "w") as f:
        f.write("1,0x0000\n")
    specs = [(a, lambda l: R.parse_delimited(l, ",", ["mdn", "code"]).withColumn("vendor", F.lit("huawei"))),
             (os.path.join(tmp_dir, "zte*.txt"), lambda l: R.parse_delimited(l, "\t", ["mdn", "code"]))]
    df = R.scan_multi_vendor(spark, specs)
    assert [tuple(r) for r in df.collect()] == [("1", "0x0000", "huawei")]


def test_upsert_and_exports(spark, tmp_dir):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(tuple(r) for r in K.upsert(old, new, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "c")]
    K.write_csv(new, os.path.join(tmp_dir, "csv"), single_file=True)
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "csv")).count() == 2
    K.write_json(new, os.path.join(tmp_dir, "json"))
    assert spark.read.json(os.path.join(tmp_dir, "json")).count() == 2
    K.write_text(new.withColumn("p", F.lit("x")), os.path.join(tmp_dir, "txt"), ["k", "v"], "|", "p")
    assert sorted(r.value for r in spark.read.text(os.path.join(tmp_dir, "txt", "p=x")).collect()) == ["2|B", "3|c"]


def test_keyed_rows_and_range_scan(spark, tmp_dir):
    t = dt.datetime
    df = spark.createDataFrame([("c1", t(2024, 1, 1, 0, 0), 1.0), ("c1", t(2024, 1, 1, 0, 5), 2.0)],
                               "company string, slot timestamp_ntz, flow double")
    rows = K.keyed_rows(df, ["company"], "slot", ["flow"])
    p = os.path.join(tmp_dir, "keyed")
    rows.sortWithinPartitions("rowkey").write.parquet(p)
    got = R.scan_keyed(spark, p, "c1_202401010005", "c1_202401010010", ["company", "ts"])
    kinds = sorted((r.kind, r.value) for r in got.collect())
    assert kinds == [("c", 2.0), ("d", 3.0), ("p", 1.0)]   # current, running day total, previous slot


def test_compact_file_count(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    spark.range(0, 1000, numPartitions=20).write.parquet(src)
    n = K.compact(spark, src, out, target_bytes=1 << 30)
    assert n == 1
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == 1
    assert spark.read.parquet(out).count() == 1000


def test_geo_series_load(spark, tmp_dir):
    p = os.path.join(tmp_dir, "fc.csv")
    with open(p, "w") as f:
        f.write("id,custid,prov,city,num,low,high,fcst\n1,c1,JS,NJ,10,8,12,11\nbad,line\n")
    out = R.geo_series_load(spark, p, "forecast", "province", "202401010000")
    got = sorted((r.measure, r.value, r.city) for r in out.collect())
    assert got == [("fcst", 11.0, "-"), ("high", 12.0, "-"), ("low", 8.0, "-"), ("num", 10.0, "-")]


def test_catalog_table_insert_and_scan(spark, tmp_dir):
    name = f"slots_{os.path.basename(tmp_dir).replace('-', '_')}"
    base = _slots(spark)
    base.write.option("path", os.path.join(tmp_dir, "tbl")).partitionBy("d").saveAsTable(name)
    try:
        K.insert_into_table(spark.createDataFrame([("02", "00", 7, "240103")], "h string, m5 string, v int, d string"),
                            name)
        assert R.scan_table(spark, name, F.col("d") == "240103").count() == 1
        assert R.scan_table(spark, name).count() == 5
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_compact_partitioned_keeps_layout(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "psrc"), os.path.join(tmp_dir, "pout")
    spark.range(0, 2000, numPartitions=10).withColumn("d", (F.col("id") % 2).cast("string")) \
        .write.partitionBy("d").parquet(src)
    cap = K.compact(spark, src, out, target_bytes=1 << 30, partition_cols=["d"])
    assert cap >= 2000
    back = spark.read.parquet(out)
    assert back.count() == 2000 and sorted(r.d for r in back.select("d").distinct().collect()) == ["0", "1"]


def test_gbk_lines_keep_blank_lines_and_control_bytes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "gbk.txt")
    lines = ["ab\x01cd", "", "中国|电信", ' "quoted" ']
    with open(path, "wb") as f:
        f.write("\n".join(lines).encode("gbk") + b"\n")
    assert [r.value for r in R.scan_lines(spark, path, "GBK").collect()] == lines
    with pytest.raises(ValueError):
        R.scan_lines(spark, path, "UTF-16")


def test_first_line_as_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h.txt")
    with open(path, "w") as f:
        f.write("id,name\n1,a\nid,name\n2,b\n")
    got = R.scan_delimited(spark, path, ",", ["id", "name"], first_line_is_header=True)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "a"), ("2", "b")]


def test_broken_vendor_input_is_an_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "v.txt")
    with open(path, "w") as f:
        f.write("x\n")
    keep = lambda df: df
    assert R.scan_multi_vendor(spark, [(path, keep), (path + "-missing", keep)]).count() == 1
    with pytest.raises(AnalysisException):
        R.scan_multi_vendor(spark, [(path, lambda df: df.select("nothing"))])


def test_events_stream_reads_a_file_or_a_folder(spark, tmp_dir):
    from usagelens.plans import inputs as I
    source = "/root/testdata/sf0.001/events.parquet"
    n = spark.read.parquet(source).count()
    spark.read.parquet(source).repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    for k, sf in enumerate([tmp_dir, "/root/testdata/sf0.001"]):
        q = (I.event_stream(spark, sf).writeStream.format("memory").queryName(f"events_{k}")
             .option("checkpointLocation", f"{tmp_dir}/ckpt-{k}").trigger(availableNow=True).start())
        q.awaitTermination()
        assert spark.table(f"events_{k}").count() == n


def test_shared_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    from usagelens.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
