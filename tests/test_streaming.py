"""Structured Streaming jobs on file sources, run to completion with availableNow."""

import datetime as dt
import json
import os
import uuid

from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from usagelens.sources import readers as R
from usagelens.streaming import ingest as S


def _write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_parse_radius_defaults_and_drops(spark):
    msgs = spark.createDataFrame([
        (json.dumps({"MDN": "1", "Status": "Start", "StartTime": "2024-01-02 03:04:05"}),),
        (json.dumps({"MDN": "2", "Status": "Stop", "StopTime": "bad"}),),
        ("[1, 2]",), ("not json",)], "value string")
    got = sorted((r.MDN, r.APN, r.time, r.dayid) for r in S.parse_radius(msgs).collect())
    assert got == [("1", "-1", "20240102030405", "20240102"), ("2", "-1", "-1", "-1")]


def test_ingest_to_day_partitions(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    _write_lines(os.path.join(src, "a.txt"), [
        json.dumps({"MDN": "1", "Status": "Start", "StartTime": "20240102030405"}),
        json.dumps({"MDN": "2", "Status": "Stop", "StopTime": "20240103000000"})])
    out = os.path.join(tmp_dir, "out")
    q = S.ingest_to_partitions(S.parse_radius(R.text_stream(spark, src)), out, f"ingest_{uuid.uuid4().hex[:6]}",
                               available_now=True)
    q.awaitTermination()
    got = sorted((r.MDN, r.dayid) for r in spark.read.parquet(out).collect())
    assert got == [("1", "20240102"), ("2", "20240103")]


def test_late_row_beyond_watermark_is_dropped(spark, tmp_dir):
    schema = StructType([StructField("ts", TimestampNTZType()), StructField("k", StringType()),
                         StructField("v", LongType())])
    src = os.path.join(tmp_dir, "ev")
    t = dt.datetime
    spark.createDataFrame([(t(2024, 1, 1, 0, 1), "a", 1), (t(2024, 1, 1, 1, 0), "a", 2)], schema) \
        .coalesce(1).write.parquet(os.path.join(src, "f1"))
    spark.createDataFrame([(t(2024, 1, 1, 1, 1), "a", 3)], schema).coalesce(1).write.parquet(os.path.join(src, "f2"))
    # a later batch brings a row 59 minutes behind the newest event: beyond the 10-minute
    # watermark that the previous batches established
    spark.createDataFrame([(t(2024, 1, 1, 0, 2), "a", 100)], schema).coalesce(1).write.parquet(os.path.join(src, "f3"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    agg = S.window_summary(stream, "ts", ["k"], "v", "5 minutes", "10 minutes")
    out = os.path.join(tmp_dir, "rows")
    q = S.upsert_batches(agg, out, f"late_{uuid.uuid4().hex[:6]}", ["window_start", "window_end", "k"])
    q.awaitTermination()
    got = {r.window_start.strftime("%H:%M"): r.total
           for r in S.latest_versions(spark, out, ["window_start", "window_end", "k"]).collect()}
    assert got == {"00:00": 1, "01:00": 5}   # the late 100 never reopened 00:00


def test_word_count_complete(spark, tmp_dir):
    src = os.path.join(tmp_dir, "words")
    _write_lines(os.path.join(src, "a.txt"), ["a b a", "c"])
    q = (S.word_count(R.text_stream(spark, src)).writeStream.outputMode("complete").format("memory")
         .queryName(f"wc_{uuid.uuid4().hex[:6]}").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.word: r["count"] for r in spark.sql(f"SELECT * FROM {q.name}").collect()}
    assert got == {"a": 2, "b": 1, "c": 1}


def test_running_online_matches_batch(spark, tmp_dir):
    schema = StructType([StructField("key", StringType()), StructField("status", StringType())])
    src = os.path.join(tmp_dir, "st")
    rows = [("k1", "Start"), ("k1", "Start"), ("k1", "Stop"), ("k2", "Stop"), ("k2", "Interim")]
    spark.createDataFrame(rows, schema).write.parquet(src)
    out = os.path.join(tmp_dir, "online")
    q = S.upsert_batches(S.running_online(spark.readStream.schema(schema).parquet(src), ["key"]), out,
                         f"online_{uuid.uuid4().hex[:6]}", ["key"])
    q.awaitTermination()
    got = {r.key: r.online_delta for r in S.latest_versions(spark, out, ["key"]).collect()}
    assert got == {"k1": 1, "k2": -1}


def test_track_sessions_across_batches(spark, tmp_dir):
    schema = StructType([StructField("mdn", LongType()), StructField("session_id", StringType()),
                         StructField("status", StringType()), StructField("time", TimestampNTZType()),
                         StructField("enbid", LongType()), StructField("net", StringType())])
    src = os.path.join(tmp_dir, "sess")
    t = dt.datetime
    spark.createDataFrame([(1, "a", "Start", t(2024, 1, 1, 0, 0), 10, "3g"),
                           (2, "b", "Start", t(2024, 1, 1, 0, 0), 20, "4g")], schema) \
        .coalesce(1).write.parquet(os.path.join(src, "f1"))
    spark.createDataFrame([(1, "a", "Stop", t(2024, 1, 1, 0, 30), 11, "3g"),
                           (2, "b", "Interim", t(2024, 1, 1, 0, 40), 21, "4g")], schema) \
        .coalesce(1).write.parquet(os.path.join(src, "f2"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    out = os.path.join(tmp_dir, "rows")
    q = S.upsert_batches(S.track_sessions(stream), out, f"sess_{uuid.uuid4().hex[:6]}", ["mdn", "session_id"])
    q.awaitTermination()
    got = {r.session_id: (r.is_open, r.enbid) for r in S.latest_versions(spark, out, ["mdn", "session_id"]).collect()}
    assert got == {"a": (False, 10), "b": (True, 21)}
