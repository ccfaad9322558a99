"""Round trips of the given tables through the sinks and sources (SRC, SNK, ST).

Each query writes a whole table into the scratch folder with a sink, reads it back with a
source, and reports what came back; the oracle computes the same from the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import columns as C
from ..functions import predicates as P
from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks as K
from ..streaming import ingest as ST
from . import inputs as I
from .catalog import oracle, register


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"io-{name}-{uuid.uuid4().hex}")


def _day_totals(df):
    return df.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("bigint").alias("ids"),
                               F.count_distinct("event_type").alias("types"))


_DAYS_SQL = """
SELECT strftime(ts, '%Y%m%d') AS d, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids,
       count(DISTINCT event_type) AS types FROM events GROUP BY 1"""


def _events(spark, sf_dir):
    return I.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type",
                                                   F.date_format("ts", "yyyyMMdd").alias("d"))


@register("io_partitioned", _DAYS_SQL)
def q_io_partitioned(spark, sf_dir):
    """SNK-2/7 then SRC-2: written twice under one load id (the re-run replaces the first
    run), read back over the whole day range."""
    path = _folder(spark, "partitioned")
    for _ in range(2):
        K.write_partitioned(_events(spark, sf_dir), path, ["d"], load_id="l1")
    return _day_totals(R.scan_range(spark, path, "d", "00000000", "99999999"))


@register("io_delimited", _DAYS_SQL)
def q_io_delimited(spark, sf_dir):
    """SNK-5 then SRC-6/8: delimited lines of the table, split and cast again."""
    path = _folder(spark, "delimited")
    K.write_text(_events(spark, sf_dir), path, ["event_id", "user_id", "event_type", "d"])
    back = R.scan_delimited(spark, path, "|", ["event_id", "user_id", "event_type", "d"])
    return _day_totals(back.withColumn("event_id", F.col("event_id").cast("bigint")))


@register("io_json", _DAYS_SQL)
def q_io_json(spark, sf_dir):
    """SNK-4 then SRC-4: JSON lines read with an explicit schema."""
    path = _folder(spark, "json")
    K.write_json(_events(spark, sf_dir), path)
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("event_type", StringType()), StructField("d", StringType())])
    return _day_totals(R.scan_json(spark, path, schema))


@register("io_compact", _DAYS_SQL)
def q_io_compact(spark, sf_dir):
    """SNK-11: many small files rewritten into few; SRC-12 reads them."""
    path = _folder(spark, "small")
    events = _events(spark, sf_dir)
    events.repartition(16).write.parquet(path)
    K.compact(spark, path, f"{path}-compact")
    return _day_totals(R.scan_optional(spark, f"{path}-compact", events.schema))


@register("io_upsert", """
SELECT event_type, count(*) AS n, count(CASE WHEN newer THEN 1 END) AS replaced FROM (
  SELECT event_type, event_type = 'error' AS newer FROM events) GROUP BY 1""")
def q_io_upsert(spark, sf_dir):
    """SNK-6: the error events arrive again and replace their stored rows."""
    stored = _events(spark, sf_dir).withColumn("newer", F.lit(False))
    again = stored.where(F.col("event_type") == "error").withColumn("newer", F.lit(True))
    path = _folder(spark, "upsert")
    K.upsert(stored, again, ["event_id"]).write.parquet(path)
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("newer"), 1)).alias("replaced"))


@register("io_keyed", """
WITH h AS (SELECT event_type AS kind_key, date_trunc('hour', ts) AS slot, count(*) AS n FROM events GROUP BY 1, 2),
r AS (
  SELECT kind_key, slot, 'c' AS kind, n FROM h
  UNION ALL SELECT kind_key, slot + INTERVAL 1 HOUR, 'p', n FROM h
  UNION ALL SELECT kind_key, slot, 'd', sum(n) OVER (PARTITION BY kind_key, CAST(slot AS DATE) ORDER BY slot) FROM h)
SELECT kind_key, strftime(slot, '%Y%m%d%H%M') AS slot, kind, CAST(n AS DOUBLE) AS value FROM r
WHERE kind_key || '_' || strftime(slot, '%Y%m%d%H%M') >= 'a' AND kind_key || '_' || strftime(slot, '%Y%m%d%H%M') < 'z'""")
def q_io_keyed(spark, sf_dir):
    """SNK-8 then SRC-11: hourly counters as keyed rows, scanned by key range and split."""
    ev = I.table(spark, sf_dir, "events")
    hourly = ev.groupBy(F.col("event_type").alias("kind_key"), F.date_trunc("hour", "ts").cast("timestamp_ntz")
                        .alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    path = _folder(spark, "keyed")
    K.keyed_rows(hourly, ["kind_key"], "slot", ["n"], slot_seconds=3600).select(
        "rowkey", "kind", "value").write.parquet(path)
    return R.scan_keyed(spark, path, "a", "z", ["kind_key", "slot"]).select("kind_key", "slot", "kind", "value")


@register("io_replace_where", """
SELECT strftime(ts, '%Y%m%d') AS d, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids,
       count(CASE WHEN event_type = 'error' AND value >= 1 THEN 1 END) AS corrected
FROM events WHERE NOT (event_type = 'error' AND value < 1) GROUP BY 1""")
def q_io_replace_where(spark, sf_dir):
    """SNK-7: the stored failures are replaced by a corrected list (those below 1 are taken
    back), twice; days without failures keep their files."""
    path = _folder(spark, "replace")
    ev = I.table(spark, sf_dir, "events").select("event_id", "event_type", "value",
                                                 F.date_format("ts", "yyyyMMdd").alias("d"),
                                                 F.lit(False).alias("corrected"))
    K.write_partitioned(ev, path, ["d"])
    failures = F.col("event_type") == "error"
    new = ev.where(failures & (F.col("value") >= 1)).withColumn("corrected", F.lit(True))
    for _ in range(2):
        K.replace_where(new, path, failures, ["d"])
    return R.scan_range(spark, path, "d", "00000000", "99999999").groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("bigint").alias("ids"),
        F.count(F.when(F.col("corrected"), 1)).alias("corrected"))


@register("io_compact_partitions", """
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, true AS planned_files
FROM events GROUP BY 1""")
def q_io_compact_partitions(spark, sf_dir):
    """SNK-11: a table of many small files in partitions of unlike size; every partition ends
    with ceil(bytes / target) files."""
    path, target = _folder(spark, "fragments"), 40_000
    ev = I.table(spark, sf_dir, "events")
    ev.repartition(12).write.partitionBy("event_type").parquet(path)
    K.compact(spark, path, f"{path}-compact", target_bytes=target, partition_cols=["event_type"])

    def files(folder):
        return spark.read.format("binaryFile").load(folder).groupBy("event_type").agg(
            F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))

    planned = files(path).select("event_type", F.ceil(F.col("bytes") / target).alias("planned"))
    met = files(f"{path}-compact").join(planned, "event_type").select(
        "event_type", (F.col("files") == F.col("planned")).alias("planned_files"))
    rows = spark.read.parquet(f"{path}-compact").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("bigint").alias("ids"))
    return rows.join(met, "event_type").select("event_type", "n", "ids", "planned_files")


@register("io_breakpoint", """
WITH seen AS (SELECT DISTINCT event_type AS name, strftime(ts, '%Y%m%d%H%M') AS cycle FROM events),
placed AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY cycle DESC) AS k FROM seen)
SELECT name, max(CASE WHEN k = 1 THEN cycle END) AS curr, max(CASE WHEN k = 2 THEN cycle END) AS last
FROM placed WHERE k <= 2 GROUP BY 1""")
def q_io_breakpoint(spark, sf_dir):
    """SNK-12: the cycles of all events advance the kept breakpoints in random order, each step
    twice."""
    path = _folder(spark, "breakpoints")
    ev = I.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"), F.date_format("ts", "yyyyMMddHHmm").alias("cycle")).distinct()
    steps = 4
    dealt = ev.withColumn("step", F.pmod(F.xxhash64("name", "cycle"), F.lit(steps)))
    for step in range(steps):
        for _ in range(2):
            K.advance_stored_breakpoint(dealt.where(F.col("step") == step).drop("step"), path, step)
    return K.stored_breakpoints(spark, path)


# Lines with letters of the charset, control characters, and blank ones.
_GBK_LINE = ["事件|", "|状态\t", "|\x07\x1f结束 "]


@register("io_gbk", f"""
SELECT CASE WHEN event_type = 'view' THEN '' ELSE '{_GBK_LINE[0]}' || event_type || '|状态' || chr(9) ||
       CAST(user_id AS VARCHAR) || '|' || chr(7) || chr(31) || '结束 ' END AS line, count(*) AS n
FROM events GROUP BY 1""")
def q_io_gbk(spark, sf_dir):
    """SRC-5: every event as a line, written as GBK and read back unchanged."""
    path = _folder(spark, "gbk")
    ev = I.table(spark, sf_dir, "events")
    line = F.concat(F.lit(_GBK_LINE[0]), F.col("event_type"), F.lit(_GBK_LINE[1]),
                    F.col("user_id").cast("string"), F.lit(_GBK_LINE[2]))
    K.write_encoded(ev.select(F.when(F.col("event_type") == "view", F.lit("")).otherwise(line).alias("value")),
                    path, "GBK")
    return R.scan_encoded(spark, path, "GBK").groupBy(F.col("value").alias("line")).agg(
        F.count(F.lit(1)).alias("n"))


@register("io_dropped_lines", """
WITH f AS (SELECT CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 5 ELSE 4 END AS n FROM events)
SELECT count(*) AS lines, count(CASE WHEN n = 4 THEN 1 END) AS kept, count(CASE WHEN n <> 4 THEN 1 END) AS dropped,
       count(CASE WHEN n < 4 THEN 1 END) AS short, count(CASE WHEN n > 4 THEN 1 END) AS long,
       (SELECT CAST(sum(event_id) AS BIGINT) FROM events WHERE event_type NOT IN ('error', 'view')) AS kept_ids
FROM f""")
def q_io_dropped_lines(spark, sf_dir):
    """SRC-8: a table written with damaged lines (error events lack fields, view events have one
    too many) is read and accounted for in one pass."""
    path = _folder(spark, "damaged")
    ev = _events(spark, sf_dir)
    key, rest = F.col("event_id").cast("string"), F.col("event_type")
    line = (F.when(rest == "error", F.concat_ws("|", key, rest))
            .when(rest == "view", F.concat_ws("|", key, F.col("user_id").cast("string"), rest, "d", F.lit("x")))
            .otherwise(F.concat_ws("|", key, F.col("user_id").cast("string"), rest, "d")))
    ev.select(line.alias("value")).write.text(f"{path}/lines")
    seen = Observation("lines")
    rows = R.scan_delimited_observed(spark, f"{path}/lines", "|", ["event_id", "user_id", "event_type", "d"], seen)
    rows.write.parquet(f"{path}/rows")
    ids = spark.read.parquet(f"{path}/rows").agg(F.sum(F.col("event_id").cast("bigint")).alias("kept_ids"))
    return ids.select(*[F.lit(seen.get[c]).cast("bigint").alias(c)
                        for c in ("lines", "kept", "dropped", "short", "long")], "kept_ids")


def _vendor_record(msisdn, start, station, code) -> Column:
    return F.struct(msisdn.alias("msisdn"), start.alias("starttime"), station.alias("enbid"), code.alias("pcause"))


def _huawei_line(value: Column) -> Column:
    """msisdn|time|0x-station|code"""
    p = F.split(value, "\\|", -1)
    return F.when(F.size(p) == 4, _vendor_record(p[0], p[1], C.hex_to_dec(p[2]), p[3]))


def _zte_line(value: Column) -> Column:
    """A JSON object."""
    r = F.from_json(value, "num string, at string, bs string, cc string")
    return F.when(F.json_object_keys(value).isNotNull(), _vendor_record(r["num"], r["at"], r["bs"], r["cc"]))


def _ericsson_line(value: Column) -> Column:
    """code,station,time,msisdn"""
    p = F.split(value, ",", -1)
    return F.when(F.size(p) == 4, _vendor_record(p[3], p[2], p[1], p[0]))


@register("io_vendors", oracle(("raw_mme_log",), body="""
SELECT vendor, T0 AS msisdn, T1 AS starttime,
       CASE WHEN vendor = 'huawei' THEN CAST(CAST(('0x' || substr(T12, 3)) AS BIGINT) AS VARCHAR) ELSE T12 END AS enbid,
       T13 AS pcause
FROM raw_mme_log"""))
def q_io_vendors(spark, sf_dir):
    """SRC-13: raw logs of three vendors, each in its own form and folder, in one scan."""
    path = _folder(spark, "vendors")
    raw = I.raw_mme_log(spark, sf_dir)
    forms = {"huawei": F.concat_ws("|", "T0", "T1", "T12", "T13"),
             "zte": F.to_json(F.struct(F.col("T0").alias("num"), F.col("T1").alias("at"), F.col("T12").alias("bs"),
                                       F.col("T13").alias("cc"))),
             "ericsson": F.concat_ws(",", "T13", "T12", "T1", "T0")}
    for vendor, line in forms.items():
        raw.where(F.col("vendor") == vendor).select(line.alias("value")).write.text(f"{path}/{vendor}_mm")
    parsers = {"huawei": _huawei_line, "zte": _zte_line, "ericsson": _ericsson_line}
    named = {f"/{v}_": _labelled(parse, v) for v, parse in parsers.items()}
    return R.scan_vendors(spark, path, named)


def _labelled(parse, vendor: str):
    """The parser's record with the vendor's name."""
    def run(value: Column) -> Column:
        r = parse(value)
        fields = ("msisdn", "starttime", "enbid", "pcause")
        return F.when(r.isNotNull(), F.struct(F.lit(vendor).alias("vendor"), *[r[f].alias(f) for f in fields]))
    return run


@register("stream_radius_ingest", oracle(("session_events",), body="""
SELECT strftime(time, '%Y%m%d') AS dayid, status, count(*) AS n, count(DISTINCT mdn) AS users,
       count(CASE WHEN net IS NULL THEN 1 END) AS no_net FROM session_events GROUP BY 1, 2"""))
def q_stream_radius_ingest(spark, sf_dir):
    """ST-1/2/3/4/5 over SRC-15: session events as JSON messages in a folder, parsed with
    defaults, landed once in day partitions."""
    ev = I.session_events(spark, sf_dir)
    when = F.date_format("time", "yyyyMMddHHmmss")
    start = F.col("status") == "Start"
    message = F.to_json(F.struct(
        F.col("mdn").cast("string").alias("MDN"), F.col("net").alias("NetType"), F.col("status").alias("Status"),
        F.when(start, when).alias("StartTime"), F.when(~start, when).alias("StopTime"),
        F.col("session_id").alias("SessionID")))
    source, target = _folder(spark, "messages"), _folder(spark, "landed")
    ev.select(message.alias("value")).write.text(source)
    lines = R.text_stream(spark, source)
    q = ST.ingest_to_partitions(ST.parse_radius(lines), target, f"radius_{uuid.uuid4().hex[:8]}", available_now=True)
    q.awaitTermination()
    back = R.scan_range(spark, target, "dayid", "0", "99999999")
    return back.select(F.col("dayid").cast("string").alias("dayid"), F.col("Status").alias("status"), "MDN",
                       "NetType").groupBy("dayid", "status").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("MDN").alias("users"),
        F.count(F.when(F.col("NetType") == ST.MISSING, 1)).alias("no_net"))


@register("column_helpers", """
SELECT o_orderkey, printf('%X', o_orderkey) AS hex_key,
       left(CAST(o_orderkey AS VARCHAR) || 'xy', length(CAST(o_orderkey AS VARCHAR))) AS dropped,
       substr(lpad(CAST(o_custkey AS VARCHAR), 11, '1'), 1, 9) AS section,
       CASE WHEN o_custkey % 7 = 0 THEN 0.0 ELSE CAST(o_orderkey AS DOUBLE) / (o_custkey % 7) END AS ratio
FROM orders""")
def q_column_helpers(spark, sf_dir):
    """PRJ-13, 15, 17, 26 over every order."""
    o = I.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.select("o_orderkey", C.dec_to_hex("o_orderkey").alias("hex_key"),
                    C.drop_last_n(F.concat(F.col("o_orderkey").cast("string"), F.lit("xy")), 2).alias("dropped"),
                    C.section_key(F.lpad(F.col("o_custkey").cast("string"), 11, "1")).alias("section"),
                    C.ratio_or_zero(F.col("o_orderkey"), F.col("o_custkey") % 7).alias("ratio"))


@register("io_slot", """
WITH first AS (SELECT min(ts) AS t FROM events)
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events, first
WHERE strftime(ts, '%Y%m%d%H') = strftime(t, '%Y%m%d%H') GROUP BY 1""")
def q_io_slot(spark, sf_dir):
    """SNK-1 then SRC-1/FLT-1: the table in day and hour partitions, its first slot written once
    more as one partition, and only that slot read."""
    path = _folder(spark, "slots")
    ev = I.table(spark, sf_dir, "events").select("event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("d"),
                                                 F.date_format("ts", "HH").alias("h"))
    K.write_partitioned(ev, path, ["d", "h"])
    slot = ev.agg(F.min(F.struct("d", "h")).alias("s")).select("s.*").first().asDict()
    K.write_partition(ev.where(P.partition_is(slot)).drop(*slot), path, slot)
    return R.scan_partition(spark, path, **slot).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("bigint").alias("ids"))


@register("io_subpaths", """
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
WHERE event_type IN ('error', 'view') GROUP BY 1""")
def q_io_subpaths(spark, sf_dir):
    """SRC-3: two sub-paths of a partitioned table, with their partition column."""
    path = _folder(spark, "subpaths")
    K.write_partitioned(I.table(spark, sf_dir, "events").select("event_id", "event_type"), path, ["event_type"])
    return R.scan_with_base(spark, path, ["event_type=error", "event_type=view"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("bigint").alias("ids"))


@register("io_csv", """
SELECT n_regionkey AS region, count(*) AS n, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1""")
def q_io_csv(spark, sf_dir):
    """SNK-3 then SRC-6/7: a report exported with a header in one file, and read without it."""
    path = _folder(spark, "csv")
    K.write_csv(I.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), path, single_file=True)
    back = R.scan_delimited(spark, path, ",", ["n_nationkey", "n_name", "n_regionkey"], first_line_is_header=True)
    return back.groupBy(F.col("n_regionkey").cast("int").alias("region")).agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"))


@register("io_table", _DAYS_SQL)
def q_io_table(spark, sf_dir):
    """SNK-9 then SRC-9: rows appended to a partitioned catalog table, their days overwritten by
    the same rows, and the table read with a predicate."""
    path, table = _folder(spark, "table"), f"io_table_{uuid.uuid4().hex[:8]}"
    ev = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "d")
    spark.sql(f"CREATE TABLE {table} (event_id BIGINT, user_id BIGINT, event_type STRING, d STRING) "
              f"USING parquet PARTITIONED BY (d) LOCATION '{path}'")
    for overwrite in (False, True):
        K.insert_into_table(ev, table, overwrite=overwrite)
    return _day_totals(R.scan_table(spark, table, F.col("d") >= "0"))


@register("geo_series", oracle(("stations",), per="""
SELECT row_number() OVER (ORDER BY provname, cityname) AS id, provname AS prov, cityname AS city, count(*) AS num
FROM stations GROUP BY 2, 3""", body="""
SELECT '202401' AS cycle, 'province' AS level, 'c1' AS custid, prov, '-' AS city, '-' AS cause,
       measure, CAST(CASE measure WHEN 'num' THEN num WHEN 'low' THEN num - 1 WHEN 'high' THEN num + 1 ELSE num * 2 END AS DOUBLE) AS value
FROM per CROSS JOIN (VALUES ('num'), ('low'), ('high'), ('fcst')) AS m(measure)"""))
def q_geo_series(spark, sf_dir):
    """AN-42: a forecast file as the external program leaves it (derived from the stations),
    loaded at province level."""
    path = _folder(spark, "series")
    per = I.stations(spark, sf_dir).groupBy("provname", "cityname").agg(F.count(F.lit(1)).alias("num"))
    text = F.concat_ws(",", F.concat(F.col("provname"), F.col("cityname")), F.lit("c1"), "provname", "cityname", "num",
                       F.col("num") - 1, F.col("num") + 1, F.col("num") * 2)
    header = spark.createDataFrame([(",".join(R.GEO_SERIES_FIELDS["forecast"]),), ("damaged,line",)], "value string")
    per.select(text.alias("value")).unionAll(header).write.text(path)
    return R.geo_series_load(spark, path, "forecast", "province", "202401")


@register("time_helpers", """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 5400 SECOND, '%Y%m%d%H%M') AS shifted,
       CAST(epoch(o_orderdate) - epoch(TIMESTAMP '1992-01-01') AS BIGINT) AS since,
       isodow(o_orderdate) AS dow, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_first,
       CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS week_last,
       day(o_orderdate) AS dom, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_first,
       last_day(o_orderdate) AS month_last,
       CASE WHEN CAST(o_custkey AS VARCHAR) LIKE '86%' THEN CAST(o_custkey AS VARCHAR)
            ELSE '86' || CAST(o_custkey AS VARCHAR) END AS number,
       regexp_matches(CAST(o_custkey AS VARCHAR), '(1|3)$') AS odd_end, CAST('orders' AS VARCHAR) AS origin
FROM orders""")
def q_time_helpers(spark, sf_dir):
    """PRJ-2, 16, 21, 34, 35, 36 and FLT-4 over every order, all read from text."""
    o = C.cast_all(I.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyyMMddHHmm").alias("label"),
        F.to_date("o_orderdate").alias("day")))
    week, month = C.week_bounds("day"), C.month_bounds("day")
    out = o.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        C.shift_time("label", "yyyyMMddHHmm", 5400).alias("shifted"),
        C.time_interval(F.lit("199201010000"), F.col("label"), "yyyyMMddHHmm").alias("since"),
        week["dow"].cast("bigint").alias("dow"), week["week_first"].alias("week_first"), week["week_last"].alias("week_last"),
        month["dom"].cast("bigint").alias("dom"), month["month_first"].alias("month_first"),
        month["month_last"].alias("month_last"),
        C.normalize_number(F.concat(F.lit("00"), "o_custkey")).alias("number"),
        P.matches("o_custkey", "(1|3)$").alias("odd_end"))
    return C.tag(out, origin="orders")


@register("list_helpers", oracle(("users",), body="""
SELECT domain, count(*) AS users, count(CASE WHEN paired = '1' THEN 1 END) AS first_places,
       count(DISTINCT mdn) AS owners
FROM (SELECT mdn, unnest(string_split(vpdndomain, ',')) AS domain,
             unnest(['1', '2']) AS paired FROM users) GROUP BY 1"""))
def q_list_helpers(spark, sf_dir):
    """PRJ-32, 33 and 23: comma lists of every user exploded alone and side by side."""
    u = I.users(spark, sf_dir).select("mdn", "vpdndomain")
    single = C.explode_csv(u, "vpdndomain", "domain").groupBy("domain").agg(
        F.count(F.lit(1)).alias("users"), F.count_distinct("mdn").alias("owners"))
    key = u.select(C.compose_key("mdn", F.col("vpdndomain"), sep="|").alias("k"))
    back = key.select(*C.split_key("k", ["mdn", "domain"], sep="|")).withColumn("paired", F.lit("1,2"))
    pairs = C.zip_explode(back, ["domain", "paired"]).groupBy("domain").agg(
        F.count(F.when(F.col("paired") == "1", 1)).alias("first_places"))
    return single.join(pairs, "domain").select("domain", "users", "first_places", "owners")
