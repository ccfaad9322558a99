"""Stand-in inputs: the driver's test tables presented in the schemas the operators expect.

The reference reads telecom usage records, signalling logs and subscriber / station /
device dimensions.  The test data is a TPC-H-like star schema plus an ``events`` table.
Each function here only renames, casts and attaches the attributes a record of that
role carries; none of them filters, aggregates or ranks.  All of them read whole
tables, so their size grows with the scale factor.

Role mapping (see FIXTURES.md section 3):

* usage record (CDR): ``lineitem`` joined to ``orders`` for the subscriber number;
  session id = order key, station = supplier key, cell = line number,
  terminal TAC = part key, network type = return flag, up/down volume =
  quantity / extended price in cents (integers, so sums are exact and order independent).
* subscriber dimension: ``customer`` with its nation (city) and region (province).
* station dimension: ``supplier`` with nation (city) and region (province).
* terminal dimension: ``part`` (brand = manufacturer, type = device type).
* signalling / authentication / session / message logs: ``events``
  (error = failed procedure, props ``k`` = cause code, signup = session Start,
  purchase = session Stop).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast, sized, spread, tasks_for
from ..operators.packing import codes_of, spread_packed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _units(c: str, scale: int = 100) -> F.Column:
    """Integer volume (like a byte counter): ``round(x * scale)`` as bigint.  Sums of
    integers are exact and order independent in every engine."""
    return F.round(F.col(c) * scale).cast("bigint")


def key_of(spark: SparkSession, sf_dir: str, name: str, key: str, source: F.Column) -> F.Column:
    """A key of dimension ``name`` for every row: ``source`` spread over the dimension's
    whole key range (0 to its largest key; a key the dimension lacks stays unknown)."""
    largest = table(spark, sf_dir, name).agg((F.max(key) + 1).alias("n")).scalar()
    return (source * 7919) % largest


def station_of(spark: SparkSession, sf_dir: str) -> F.Column:
    """Station on which an event ran."""
    return key_of(spark, sf_dir, "supplier", "s_suppkey", F.col("event_id"))


def net_of() -> F.Column:
    """Network type of an event; some logs leave it out."""
    return F.when(F.col("event_id") % 11 == 0, F.lit(None)).when(
        F.col("event_id") % 2 == 0, "3g").otherwise("4g")


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City (nation) → province (region) lookup: fixed, tiny domain."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"),
                    F.col("r_regionkey").alias("prov_id"), F.col("r_name").alias("prov")))


def usage_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Tasks among which the usage records are dealt (None: as Spark does)."""
    return tasks_for(spark, table(spark, sf_dir, "lineitem").count())


def usage_records(spark: SparkSession, sf_dir: str, by_user: bool = False, packed: Sequence[str] = ()) -> DataFrame:
    """Usage records (one per lineitem); ``by_user``: many records come dealt by ``mdn``, for
    operators that group a user's records.  ``packed``: columns (of session_id, enbid, tac, line,
    upflow, downflow and d) that the query reads and that many records are to be shuffled with in few bits.

    Columns: mdn, session_id, enbid, cellid, tac, net, nai_domain, gwaddress, upflow, downflow,
    duration, starttime, d (yyyy-MM-dd day of the record).
    """
    tasks = usage_tasks(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("session_id"), F.col("l_suppkey").alias("enbid"), F.col("l_partkey").alias("tac"),
        F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("net"),
        _units("l_quantity", 1).alias("upflow"), _units("l_extendedprice").alias("downflow"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("duration"),
        F.col("l_shipdate").alias("starttime"))
    day = F.to_date("starttime").alias("d")
    if "d" in packed:
        lines = lines.select("*", day)
    codes = codes_of(lines, packed) if packed and tasks is not None else {}
    li = spread_packed(lines, tasks, ["session_id"], codes)
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), tasks, "o_orderkey")
    if tasks is not None:
        orders = orders.hint("shuffle_hash")
    records = (li.join(orders, li.session_id == orders.o_orderkey)
               .select(F.col("o_custkey").alias("mdn"), *lines.columns))
    if by_user:
        records = spread_packed(records, tasks, ["mdn"], codes)
    return records.select(
        "mdn", "session_id", "enbid", F.col("line").cast("string").alias("cellid"), "tac", "net",
        F.concat(F.lit("d"), (F.col("tac") % 7).cast("string")).alias("nai_domain"),
        F.concat(F.lit("10.0."), (F.col("enbid") % 4).cast("string"), F.lit("."),
                 F.col("line").cast("string")).alias("gwaddress"),
        "upflow", "downflow", "duration", "starttime", "d" if "d" in packed else day)


def located_usage_records(spark: SparkSession, sf_dir: str, packed: Sequence[str] = ()) -> DataFrame:
    """Usage records that also carry ``prov``: the province the record itself names (that of
    the subscriber's address).  Station ids are only unique within a province, so records
    whose station lies elsewhere find no station row under (enbid, prov).  ``packed`` as in
    :func:`usage_records`."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    g = geo(spark, sf_dir).select("city_id", "prov")
    where = cust.join(F.broadcast(g), cust.c_nationkey == g.city_id).select(F.col("c_custkey").alias("mdn"), "prov")
    records = usage_records(spark, sf_dir, by_user=True, packed=packed)
    if not fits_broadcast(where):
        where = spread(where, usage_tasks(spark, sf_dir), "mdn")
    return records.join(sized(where), "mdn")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber snapshot (one row per customer).

    Columns: mdn, custid (market segment), companycode, beloprov, belocity,
    ind_type, isnb, isdirect, isvpdn, iscommon, vpdndomain (comma list), imei,
    userstatus, acctbal.
    """
    cust = table(spark, sf_dir, "customer")
    g = geo(spark, sf_dir)
    bal = F.col("c_acctbal")
    return (cust.join(F.broadcast(g), cust.c_nationkey == g.city_id)
            .select(F.col("c_custkey").alias("mdn"),
                    F.col("c_mktsegment").alias("custid"),
                    F.concat(F.lit("C"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("companycode"),
                    F.col("prov").alias("beloprov"),
                    F.col("city").alias("belocity"),
                    F.col("c_mktsegment").alias("ind_type"),
                    F.when(bal >= 0, "1").otherwise("0").alias("isnb"),
                    # The flags overlap, and some subscribers have none of them.
                    F.when(bal < 2000, "1").otherwise("0").alias("isdirect"),
                    F.when((bal >= 1000) & (bal < 6000), "1").otherwise("0").alias("isvpdn"),
                    F.when((bal >= 5000) & (bal < 9000), "1").otherwise("0").alias("iscommon"),
                    F.concat_ws(",", F.concat(F.lit("d"), (F.col("c_custkey") % 3).cast("string")),
                                F.concat(F.lit("d"), (F.col("c_custkey") % 5 + 2).cast("string"))).alias("vpdndomain"),
                    F.concat(F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit("0000000")).alias("imei"),
                    F.when(F.col("c_custkey") % 4 == 0, "Y").otherwise("N").alias("is2g"),
                    F.when(F.col("c_custkey") % 3 != 0, "Y").otherwise("N").alias("is3g"),
                    F.when(F.col("c_custkey") % 5 < 3, "Y").otherwise("N").alias("is4g"),
                    F.col("c_name").alias("username"),
                    _units("c_acctbal").alias("acctbal")))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company register: companycode, provincecode (some companies have none)."""
    return geo(spark, sf_dir).select(
        F.concat(F.lit("C"), F.lpad(F.col("city_id").cast("string"), 2, "0")).alias("companycode"),
        F.when(F.col("prov_id") != 0, F.col("prov")).alias("provincecode"))


def typed_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage records with the network class they were written by: opentype NB / 4G / 3G."""
    return usage_records(spark, sf_dir).withColumn(
        "opentype", F.when(F.col("net") == "N", "NB").when(F.col("net") == "R", "4G").otherwise("3G"))


def timed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4G records with their first and last usage: mdn, apn, starttime, stoptime (the volume
    unit count in hours after the start)."""
    u = usage_records(spark, sf_dir).where(F.col("net") == "R")
    return u.select("mdn", F.concat(F.lit("apn."), F.col("nai_domain")).alias("apn"), "starttime",
                    (F.col("starttime") + F.make_dt_interval(hours=F.col("upflow").cast("int"))).alias("stoptime"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension: enbid, provname, cityname, provid, cityid, stationname."""
    sup = table(spark, sf_dir, "supplier")
    g = geo(spark, sf_dir)
    return (sup.join(F.broadcast(g), sup.s_nationkey == g.city_id)
            .select(F.col("s_suppkey").alias("enbid"), F.col("prov").alias("provname"),
                    F.col("city").alias("cityname"), F.col("prov_id").alias("provid"),
                    F.col("city_id").alias("cityid"), F.col("s_name").alias("stationname")))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terminal dimension: tac, modelname, manufacturer, devicetype."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("tac"), F.col("p_name").alias("modelname"),
        F.col("p_brand").alias("manufacturer"), F.col("p_type").alias("devicetype"))


# Signalling procedure names of the stand-in log, chosen by the event's code.
PROCEDURES = ("attach", "tau", "detach", "auth", "paging")


def signalling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signalling / authentication log (one row per event).

    Columns: event_id, mdn, starttime, procedure (one of :data:`PROCEDURES`, from the
    event's code, so it is independent of the outcome), result ('failed' for error
    events), cause (props k), enbid (station the procedure ran on), delay, nai (the
    identifier used, ``user@domain``), net, pdsnip.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("user_id").alias("mdn"),
        F.col("ts").alias("starttime"),
        F.element_at(F.array(*[F.lit(x) for x in PROCEDURES]),
                     (F.get_json_object("props", "$.k").cast("int") % len(PROCEDURES) + 1)).alias("procedure"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("result"),
        F.get_json_object("props", "$.k").alias("cause"),
        station_of(spark, sf_dir).alias("enbid"),
        _units("value").alias("delay"),
        F.concat(F.col("user_id").cast("string"), F.lit("@d"), (F.col("event_id") % 7).cast("string")).alias("nai"),
        net_of().alias("net"),
        F.concat(F.lit("10.1."), station_of(spark, sf_dir).cast("string")).alias("pdsnip"))


def station_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored station counters as the realtime jobs leave them (one row per event here):
    time, csd (company_service_domain key), nettype (may be missing), enbid, and the counters
    ma (attach), a (authentication), f (volume) and o (logins / failed logouts).

    A 3G station id carries a cell digit after its four-character station part."""
    log = signalling(spark, sf_dir)
    u = users(spark, sf_dir).select("mdn", "companycode", "isvpdn")
    number = F.col("enbid").cast("string")
    part = F.lpad(F.conv(number, 10, 36), 4, "0")
    one = lambda cond: F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    ok, proc = F.col("result") == "success", F.col("procedure")
    return log.join(sized(u), "mdn").select(
        F.col("starttime").alias("time"),
        F.concat("companycode", F.when(F.col("isvpdn") == "1", F.lit("_C_-1")).otherwise(F.lit("_P_-1"))).alias("csd"),
        F.col("net").alias("nettype"),
        F.when(F.col("net") == "3g", F.concat(part, (F.col("event_id") % 10).cast("string")))
        .otherwise(number).alias("enbid"),
        one((proc == "attach") & ok).alias("ma_sn"), one(proc == "attach").alias("ma_rn"),
        one((proc == "auth") & ok).alias("a_sn"), one(proc == "auth").alias("a_rn"),
        F.when(proc == "tau", F.col("delay")).otherwise(F.lit(0)).cast("bigint").alias("f_d"),
        F.when(proc == "paging", F.col("delay")).otherwise(F.lit(0)).cast("bigint").alias("f_u"),
        one(proc == "detach").alias("o_ln"), one((proc == "detach") & ~ok).alias("o_fln"))


def stations_3g(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3G station register: bsidpre (four characters), provname, cityname."""
    return stations(spark, sf_dir).select(
        F.lpad(F.conv(F.col("enbid").cast("string"), 10, 36), 4, "0").alias("bsidpre"), "provname", "cityname")


def stations_4g(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4G station register: enbid, provname, cityname, zhlabel."""
    return stations(spark, sf_dir).select(F.col("enbid").cast("string").alias("enbid"), "provname", "cityname",
                                          F.col("stationname").alias("zhlabel"))


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Radius-like session events: signup = Start, purchase = Stop, others Interim.

    Columns: event_id, mdn, session_id, status, time, cause, enbid, net, octets."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return ev.select(
        "event_id",
        F.col("user_id").alias("mdn"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.when(F.col("event_type") == "signup", "Start")
        .when(F.col("event_type") == "purchase", "Stop").otherwise("Interim").alias("status"),
        F.col("ts").alias("time"),
        k.alias("cause"),
        station_of(spark, sf_dir).alias("enbid"),
        net_of().alias("net"),
        _units("value").alias("octets"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short-message log: caller, callee, committime, result."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("user_id").alias("caller"),
        key_of(spark, sf_dir, "customer", "c_custkey", F.col("event_id")).alias("callee"),
        F.col("ts").alias("committime"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("result"))


def classified_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage records with the class that wrote them (``klass``), by network flag: 'A' = 3G
    VPDN records (with an NAI ``mdn@domain``), 'N' = 3G home-agent records, 'R' = 4G records
    (with an APN ``apn.<domain>``)."""
    u = usage_records(spark, sf_dir).where(F.col("net").isin("A", "N", "R"))
    klass = F.when(F.col("net") == "A", "vpdn3g").when(F.col("net") == "N", "ha3g").otherwise("pgw4g")
    return u.select(klass.alias("klass"), "mdn", F.col("enbid").alias("bsid"), "upflow", "downflow", "starttime",
                    F.concat(F.col("mdn").cast("string"), F.lit("@"), F.col("nai_domain")).alias("nai"),
                    F.concat(F.lit("apn."), F.col("nai_domain")).alias("apn"))


def apn_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """APN → domain register: one APN per domain that a terminal is set up for."""
    domain = F.concat(F.lit("d"), (F.col("p_partkey") % 7).cast("string"))
    return (table(spark, sf_dir, "part").select(domain.alias("vpdndomain")).distinct()
            .withColumn("apn", F.concat(F.lit("apn."), "vpdndomain")))


def operation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register operations (open / close cards): signup = open, purchase = close,
    others = query; even event ids in the 2/3G register (HLR), odd in the 4G one
    (HSS); a value below 1 marks a failed operation.  The subscriber's province and
    company travel with the log row, as in the reference."""
    ev = table(spark, sf_dir, "events")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    g = geo(spark, sf_dir).select("city_id", "prov")
    who = cust.join(F.broadcast(g), cust.c_nationkey == g.city_id).select(
        F.col("c_custkey").alias("user_id"), F.col("prov").alias("custprovince"),
        F.concat(F.lit("C"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("vpdncompanycode"))
    return ev.join(sized(who), "user_id").select(
        F.col("user_id").cast("string").alias("mdn"),
        F.when(F.col("event_id") % 2 == 0, "HLR").otherwise("HSS").alias("logtype"),
        F.when(F.col("event_type") == "signup", "open").when(F.col("event_type") == "purchase", "close")
        .otherwise("query").alias("opername"),
        F.when(F.col("value") >= 1.0, "success").otherwise("fail").alias("oper_result"),
        "custprovince", "vpdncompanycode", F.col("ts").alias("opertime"))


def raw_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw positional text log (T0..T4, all strings) as delivered before ETL."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("T0"), F.col("user_id").cast("string").alias("T1"),
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("T2"), F.col("event_type").alias("T3"),
                     F.round(F.col("value") * 100).cast("bigint").cast("string").alias("T4"))


def gateway_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gateway IP → province map: one gateway per station."""
    return stations(spark, sf_dir).select(
        F.concat(F.lit("10.1."), F.col("enbid").cast("string")).alias("pdsnip"), F.col("provname").alias("prov"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a file stream (each new file would be a new micro-batch; the
    files that are there make the first one).  The table may be one file or a folder of
    part files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.format("parquet").schema(schema).load(f"{sf_dir.rstrip('/')}/events.parque[t]")


def raw_mme_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw vendor-coded MME log (one row per event): the vendor cycles over the three
    vendors; failed events carry a non-success cause code; signup / view events are
    attach procedures; Huawei logs the station id in hex."""
    from ..functions.columns import VENDOR_ATTACH_PROCEDURES, VENDOR_SUCCESS_CODES
    ev = table(spark, sf_dir, "events")
    vendors = list(VENDOR_SUCCESS_CODES)
    vendor = F.element_at(F.array(*[F.lit(v) for v in vendors]), (F.col("event_id") % 3 + 1).cast("int"))
    ok = {v: VENDOR_SUCCESS_CODES[v][0] for v in vendors}
    attach = {v: VENDOR_ATTACH_PROCEDURES[v][0] for v in vendors}
    pick = lambda m: F.element_at(F.map_from_arrays(F.array(*[F.lit(k) for k in m]),
                                                    F.array(*[F.lit(x) for x in m.values()])), vendor)
    failed = F.col("event_type") == "error"
    is_att = F.col("event_type").isin("signup", "view")
    station = station_of(spark, sf_dir)
    return ev.select(
        vendor.alias("vendor"), F.col("user_id").cast("string").alias("T0"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("T1"),
        F.when(is_att, pick(attach)).otherwise(F.lit("other")).alias("T8"),
        F.when(vendor == "huawei", F.concat(F.lit("0x"), F.hex(station))).otherwise(station.cast("string")).alias("T12"),
        F.when(failed, F.concat(F.lit("e"), F.get_json_object("props", "$.k"))).otherwise(pick(ok)).alias("T13"))


def session_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`session_events` read as a file stream of the ``events`` folder."""
    ev = event_stream(spark, sf_dir)
    return ev.select(
        "event_id", F.col("user_id").alias("mdn"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.when(F.col("event_type") == "signup", "Start").when(F.col("event_type") == "purchase", "Stop")
        .otherwise("Interim").alias("status"),
        F.col("ts").alias("time"), station_of(spark, sf_dir).alias("enbid"),
        net_of().alias("net"))
