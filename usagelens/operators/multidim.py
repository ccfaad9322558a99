"""Multi-dimension summaries (survey AN-20..24, AN-34..37).

Company × service type × domain × network reports.  The reference builds them
from unions of per-service branches; here each record gets its service tags in one
explode and every level comes out of one grouping-sets aggregate.  A tag's level
(company, service, domain) says which sets it counts for, so nothing is counted twice
(AN-21..23); AN-20 keeps the reference's row semantics (documented there).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import predicates as P
from . import aggregates as A
from . import joins as J
from . import windows as W
from .sessions import COMPANY, DOMAIN, SERVICE, USER_SERVICES, service_tag, with_service_tags

# Grouping sets of the company / service / domain / network reports (the six sets of
# the reference's realtime summaries).
SERVICE_SETS = [["companycode"], ["companycode", "type"], ["companycode", "servtype"],
                ["companycode", "servtype", "vpdndomain"], ["companycode", "servtype", "type"],
                ["companycode", "servtype", "vpdndomain", "type"]]


def multi_dim_rows(records: DataFrame, users: DataFrame, apn_map: DataFrame) -> DataFrame:
    """AN-20 front half: records of three classes normalised to (companycode, type, mdn,
    servtype, vpdndomain, bsid, upflow, downflow, starttime) in one pass.

    ``records``: klass ('vpdn3g', 'ha3g' or 'pgw4g'), mdn, bsid, upflow, downflow, starttime,
    nai (3G VPDN) and apn (4G).  Every class reads the same user row; what differs is the
    service and the list of domains a record counts for, which is exploded at the end:

    * 3G VPDN (VPDN users only): service 'C'; the NAI's domain when the user owns it, else
      every domain of the user;
    * 3G home agent: 'D' for direct users else 'P'; no domain ('-1');
    * 4G: the APN's domain counts when the user owns it — 'D' direct, 'C' VPDN owning the
      domain, else 'P'; the domain is kept for non-direct owners, else '-1'."""
    u = users.select("mdn", "companycode", "vpdndomain", "isvpdn", "isdirect")
    owned = F.split("vpdndomain", ",")
    m = apn_map.select(F.col("apn").alias("m_apn"), F.col("vpdndomain").alias("m_dom"))
    is4g, isvpdn3g = F.col("klass") == "pgw4g", F.col("klass") == "vpdn3g"
    direct, vpdn = F.col("isdirect") == "1", F.col("isvpdn") == "1"
    j = (records.join(J.sized(u), "mdn").where(~isvpdn3g | vpdn)
         .join(J.sized(m), is4g & (F.col("apn") == F.col("m_apn")) & F.array_contains(owned, F.col("m_dom")), "left"))
    own_apn, nai_dom = F.col("m_dom").isNotNull(), C.domain_of("nai")
    none = F.array(F.lit("-1"))
    domains = (F.when(isvpdn3g, F.when(F.array_contains(owned, nai_dom), F.array(nai_dom)).otherwise(owned))
               .when(is4g & own_apn & ~direct, F.array(F.col("m_dom"))).otherwise(none))
    serv = F.when(isvpdn3g | (is4g & vpdn & ~direct & own_apn), "C").when(direct, "D").otherwise("P")
    flow = lambda c: F.when(is4g, F.coalesce(c, F.lit(0))).otherwise(F.col(c)).alias(c)
    return j.select("companycode", F.when(is4g, "4g").otherwise("3g").alias("type"), "mdn", serv.alias("servtype"),
                    F.explode(domains).alias("vpdndomain"), "bsid", flow("upflow"), flow("downflow"), "starttime")


def multi_dim_usage(rows: DataFrame, cycle: Column | None = None) -> DataFrame:
    """AN-20: volume sums and per-record means over the six company / service /
    domain / network grouping sets, with Spark's ``grouping_id``; rows of the
    '-1' (no domain) domain group are dropped (FLT-8).  As in the reference, a
    record exploded into several domains is counted once per domain row, also in
    the company-level sets."""
    r = rows if cycle is None else rows.withColumn("cycle", cycle)
    pre = ["cycle"] if cycle is not None else []
    sets = [[*pre, *s] for s in SERVICE_SETS]
    agg = A.grouping_sets(r, sets, [
        F.sum("upflow").alias("upflow"), F.sum("downflow").alias("downflow"),
        (F.sum("upflow").cast("double") / F.count("upflow").cast("double")).alias("avgupflow"),
        (F.sum("downflow").cast("double") / F.count("downflow").cast("double")).alias("avgdownflow")],
        id_col="gid")
    return agg.where(P.not_sentinel_group("vpdndomain"))


STATION_SETS = [["companycode", "type", "bsid"], ["companycode", "servtype", "type", "bsid"],
                ["companycode", "servtype", "vpdndomain", "type", "bsid"]]


def multi_dim_station_usage(rows: DataFrame, cycle: Column) -> DataFrame:
    """AN-20 (station part): volume per station over the three company / service /
    domain grouping sets (network type always kept); the '-1' domain group dropped."""
    sets = [["cycle", *st] for st in STATION_SETS]
    agg = A.grouping_sets(rows.withColumn("cycle", cycle), sets,
                          [F.sum("upflow").alias("upflow"), F.sum("downflow").alias("downflow")], id_col="gid")
    return agg.where(P.not_sentinel_group("vpdndomain"))


def active_users_dim(rows: DataFrame, users: DataFrame) -> DataFrame:
    """AN-36: distinct active users per home province and the six company / service
    / domain / network sets (distinct counts are not inflated by domain rows)."""
    r = rows.join(J.sized(users.select("mdn", "beloprov")), "mdn")
    sets = [["beloprov", *s] for s in SERVICE_SETS]
    agg = A.grouping_sets(r, sets, [F.count_distinct("mdn").alias("active_users")], id_col="gid")
    return agg.where(P.not_sentinel_group("vpdndomain"))


def tagged_service_summary(tagged: DataFrame, keys_before: Sequence[str], extra_dim: str,
                           measures: Mapping[str, tuple[str, Column]],
                           subject: str = "mdn") -> DataFrame:
    """Shared core of AN-21..23 over records with service tags (level, servtype, domain).

    A tag's level says which of the six grouping sets of (keys_before..., companycode,
    servtype, vpdndomain, extra_dim) it counts for: company, company and service, or
    company, service and domain, each with and without ``extra_dim``.  ``gid`` is the
    grouping id those six sets would have.

    ``measures`` maps a name to (kind, column): 'count' (non-null values), 'sum', or
    'distinct' — the distinct number of ``subject`` values among the rows where the
    column is not null (``count(distinct case when .. then mdn end)``).

    Distinct counts inside grouping sets are done in two levels (AG-11): first one row per
    (set, keys, subject) with partial counts and 0/1 flags, combined map-side, then a plain
    sum per (set, keys); a hot subject or company never meets in one task."""
    keys = [*keys_before, "companycode", "level", "servtype", "domain"]
    first, second = [], []
    for name, (kind, col) in measures.items():
        part = {"count": F.count(col), "sum": F.sum(col),
                "distinct": F.max(F.when(col.isNotNull(), F.lit(1)))}[kind]
        first.append(part.alias(name))
        final = F.count(name) if kind == "distinct" else F.sum(name)
        second.append(F.coalesce(final, F.lit(0)).cast("bigint").alias(name))
    per_subject = A.grouping_sets(tagged, [[*keys, subject], [*keys, extra_dim, subject]], first, "gid1")
    agg = per_subject.groupBy("gid1", *keys, extra_dim).agg(*second)
    columns = [*keys_before, "companycode", extra_dim, "servtype", "vpdndomain"]
    by_level = {COMPANY: [], SERVICE: ["servtype"], DOMAIN: ["servtype", "vpdndomain"]}
    gid = F.lit(None).cast("int")
    for level, dims in by_level.items():
        for with_extra in (False, True):
            present = [*keys_before, "companycode", *([extra_dim] if with_extra else []), *dims]
            # gid1 is 0 for the set that holds every column of the first level.
            gid = F.when((F.col("level") == level) & ((F.col("gid1") == 0) == with_extra),
                         F.lit(A.grouping_id_of(columns, present))).otherwise(gid)
    return agg.withColumnRenamed("domain", "vpdndomain").withColumn("gid", gid).select(
        *columns, "gid", *measures)


def by_own_domain(auth: DataFrame, users: DataFrame) -> DataFrame:
    """Authentication records with service tags by the record's own domain (AN-21): 'D' for
    a direct user; 'C' with that domain where a VPDN user owns it; else 'P'."""
    u = users.select(*USER_SERVICES)
    j = auth.join(J.sized(u), "mdn")
    serv = C.service_type("isdirect", "isvpdn", "vpdndomain", "authdomain")
    tags = F.concat(
        F.array(service_tag(COMPANY, None)),
        F.array(F.struct(F.lit(SERVICE).alias("level"), serv.alias("servtype"),
                         F.lit(None).cast("string").alias("domain"))),
        F.when(serv == "C", F.array(service_tag(DOMAIN, "C", F.col("authdomain"))))
        .otherwise(F.array().cast("array<struct<level:int,servtype:string,domain:string>>")))
    return A.tagged_explode(j, tags, ["level", "servtype", "domain"])


def _attempt_measures() -> dict[str, tuple[str, Column]]:
    ok = F.col("ok")
    return {"req_cnt": ("count", F.lit(1)), "req_s_cnt": ("count", F.when(ok, 1)),
            "req_card_cnt": ("distinct", F.col("mdn")),
            "req_card_s_cnt": ("distinct", F.when(ok, F.col("mdn"))),
            "req_card_f_cnt": ("distinct", F.when(~ok, F.col("mdn")))}


def auth_summary(auth: DataFrame, users: DataFrame, cycle: Column,
                 success: Column | None = None) -> DataFrame:
    """AN-21: authentication attempts, successes, distinct users, users with a success and
    users with a failure (a user may be in both) per company × service × domain × network
    over the six grouping sets.  ``auth``: mdn, nai (``user@domain``), net, result.  A
    record belongs to one service, by its own domain (:func:`by_own_domain`).  ``success``
    defaults to ``result = 'success'`` (the code 0 of 3G/4G and 1 of VPDN logs is decided
    when the log is normalised)."""
    ok = F.col("result") == "success" if success is None else success
    df = auth.select(cycle.alias("cycle"), "mdn", F.col("net").alias("type"), ok.alias("ok"),
                     C.domain_of("nai").alias("authdomain"))
    return tagged_service_summary(by_own_domain(df, users), ["cycle"], "type", _attempt_measures())


def auth_errors(auth: DataFrame, users: DataFrame, cycle: Column) -> DataFrame:
    """AN-21 error-code breakdown: failed attempts per error code over the six company
    / service / domain / network grouping sets (the code is kept in every set)."""
    failed = auth.where(F.col("result") != "success").select(
        cycle.alias("cycle"), "mdn", F.col("net").alias("type"), F.col("cause").alias("errcode"),
        C.domain_of("nai").alias("authdomain"))
    return tagged_service_summary(by_own_domain(failed, users), ["cycle", "errcode"], "type",
                                  {"err_cnt": ("count", F.lit(1))})


def auth_stations(auth: DataFrame, users: DataFrame, cycle: Column, net: str = "3g",
                  unknown_station: str = "0") -> DataFrame:
    """AN-21 station part: authentication requests of one network per company × service ×
    station, and for VPDN records also per domain: requests, failures, successes, distinct
    users, users with a failure and users with a success.  ``auth``: mdn, nai, net, result,
    enbid; a record's service is told by its own domain (:func:`by_own_domain`).

    Rows are reduced per user first, so distinct users are counted without a set per group
    and a busy station is combined map-side."""
    rec = auth.where(F.col("net") == net).select(
        cycle.alias("cycle"), "mdn", F.col("enbid").cast("string").alias("bsid"),
        (F.col("result") == "success").alias("ok"), C.domain_of("nai").alias("authdomain"))
    tagged = by_own_domain(rec, users).where(F.col("level") != COMPANY)
    keys = ["cycle", "companycode", "servtype", "domain", "bsid"]
    per_user = tagged.groupBy(*keys, "mdn").agg(F.count(F.lit(1)).alias("n"), A.count_if(F.col("ok")).alias("s"))
    return per_user.groupBy(*keys).agg(
        F.sum("n").alias("rn"), F.sum(F.col("n") - F.col("s")).alias("rfn"), F.sum("s").alias("rsn"),
        F.count("mdn").alias("req_card_cnt"), A.count_if(F.col("n") > F.col("s")).alias("req_card_fcnt"),
        A.count_if(F.col("s") > 0).alias("req_card_scnt")).select(
        "cycle", "companycode", "servtype", F.coalesce("domain", F.lit("-1")).alias("vpdndomain"),
        F.coalesce("bsid", F.lit(unknown_station)).alias("bsid"), "rn", "rfn", "rsn", "req_card_cnt",
        "req_card_fcnt", "req_card_scnt")


def mme_summary(log: DataFrame, users: DataFrame, cycle: Column, attach: Column) -> DataFrame:
    """AN-22: attach requests (PRJ-4) with the measures of :func:`auth_summary`, per service
    the user has (flags tested independently) and over all users of the company."""
    df = log.where(attach).select(cycle.alias("cycle"), "mdn", F.col("net").alias("type"),
                                  (F.col("result") == "success").alias("ok"))
    tagged = with_service_tags(df.join(J.sized(users.select(*USER_SERVICES)), "mdn"))
    return tagged_service_summary(tagged, ["cycle"], "type", _attempt_measures())


def failing_stations(log: DataFrame, users: DataFrame, stations: DataFrame, cycle: Column,
                     top: int = 1000) -> DataFrame:
    """AN-22 (station part): per company, stations ranked by failed requests
    (desc, station id breaks ties) with the station name; ranks below ``top``
    (the reference keeps ``rank < 1000``).  The ``row_number() < n`` filter is
    planned as a partial WindowGroupLimit before the shuffle."""
    f = log.where(F.col("result") == "failed").join(J.sized(users.select("mdn", "companycode")), "mdn")
    per = f.groupBy(cycle.alias("cycle"), "companycode", "enbid").agg(F.count(F.lit(1)).alias("fail_cnt"))
    ranked = W.top_n(per, ["cycle", "companycode"], ["fail_cnt"], top, "rank", tiebreak=["enbid"])
    # SRT-2: rank left-padded to 3 digits so key order equals rank order.
    ranked = ranked.withColumn("rank_key", F.concat_ws("_", "companycode", F.lpad(F.col("rank").cast("string"), 3, "0")))
    return ranked.join(J.sized(stations.select("enbid", "stationname", "provname", "cityname")), "enbid", "left")


def sms_dim_summary(sms: DataFrame, users: DataFrame, cycle: Column) -> DataFrame:
    """AN-23: sent / received messages and distinct users per company × service ×
    domain × direction ('s' sent, 'r' received) and over both directions."""
    roles = sms.select(cycle.alias("cycle"), F.inline(F.array(
        F.struct(F.lit("r").alias("direction"), F.col("callee").alias("mdn")),
        F.struct(F.lit("s").alias("direction"), F.col("caller").alias("mdn")))))
    tagged = with_service_tags(roles.join(J.sized(users.select(*USER_SERVICES)), "mdn"))
    return tagged_service_summary(tagged, ["cycle"], "direction", {
        "msg_cnt": ("count", F.lit(1)), "user_cnt": ("distinct", F.col("mdn"))})


def area_rank(metrics: DataFrame, stations: DataFrame, measures: Mapping[str, tuple[str, str | None]],
              prefix_len: int | None = None) -> DataFrame:
    """AN-24: station / city / province / total levels, each per network type and
    over all networks (``net = 't'``); for every metric family in ``measures``
    (name → (request column, success column or None)): requests, successes, success
    ratio (PRJ-25) and a rank by requests (desc) inside (cycle, level, network).

    ``metrics``: (cycle, enbid, net, <measure columns>).  With ``prefix_len`` the
    station dimension is keyed by an id prefix (3G stations by a 4-character prefix,
    JN-16).  All-network rows are told by the grouping id, so rows whose network is null
    keep a group of their own.  A rank group holds one aggregated row per station at most,
    so its size is bounded by the station register and one window serves at every size."""
    b = stations.select(F.col("enbid").cast("string").alias("bkey"), F.col("provname").alias("prov"),
                        F.col("cityname").alias("city"))
    key = F.col("enbid").cast("string")
    if prefix_len:
        key = F.substring(key, 1, prefix_len)
    m = metrics.withColumn("bkey", key).join(J.sized(b), "bkey", "left").withColumn("enbid", F.col("enbid").cast("string"))
    geo = [["prov", "city", "enbid"], ["prov", "city"], ["prov"], []]
    sets = [["cycle", *g, *n] for g in geo for n in (["net"], [])]
    cols = [c for pair in measures.values() for c in pair if c]
    agg = A.grouping_sets(m, sets, [F.sum(c).alias(c) for c in cols], "gid")
    names = {}
    for g, lv in zip(geo, ["STATION", "CITY", "PROV", "TOTAL"]):
        names[lv + "_NET"] = ["cycle", *g, "net"]
        names[lv] = ["cycle", *g]
    out = (agg.withColumn("level", F.regexp_replace(A.level_of("gid", sets, names), "_NET$", ""))
           .withColumn("net", F.when(F.col("gid").bitwiseAND(F.lit(A.grouping_id_bit(sets, "net"))) > 0,
                                     F.lit("t")).otherwise(F.col("net"))).drop("gid"))
    part = ["cycle", "level", "net"]
    for name, (req, _succ) in measures.items():
        out = W.rank_within(out, part, [req], f"{name}_rank", tiebreak=["prov", "city", "enbid"])
    sel = ["cycle", "level", "net", "prov", "city", "enbid"]
    for name, (req, succ) in measures.items():
        sel.append(F.col(req).cast("bigint").alias(f"{name}_req"))
        if succ:
            sel += [F.col(succ).cast("bigint").alias(f"{name}_succ"), C.safe_ratio(succ, req).alias(f"{name}_ratio")]
        sel.append(F.col(f"{name}_rank").cast("int").alias(f"{name}_rank"))
    return out.select(*sel)


SLOT_COUNTERS = ["ma_sn", "ma_rn", "a_sn", "a_rn", "f_d", "f_u", "o_ln", "o_fln"]
STATION_KEYS = ["cycle", "csd", "nettype", "provname", "cityname", "enbid", "enbname"]


def station_counters(slots: DataFrame, cycle: Column, stations3g: DataFrame, stations4g: DataFrame,
                     unknown_label: str | None = "0") -> DataFrame:
    """AN-24 front half: counters per (cycle, company-service-domain key, network, station)
    with the station's place.  3G stations are found by the first four characters of their
    id, 4G stations by the whole id; a station that is not registered keeps its rows under
    '0'.  A 3G name is ``id_city``, a 4G name the register's label (``unknown_label``, or the
    id itself when that is None).  Rows without a network match no station."""
    places = stations3g.select(F.lit("3g").alias("__net"), F.col("bsidpre").alias("__key"), "provname", "cityname",
                               F.lit(None).cast("string").alias("zhlabel")).unionByName(
        stations4g.select(F.lit("4g").alias("__net"), F.col("enbid").alias("__key"), "provname", "cityname", "zhlabel"))
    key = F.when(F.col("nettype") == "3g", F.substring("enbid", 1, 4)).otherwise(F.col("enbid"))
    per = slots.groupBy(cycle.alias("cycle"), "csd", "nettype", "enbid").agg(
        *[F.sum(c).alias(c) for c in SLOT_COUNTERS])
    j = per.join(J.sized(places), (per["nettype"] == F.col("__net")) & (key == F.col("__key")), "left")
    unknown = F.col("enbid") if unknown_label is None else F.lit(unknown_label)
    name = F.when(F.col("nettype") == "3g", F.concat_ws("_", "enbid", "cityname")).otherwise(
        F.coalesce("zhlabel", unknown))
    return j.select("cycle", "csd", "nettype", F.coalesce("provname", F.lit("0")).alias("provname"),
                    F.coalesce("cityname", F.lit("0")).alias("cityname"), "enbid", name.alias("enbname"),
                    *SLOT_COUNTERS)


def station_ranks(counters: DataFrame, base: DataFrame | None = None, top: int = 1000) -> DataFrame:
    """AN-24: stations ranked inside (cycle, company-service-domain key, network) by attach
    requests, authentication requests, volume and failed logouts, and inside (cycle, key)
    over all networks by volume; with success ratios.  ``base`` (rows of the same form, the
    stored part of the day) is added first: the day horizon.  Stations stay that are below
    ``top`` in any rank (the reference keeps ``rank < 1000``).  A rank group holds one
    aggregated row per station at most; all but the total rank share one shuffle."""
    rows = counters if base is None else counters.unionByName(base)
    agg = (rows.groupBy(*STATION_KEYS).agg(*[F.sum(c).cast("bigint").alias(c) for c in SLOT_COUNTERS])
           .withColumn("f_t", F.col("f_d") + F.col("f_u")))
    ranks = {"ma_rank": (["nettype"], "ma_rn"), "a_rank": (["nettype"], "a_rn"), "f_rank": (["nettype"], "f_t"),
             "f_total_rank": ([], "f_t"), "o_rank": (["nettype"], "o_fln")}
    keep = F.lit(False)
    for name, (net, measure) in ranks.items():
        tie = ["enbid", "nettype", "provname", "cityname", "enbname"]
        agg = W.rank_within(agg, ["cycle", "csd", *net], [measure], name, tiebreak=tie)
        keep = keep | (F.col(name) < top)
    ratio = lambda s, r: F.when(F.col(r) > 0, F.col(s).cast("double") / F.col(r)).otherwise(F.lit(0.0))
    return agg.where(keep).select(*STATION_KEYS, *SLOT_COUNTERS, "f_t", ratio("ma_sn", "ma_rn").alias("ma_ratio"),
                                  ratio("a_sn", "a_rn").alias("a_ratio"), *ranks)


def station_ratio_ranks(slots: DataFrame, stations: DataFrame, top: int = 1000) -> DataFrame:
    """WN-4: registered stations with attach requests, ranked inside their
    company-service-domain key by the exact success ratio (highest first), equal ratios by
    the number of requests, then by station id; ranks below ``top``.

    ``slots``: csd, enbid, ma_sn, ma_rn (stored slot counters); ``stations``: enbid, zhlabel.
    A rank group holds one aggregated row per station of the register at most."""
    named = stations.select(F.col("enbid").cast("string").alias("enbid"), "zhlabel")
    per = (slots.where(F.col("ma_rn") > 0).groupBy("csd", F.col("enbid").cast("string").alias("enbid"))
           .agg(F.sum("ma_sn").cast("bigint").alias("rsn"), F.sum("ma_rn").cast("bigint").alias("rn"))
           .join(J.sized(named), "enbid"))
    ranked = W.rank_by_ratio(per, ["csd"], "rsn", "rn", "rank", top, ["enbid", "zhlabel"])
    return ranked.select("csd", "enbid", "zhlabel", "rsn", "rn",
                         (F.col("rsn").cast("double") / F.col("rn")).alias("ratio"), "rank",
                         F.concat_ws("_", "csd", F.lpad(F.col("rank").cast("string"), 3, "0")).alias("rowkey"))


def interval_summary(log: DataFrame, dims: Sequence[str], seconds: int, origin: int = 0,
                     label_fmt: str = "yyyyMMddHHmm") -> DataFrame:
    """AN-34: per interval (label = interval end, PRJ-6) and dimensions: attempts,
    failures, distinct users and distinct failing users; the same per error code
    (grouping sets (label, dims) and (label, dims, cause))."""
    lab = F.date_format(C.bucket_ceil("starttime", seconds, origin), label_fmt)
    failed = F.col("result") == "failed"
    df = log.withColumn("label", lab)
    agg = A.grouping_sets(df, [["label", *dims], ["label", *dims, "cause"]], [
        F.count(F.lit(1)).alias("req_cnt"), A.count_if(failed).alias("fail_cnt"),
        F.count_distinct("mdn").alias("users"), A.count_distinct_if(F.col("mdn"), failed).alias("fail_users")],
        "gid")
    return agg.withColumn("cause", F.when(F.col("gid") == 1, F.lit("-1")).otherwise(F.col("cause"))).drop("gid")


def calendar_summary(log: DataFrame, dims: Sequence[str], unit: str, label_fmt: str = "yyyyMMdd") -> DataFrame:
    """AN-34 (day / week / month cycles): the same measures as :func:`interval_summary`
    per calendar unit (``date_trunc`` — weeks start on Monday), labelled by the first
    day of the unit."""
    lab = F.date_format(F.date_trunc(unit, F.col("starttime")), label_fmt)
    failed = F.col("result") == "failed"
    return log.withColumn("label", lab).groupBy("label", *dims).agg(
        F.count(F.lit(1)).alias("req_cnt"), A.count_if(failed).alias("fail_cnt"),
        F.count_distinct("mdn").alias("users"), A.count_distinct_if(F.col("mdn"), failed).alias("fail_users"))


def quarter_summary(log: DataFrame, dims: Sequence[str]) -> DataFrame:
    """AN-34 (15-minute form): the label is the next 15-minute mark in the hour
    (PRJ-7) prefixed by the day and hour of the shifted time."""
    shifted = F.col("starttime") + F.expr("INTERVAL 15 MINUTES")
    lab = F.concat(F.date_format(shifted, "yyyyMMddHH"), C.quarter_label("starttime"))
    failed = F.col("result") == "failed"
    return log.withColumn("label", lab).groupBy("label", *dims).agg(
        F.count(F.lit(1)).alias("req_cnt"), A.count_if(failed).alias("fail_cnt"),
        F.count_distinct("mdn").alias("users"))


def avg_flow_dense(usage: DataFrame, users: DataFrame, nets: Sequence[str],
                   cycle_label: str) -> DataFrame:
    """AN-35: volume, active users and per-user mean (rounded, PRJ-27) for every
    company × network type, zeros where a company had no usage on a network.  The
    company × network scaffold explodes the fixed network list per company (JN-18)."""
    u = users.select("mdn", "companycode")
    facts = usage.join(J.sized(u), "mdn").groupBy("companycode", "net").agg(
        (F.sum("upflow") + F.sum("downflow")).alias("flow"), F.count_distinct("mdn").alias("users"))
    companies = u.select("companycode").distinct()
    from .joins import densify
    dense = densify(companies, "net", nets, facts, ["companycode", "net"], {"flow": 0, "users": 0})
    return dense.select(F.lit(cycle_label).alias("cycle"), "companycode", "net",
                        F.col("flow").cast("bigint").alias("flow"), "users",
                        C.avg_per_user("flow", "users").alias("avg_flow"))


def station_quality(log: DataFrame, stations: DataFrame, cycle: Column) -> DataFrame:
    """AN-37: requests, successes and mean delay per province / city / station ×
    procedure (grouping sets; stations left-joined so unknown stations keep their
    rows under null geography)."""
    b = stations.select("enbid", F.col("provname").alias("prov"), F.col("cityname").alias("city"))
    df = log.withColumn("cycle", cycle).join(J.sized(b), "enbid", "left")
    sets = [["cycle", "prov", "city", "enbid", "procedure"], ["cycle", "prov", "city", "procedure"],
            ["cycle", "prov", "procedure"]]
    return A.grouping_sets(df, sets, [
        F.count(F.lit(1)).alias("req_cnt"), A.count_if(F.col("result") == "success").alias("succ_cnt"),
        (F.sum("delay").cast("double") / F.count("delay").cast("double")).alias("avg_delay")], "gid")


def station_metrics(log: DataFrame, cycle: Column, families: Mapping[str, str],
                    success: Column | None = None) -> DataFrame:
    """Per (cycle, station, network) request and success counts of each procedure
    family (family name → procedure value): the station metrics AN-24 ranks.  A
    family whose success count is not wanted can be left out of the ratio by passing
    ``None`` as its success column to :func:`area_rank`."""
    ok = F.col("result") == "success" if success is None else success
    aggs = []
    for name, proc in families.items():
        aggs += [A.count_if(F.col("procedure") == proc).alias(f"{name}_req"),
                 A.count_if((F.col("procedure") == proc) & ok).alias(f"{name}_succ")]
    return log.groupBy(cycle.alias("cycle"), "enbid", "net").agg(*aggs)
