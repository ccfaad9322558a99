"""Dimension maintenance and profiles (survey AN-25..32, AN-48, AN-50).

Snapshots are merged with full outer joins on their keys; "one row per key"
choices are aggregates (``max_by`` / ``min`` of a struct), never an unordered
``row_number``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import aggregates as A
from . import joins as J
from .sessions import with_service_tags
from .summaries import NATION
from . import windows as W

# Idle-day thresholds of the sector status (status i when the idle days
# are below the i-th bound; 6 beyond the last).
SECTOR_STATUS_BOUNDS = [8, 16, 31, 61, 91, 101]
DORMANT_STATUS = 6


def sector_status(idle_days: Column) -> Column:
    expr = None
    for status, bound in enumerate(SECTOR_STATUS_BOUNDS):
        cond = idle_days < bound
        expr = F.when(cond, F.lit(status)) if expr is None else expr.when(cond, F.lit(status))
    return expr.otherwise(F.lit(DORMANT_STATUS))


def sector_usage(usage: DataFrame, keys: Sequence[str], time_col: str = "starttime") -> DataFrame:
    """First and last use per sector over the given records (AG-7)."""
    return usage.groupBy(*keys).agg(F.min(time_col).alias("firstusetime"),
                                    F.max(time_col).alias("lastusetime"))


def sector_lifecycle(today: DataFrame, prev: DataFrame | None, as_of: str,
                     keys: Sequence[str] = ("prov", "tac", "bsid", "sectid"),
                     defaults: Sequence = ("-1", "", "", "")) -> DataFrame:
    """AN-25: sector state as of ``as_of``.

    ``today``: (keys, firstusetime, lastusetime) of the recent window; ``prev``: the
    previous state (keys, firstusetime, lastusetime, status) or None on the first
    run.  Full outer join on the keys; first use kept from the previous state
    unless it is missing or the sector was dormant (status 6); last use is the
    newest; status from the idle days (PRJ-29 decoding of day ranges).  Keys get
    their sentinels and duplicates are removed deterministically (AG-19)."""
    keys = list(keys)
    day = F.to_date(F.lit(as_of))
    if prev is None:
        merged = today.select(*keys, "firstusetime", "lastusetime")
    else:
        n = today.select(*keys, F.col("firstusetime").alias("n_first"), F.col("lastusetime").alias("n_last"))
        b = prev.select(*keys, F.col("firstusetime").alias("b_first"), F.col("lastusetime").alias("b_last"),
                        F.col("status").alias("b_status"))
        j = n.join(b, keys, "full")
        first = (F.when(F.col("n_first").isNull(), F.col("b_first"))
                 .when(F.col("b_first").isNull() | (F.col("b_status") == DORMANT_STATUS), F.col("n_first"))
                 .otherwise(F.col("b_first")))
        merged = j.select(*keys, first.alias("firstusetime"),
                          F.coalesce("n_last", "b_last").alias("lastusetime"))
    out = merged.select(*[F.coalesce(F.col(k).cast("string"), F.lit(d)).alias(k) for k, d in zip(keys, defaults)],
                        "firstusetime", "lastusetime",
                        sector_status(F.datediff(day, F.to_date("lastusetime"))).alias("status"))
    return W.any_per_key(out, keys, ["firstusetime", "lastusetime", "status"])


def snapshot_merge(prev: DataFrame, incr: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AN-26: full outer merge by key; a key present in the increment takes every
    column from the increment, even a null one (JN-9)."""
    value_cols = [c for c in incr.columns if c not in keys]
    return J.full_merge(incr, prev, keys, value_cols, prefer="row")


def user_domains(users: DataFrame, cols: Sequence[str] = ("mdn", "companycode", "beloprov")) -> DataFrame:
    """AN-27 (user × domain): one row per user and distinct non-empty domain."""
    return C.explode_unique(users.select(*cols, "vpdndomain"), "vpdndomain")


def company_domains(users: DataFrame, company: str = "companycode", prov: str = "beloprov") -> DataFrame:
    """AN-27 (company × domain list): distinct domains per (company, province) as
    sorted comma text, then one province per company — the highest province code
    (``row_number`` by code desc = ``max_by``)."""
    ud = user_domains(users, ("mdn", company, prov)).select(company, prov, "vpdndomain").distinct()
    lists = ud.groupBy(company, prov).agg(A.distinct_list("vpdndomain").alias("vpdndomain"))
    one = W.latest_per_key(lists, [company], prov, [prov, "vpdndomain"])
    return one.select(F.col(prov).alias("provincecode"), company, "vpdndomain")


def company_profile(users: DataFrame, companies: DataFrame) -> DataFrame:
    """AN-28: per company (left join from the company table): users, direct, VPDN and
    common user counts, size tiers A/B/C of each count (PRJ-28) and has-direct /
    has-VPDN flags."""
    per = users.groupBy("companycode").agg(
        F.count(F.lit(1)).alias("usernum"), A.count_if(F.col("isdirect") == "1").alias("dnum"),
        A.count_if(F.col("isvpdn") == "1").alias("cnum"), A.count_if(F.col("iscommon") == "1").alias("pnum"))
    j = companies.join(per, "companycode", "left")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("usernum", "dnum", "cnum", "pnum")}
    return j.select(*companies.columns, *[v.alias(k) for k, v in counts.items()],
                    C.size_tier(F.col("usernum")).alias("alevel"), C.size_tier(F.col("dnum")).alias("dlevel"),
                    C.size_tier(F.col("cnum")).alias("clevel"), C.size_tier(F.col("pnum")).alias("plevel"),
                    F.when(counts["dnum"] > 0, 1).otherwise(0).alias("dflag"),
                    F.when(counts["cnum"] > 0, 1).otherwise(0).alias("cflag"))


def domain_profile(users: DataFrame) -> DataFrame:
    """AN-28 (per domain): users per company and VPDN domain (each user counted once
    per distinct domain they own) with the size tier of that count."""
    ud = user_domains(users, ("mdn", "companycode"))
    per = ud.groupBy("companycode", "vpdndomain").agg(F.count(F.lit(1)).alias("usernum"))
    return per.withColumn("level", C.size_tier(F.col("usernum")))


def company_counts(users: DataFrame, label: str) -> DataFrame:
    """AN-29: per company: total, direct and VPDN users with global ranks by direct
    and by VPDN users (desc, company code breaks ties; distributed global rank,
    WN-8) plus a grand-total row (company '-1', ranks 0)."""
    per = users.groupBy("companycode").agg(
        F.count(F.lit(1)).alias("totalSum"), A.count_if(F.col("isdirect") == "1").alias("directSum"),
        A.count_if(F.col("isvpdn") == "1").alias("vpdnSum"))
    r = W.global_rank(per, ["directSum"], "directRank", tiebreak=["companycode"])
    v = W.global_rank(per, ["vpdnSum"], "vpdnRank", tiebreak=["companycode"])
    r = r.join(v.select("companycode", "vpdnRank"), "companycode")
    total = users.agg(F.lit("-1").alias("companycode"), F.count(F.lit(1)).alias("totalSum"),
                      A.count_if(F.col("isdirect") == "1").alias("directSum"),
                      A.count_if(F.col("isvpdn") == "1").alias("vpdnSum"),
                      F.lit(0).alias("directRank"), F.lit(0).alias("vpdnRank"))
    cols = ["companycode", "totalSum", "directSum", "vpdnSum", "directRank", "vpdnRank"]
    return r.select(*cols).unionByName(total.select(*cols)).select(F.lit(label).alias("monthid"), *cols)


# Labels of the company-count rows (companies with direct users, with
# VPDN users).
DIRECT_COMPANIES_LABEL = "定向企业数"
VPDN_COMPANIES_LABEL = "VPDN企业数"


def company_service_counts(users: DataFrame, nation_label: str = NATION) -> DataFrame:
    """AN-29 (screen counts): number of companies, of companies with any direct user
    and of companies with any VPDN user, as long rows (prov, datatype, value)."""
    per = users.groupBy("companycode").agg(
        A.count_if(F.col("isdirect") == "1").alias("d"), A.count_if(F.col("isvpdn") == "1").alias("c"))
    tot = per.agg(F.count(F.lit(1)).alias("companynum"), A.count_if(F.col("d") > 0).alias("dnum"),
                  A.count_if(F.col("c") > 0).alias("cnum"))
    return tot.select(F.lit(nation_label).alias("prov"), "companynum", F.inline(F.array(
        F.struct(F.lit(DIRECT_COMPANIES_LABEL).alias("datatype"), F.col("dnum").alias("value")),
        F.struct(F.lit(VPDN_COMPANIES_LABEL).alias("datatype"), F.col("cnum").alias("value")))))


def open_close(oplog: DataFrame, key: str = "mdn") -> DataFrame:
    """AN-30: open / close operations matched between the 2/3G (HLR) and 4G (HSS)
    registers per operation and number (JN-10): present only in HLR → '2/3G', only
    in HSS → '4G', both → '2/3/4G'; opened and closed numbers per (province, company,
    network).

    The reference full-outer-joined the operation *records*, so a number with h HLR
    and s HSS records of one operation contributed h × s joined rows.  The same
    counts come from joining per-(operation, number, province, company) aggregates
    and multiplying their counts, so no pair of records is ever materialized and a
    number with a third of all operations collapses map-side to a few rows."""
    ok = oplog.where(F.col("opername").isin("open", "close") & (F.col("oper_result") == "success")
                     & (F.length(key) > 0))
    cols = ["custprovince", "vpdncompanycode"]

    def side(logtype: str, tag: str) -> DataFrame:
        return (ok.where(F.col("logtype") == logtype)
                .groupBy("opername", key, *[F.col(c).alias(f"{tag}_{c}") for c in cols])
                .agg(F.count(F.lit(1)).alias(f"{tag}_n")))

    j = side("HLR", "l1").join(side("HSS", "l2"), ["opername", key], "full")
    net = (F.when(F.col("l2_n").isNull(), F.lit("2/3G")).when(F.col("l1_n").isNull(), F.lit("4G"))
           .otherwise(F.lit("2/3/4G")))
    pairs = F.coalesce(F.col("l1_n"), F.lit(1)) * F.coalesce(F.col("l2_n"), F.lit(1))
    rows = j.select(*[F.coalesce(f"l1_{c}", f"l2_{c}").alias(c) for c in cols], net.alias("nettype"),
                    F.when(F.col("opername") == "open", pairs).otherwise(0).alias("opennum"),
                    F.when(F.col("opername") == "close", pairs).otherwise(0).alias("closenum"))
    return rows.groupBy(*cols, "nettype").agg(F.sum("opennum").alias("opennum"),
                                              F.sum("closenum").alias("closenum"))


def card_overview(online: DataFrame, active: DataFrame, opened: DataFrame, companies: DataFrame,
                  nets: Sequence[str]) -> DataFrame:
    """AN-31: per company × network on a dense scaffold (fixed network list, JN-18):
    mean hourly online users (floored, AG-6), active users, opened and closed
    cards, zeros for gaps (PRJ-9).

    ``online``: (companycode, net, hour, online); ``active``: (companycode, net,
    active); ``opened``: (companycode, net, opennum, closenum)."""
    mean_online = online.groupBy("companycode", "net").agg(
        F.floor(F.sum("online").cast("double") / F.count("online").cast("double")).cast("bigint").alias("avg_online"))
    facts = mean_online.join(active, ["companycode", "net"], "full").join(opened, ["companycode", "net"], "full")
    return J.densify(companies.select("companycode").distinct(), "net", nets, facts, ["companycode", "net"],
                     {"avg_online": 0, "active": 0, "opennum": 0, "closenum": 0})


# Codes of users whose company, or whose company's province, is unknown.
UNKNOWN_PROVINCE = "N999999999"
UNKNOWN_COMPANY = "P999999999"


def terminal_stats(users: DataFrame, companies: DataFrame, devices: DataFrame) -> DataFrame:
    """AN-32: users per device type × model × province × company × service (domain '-1'), and
    for VPDN users also per domain they own.

    The terminal is told by the first eight digits of the user's IMEI; users whose terminal
    is unknown stay, with null device columns.  Here a user has one service, VPDN before
    direct before common; the province is the company's."""
    dev = devices.select(F.lpad(F.col("tac").cast("string"), 8, "0").alias("__tac"), "devicetype", "modelname")
    known = companies.select("companycode", "provincecode")
    j = (users.select("mdn", "imei", "companycode", "isvpdn", "isdirect", "vpdndomain")
         .join(J.sized(known), "companycode", "left")
         .join(J.sized(dev), F.substring("imei", 1, 8) == F.col("__tac"), "left"))
    serv = F.when(F.col("isvpdn") == "1", "C").when(F.col("isdirect") == "1", "D").otherwise("P")
    code = lambda c, default: F.when(F.length(c) > 0, F.col(c)).otherwise(F.lit(default))
    all_domains = F.array(F.lit("-1"))
    domains = F.when(serv == "C", F.concat(all_domains, F.split("vpdndomain", ","))).otherwise(all_domains)
    return (j.select("devicetype", "modelname", code("provincecode", UNKNOWN_PROVINCE).alias("custprovince"),
                     code("companycode", UNKNOWN_COMPANY).alias("companycode"), serv.alias("servtype"),
                     F.explode(domains).alias("domain"))
            .groupBy("devicetype", "modelname", "custprovince", "companycode", "servtype", "domain")
            .agg(F.count(F.lit(1)).alias("tercnt")))


# Terminal types that do not belong on an industry card.
PHONE_TYPES = ("Mobile Phone/Feature phone", "Smartphone")


def user_terminal_counts(users: DataFrame, devices: DataFrame,
                         abnormal: Sequence[str] = PHONE_TYPES) -> DataFrame:
    """AN-32: users, users with a known terminal number (IMEI) and users whose terminal is of an
    ``abnormal`` type, per company, per company and service (flags tested independently) and
    per domain that a VPDN user owns.  Levels above carry '-1'.  One explode of the user's tags
    replaces a union of one aggregate per level."""
    dev = devices.select(F.lpad(F.col("tac").cast("string"), 8, "0").alias("__tac"), "devicetype")
    j = users.join(J.sized(dev), C.tac_of("imei") == F.col("__tac"), "left")
    tagged = with_service_tags(j.select("companycode", "isvpdn", "isdirect", "iscommon", "vpdndomain", "imei", "devicetype"))
    return tagged.groupBy("companycode", F.coalesce("servtype", F.lit("-1")).alias("servtype"),
                          F.coalesce("domain", F.lit("-1")).alias("vpdndomain")).agg(
        F.count(F.lit(1)).alias("usrcnt"), A.count_if(F.length("imei") > 0).alias("tercnt"),
        A.count_if(F.col("devicetype").isin(*abnormal)).alias("abnormalcnt"))


def detect_changes(today: DataFrame, yesterday: DataFrame, keys: Sequence[str],
                   fingerprint_cols: Sequence[str], closed: Column) -> tuple[DataFrame, DataFrame]:
    """AN-48: rows of today that are new or changed (no (key, md5 fingerprint) match
    yesterday, JN-19), excluding closed rows; and the keys of today's closed rows
    (to delete downstream)."""
    changed = J.changed_rows(today.where(~closed), yesterday, keys, fingerprint_cols)
    closed_keys = today.where(closed).select(*keys).distinct()
    return changed, closed_keys


def region_rollup(company_stats: DataFrame, companies: DataFrame, measure: str,
                  all_label: str = "-1") -> DataFrame:
    """AN-50: one province per company (deterministic pick, WN-6), then sums per
    province × service and over all provinces × service (grouping sets, AG-9)."""
    one = W.any_per_key(companies, ["companycode"], ["provincecode"])
    j = company_stats.join(one, "companycode")
    agg = A.grouping_sets(j, [["provincecode", "servtype"], ["servtype"]],
                          [F.sum(measure).alias(measure)], "gid")
    return agg.select(F.when(F.col("gid") != 0, F.lit(all_label)).otherwise(F.col("provincecode"))
                      .alias("provincecode"), "servtype", F.col(measure).cast("bigint").alias(measure))


def operations_by_net(oplog: DataFrame, register_net: dict[str, str] | None = None) -> DataFrame:
    """Successful open / close operations per company and network, the network being
    the register's (HLR → 3g, HSS → 4g by default)."""
    register_net = register_net or {"HLR": "3g", "HSS": "4g"}
    net = C.decode("logtype", register_net)
    ok = oplog.where(F.col("oper_result") == "success")
    return ok.groupBy(F.col("vpdncompanycode").alias("companycode"), net.alias("net")).agg(
        A.count_if(F.col("opername") == "open").alias("opennum"),
        A.count_if(F.col("opername") == "close").alias("closenum"))


def service_user_counts(users: DataFrame) -> DataFrame:
    """Users per company and service type (D direct, C VPDN, P other)."""
    serv = F.when(F.col("isdirect") == "1", "D").when(F.col("isvpdn") == "1", "C").otherwise("P")
    return users.groupBy("companycode", serv.alias("servtype")).agg(F.count(F.lit(1)).alias("users"))
