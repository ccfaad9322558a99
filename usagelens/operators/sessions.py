"""Sessions and online users (survey AN-15, AN-16, AN-17, AN-51).

Snapshots are computed for every hour of the input at once: each event is
copied to the (bounded, ``lookback``-hours) set of snapshot hours it can affect,
so one shuffle answers "who was online at H" for all H.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import aggregates as A
from . import joins as J

HOUR = 3600


def online_sessions(events: DataFrame, lookback_hours: int = 7, stop_status: str = "Stop",
                    time_col: str = "time") -> DataFrame:
    """AN-15 (2G/3G): users online at each hour boundary H.

    A session (mdn, session_id) is online at H when, among its records in
    [H - lookback, H), there is a non-stop record and no stop record (the
    reference's left join + ``is null``, written as an aggregate with the stop
    test, which equals the anti join on (mdn, session)).  The user's station is the
    one of their latest non-stop record of an online session (``row_number() = 1``
    by time desc, as ``max_by``).  Output: snapshot, mdn, enbid, net.

    Records are first reduced to one row per (session, hour) — stop seen, latest
    non-stop time and station — with a map-side partial aggregate; only those
    hourly rows are copied to the ``lookback_hours`` snapshots they affect."""
    e = C.epoch_seconds(time_col)
    is_stop = F.col("status") == stop_status
    hourly = events.groupBy("mdn", "session_id", (F.floor(e / HOUR) * HOUR).alias("hour_s")).agg(
        F.max(is_stop.cast("int")).alias("h_stop"),
        F.max(F.when(~is_stop, F.col(time_col))).alias("h_last"),
        F.max_by(F.struct("enbid", "net"), F.when(~is_stop, F.struct(F.col(time_col), F.col("enbid"))))
        .alias("h_where"))
    first = F.col("hour_s") + HOUR
    snap = hourly.select("mdn", "session_id", "h_stop", "h_last", "h_where",
                         F.explode(F.sequence(first, first + (lookback_hours - 1) * HOUR, F.lit(HOUR)))
                         .alias("snap_s"))
    per_session = snap.groupBy("snap_s", "mdn", "session_id").agg(
        F.max("h_stop").alias("has_stop"),
        F.max_by(F.col("h_where"), F.when(F.col("h_last").isNotNull(),
                                          F.struct(F.col("h_last"), F.col("h_where.enbid")))).alias("last"),
        F.max("h_last").alias("last_time"))
    online = per_session.where((F.col("has_stop") == 0) & F.col("last_time").isNotNull())
    latest = online.groupBy("snap_s", "mdn").agg(
        F.max_by(F.col("last"), F.struct("last_time", "session_id")).alias("p"))
    return latest.select(C.ntz_from_epoch("snap_s").alias("snapshot"), "mdn",
                         F.col("p.enbid").alias("enbid"), F.col("p.net").alias("net"))


def online_by_records(records: DataFrame, now: Column | str, lookahead_hours: int = 2,
                      start_col: str = "starttime", stop_col: str = "stoptime",
                      keys: Sequence[str] = ("mdn", "apn")) -> DataFrame:
    """AN-15 (4G): distinct keys of records that began before ``now`` and end within
    ``lookahead_hours`` after it."""
    n = F.col(now) if isinstance(now, str) else now
    end = n + F.expr(f"INTERVAL {lookahead_hours} HOURS")
    return records.where((F.col(start_col) < n) & (F.col(stop_col) >= n) & (F.col(stop_col) < end)) \
        .select(*keys).distinct()


def online_count(events: DataFrame, base: DataFrame, keys: Sequence[str], day_col: str,
                 slot_col: str, start_status: str = "Start", stop_status: str = "Stop",
                 all_nets: str = "-1") -> DataFrame:
    """AN-16: online users per (day, slot, keys, net) = base count of the day plus the
    running sum of (starts − stops) of the day's slots up to and including this
    one; plus an all-nets row (net = ``all_nets``) per (day, slot, keys).

    ``base`` has (day, keys..., net, base_cnt).  Deltas are aggregated per slot
    first, so the running window only sees one row per slot and key.  Keys with a
    base but no events in the day still get their base (full outer join, JN-8)."""
    keys = list(keys)
    deltas = events.groupBy(day_col, slot_col, *keys, "net").agg(
        (A.count_if(F.col("status") == start_status) - A.count_if(F.col("status") == stop_status)).alias("delta"))
    run = A.running_total(deltas, [day_col, *keys, "net"], slot_col, "delta", "cum_delta")
    # A null network is a network of its own: matched null-safely through a key that is
    # never null.
    mark = F.coalesce(F.concat(F.lit("="), F.col("net")), F.lit("null"))
    run = run.withColumn("__net", mark).drop("net")
    base = base.withColumn("__net", mark).drop("net")
    j = (run.join(base, [day_col, *keys, "__net"], "full")
         .withColumn("net", F.when(F.col("__net") != "null", F.substr("__net", F.lit(2)))))
    per_net = j.select(day_col, F.coalesce(slot_col, F.lit("base")).alias(slot_col), *keys, "net",
                       (F.coalesce("base_cnt", F.lit(0)) + F.coalesce("cum_delta", F.lit(0))).alias("online"))
    sets = [[day_col, slot_col, *keys, "net"], [day_col, slot_col, *keys]]
    totals = A.grouping_sets(per_net, sets, [F.sum("online").alias("online")], "gid")
    every = F.col("gid").bitwiseAND(F.lit(A.grouping_id_bit(sets, "net"))) > 0
    return totals.select(day_col, slot_col, *keys, F.when(every, F.lit(all_nets)).otherwise(F.col("net")).alias("net"),
                         F.col("online").cast("bigint").alias("online"))


# Levels of a service tag: the whole company, one service, one domain of a service.
COMPANY, SERVICE, DOMAIN = 0, 1, 2


def service_tag(level: int, servtype: str | None, domain: Column | None = None) -> Column:
    """One tag: (level, servtype, domain)."""
    return F.struct(F.lit(level).alias("level"), F.lit(servtype).cast("string").alias("servtype"),
                    (F.lit(None).cast("string") if domain is None else domain).alias("domain"))


def _if_flag(flag: str, tags: Column) -> Column:
    """The tags where the user flag is set, else none."""
    return F.when(F.col(flag) == "1", tags).otherwise(F.slice(tags, F.lit(1), F.lit(0)))


def vpdn_tags() -> Column:
    """Tags of a VPDN user: the service, and each domain the user owns."""
    domains = F.filter(F.split(F.col("vpdndomain"), ","), lambda x: F.length(x) > 0)
    return F.concat(F.array(service_tag(SERVICE, "C")),
                    F.transform(domains, lambda d: service_tag(DOMAIN, "C", d)))


def with_service_tags(df: DataFrame, common_is_rest: bool = False) -> DataFrame:
    """Service dimension tags per record (AG-14): every record counts for its company;
    direct ('D'), VPDN ('C', also once per domain owned) and common ('P') users are told
    by three flags that are tested independently, so a user with two flags counts in
    both services and one with none only for the company.

    ``common_is_rest``: the common flag only counts where the direct one is not set
    (AN-17).  One explode replaces the reference's union of per-service branches."""
    direct, common = F.array(service_tag(SERVICE, "D")), F.array(service_tag(SERVICE, "P"))
    plain = _if_flag("iscommon", common)
    if common_is_rest:
        plain = F.when(F.col("isdirect") == "1", F.slice(common, F.lit(1), F.lit(0))).otherwise(plain)
    tags = F.concat(F.array(service_tag(COMPANY, None)), _if_flag("isdirect", direct),
                    _if_flag("isvpdn", vpdn_tags()), plain)
    return A.tagged_explode(df, tags, ["level", "servtype", "domain"])


USER_SERVICES = ["mdn", "companycode", "isvpdn", "isdirect", "iscommon", "vpdndomain"]


def login_logout_summary(events: DataFrame, users: DataFrame, cycle: Column) -> DataFrame:
    """AN-17: logins (Start), logouts (Stop) and normal logouts per company, per company
    and service, and per company and VPDN domain, each per network type and over all
    networks.  Normal = stop with a normal cause for its network (PRJ-31)."""
    j = (events.select(cycle.alias("cycle"), "mdn", "status", "cause", "net")
         .withColumn("result", C.radius_result("status", "cause", "net"))
         .join(J.sized(users.select(*USER_SERVICES)), "mdn"))
    tagged = with_service_tags(j.drop("domain"), common_is_rest=True)
    keys = ["cycle", "companycode", "level", "servtype", "domain"]
    agg = A.grouping_sets(tagged, [keys, [*keys, "net"]], [
        A.sum_if(F.lit(1), F.col("status") == "Start").alias("logincnt"),
        A.sum_if(F.lit(1), F.col("status") == "Stop").alias("logoutcnt"),
        A.sum_if(F.lit(1), (F.col("status") == "Stop") & (F.col("result") == "s")).alias("normallogoutcnt")],
        id_col="gid")
    return agg.select("cycle", "companycode", F.coalesce("servtype", F.lit("-1")).alias("servtype"), "domain",
                      F.when(F.col("gid") == 1, F.lit("-1")).otherwise(F.col("net")).alias("net"),
                      F.col("logincnt").cast("bigint").alias("logincnt"),
                      F.col("logoutcnt").cast("bigint").alias("logoutcnt"),
                      F.col("normallogoutcnt").cast("bigint").alias("normallogoutcnt"))


def abnormal_logouts(events: DataFrame, users: DataFrame, cycle: Column,
                     by: Sequence[str] = ("companycode", "net", "cause")) -> DataFrame:
    """AN-17 (second part): abnormal logouts (stops with a non-normal cause) per
    company, network and cause — or per station with ``by=("enbid", "net")``."""
    u = users.select("mdn", "companycode")
    j = (events.select(cycle.alias("cycle"), "mdn", "status", "cause", "net", "enbid")
         .where(C.radius_result("status", "cause", "net") == "f").join(J.sized(u), "mdn"))
    return j.groupBy("cycle", *by).agg(F.count(F.lit(1)).alias("failcnt"))


def logout_rollup(events: DataFrame, users: DataFrame, cycle: Column,
                  total_label: str = "-1") -> DataFrame:
    """AN-51: starts, stops and normal stops by (company, cause) with rollup rows
    (company total, grand total)."""
    u = users.select("mdn", "companycode")
    j = (events.select(cycle.alias("cycle"), "mdn", "status", "cause", "net")
         .withColumn("result", C.radius_result("status", "cause", "net")).join(J.sized(u), "mdn"))
    agg = A.rollup(j, ["cycle", "companycode", "cause"], [
        A.count_if(F.col("status") == "Start").alias("starts"),
        A.count_if(F.col("status") == "Stop").alias("stops"),
        A.count_if((F.col("status") == "Stop") & (F.col("result") == "s")).alias("normal_stops")],
        id_col="gid")
    return agg.where(F.col("gid") < 4).select(
        "cycle", F.when(F.col("gid") >= 3, F.lit(total_label)).otherwise(F.col("companycode")).alias("companycode"),
        F.when(F.col("gid") >= 1, F.lit(total_label)).otherwise(F.col("cause")).alias("cause"),
        "starts", "stops", "normal_stops")


def online_by_key(snapshots: DataFrame, users: DataFrame, keys: Sequence[str] = ("companycode",)) -> DataFrame:
    """Online users per (keys, network, snapshot) from :func:`online_sessions` rows."""
    u = users.select("mdn", *keys)
    return snapshots.join(J.sized(u), "mdn").groupBy(*keys, "net", "snapshot").agg(
        F.count(F.lit(1)).alias("online"))


def base_counts(snapshots: DataFrame, users: DataFrame, keys: Sequence[str] = ("companycode",),
                base_hour: int = 0) -> DataFrame:
    """AN-16 base: online users per (day, keys, network) at the day's base hour."""
    per = online_by_key(snapshots.where(F.hour("snapshot") == base_hour), users, keys)
    return per.select(F.to_date("snapshot").alias("day"), *keys, "net", F.col("online").alias("base_cnt"))


def active_by_key(events: DataFrame, users: DataFrame, keys: Sequence[str] = ("companycode",)) -> DataFrame:
    """Distinct active users per (keys, network) over the session events."""
    return events.join(J.sized(users.select("mdn", *keys)), "mdn").groupBy(*keys, "net").agg(
        F.count_distinct("mdn").alias("active"))
