"""Subscriber activity views built from the join shapes (survey JN-10..15, JN-22, JN-23,
AG-17, AG-22).

Each is a report the reference computed with outer joins and null tests; here the
semi / anti / full joins are written as such so Spark plans the cheap join type
(no row explosion, no null-test filter after a left join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from . import aggregates as A
from . import joins as J
from .summaries import NATION


def failure_pivot(log: DataFrame, users: DataFrame, cycle: Column, nets: Sequence[str]) -> DataFrame:
    """AG-22: failed procedures per company with one column per network type (the
    value list is given, so no extra job discovers it)."""
    f = log.where(F.col("result") == "failed").join(J.sized(users.select("mdn", "companycode")), "mdn")
    out = A.pivot_counts(f.withColumn("cycle", cycle), ["cycle", "companycode"], "net", nets,
                         F.count(F.lit(1)))
    return out.select("cycle", "companycode", *[F.coalesce(F.col(n), F.lit(0)).alias(f"fail_{n}") for n in nets])


def active_with_total(usage: DataFrame, users: DataFrame, cycle: Column, nation_label: str = NATION) -> DataFrame:
    """AG-17: active users and volume per customer plus a national total row, in one
    grouping-sets pass (the reference unioned a second aggregate)."""
    j = usage.withColumn("cycle", cycle).join(J.sized(users.select("mdn", "custid")), "mdn")
    out = A.with_total_row(j, ["cycle", "custid"], [F.count_distinct("mdn").alias("active_users"),
                                                    (F.sum("upflow") + F.sum("downflow")).alias("flow")],
                           {"cycle": None, "custid": nation_label})
    return out


def platform_split(left: DataFrame, right: DataFrame, users: DataFrame,
                   labels: tuple[str, str, str] = ("2/3G", "4G", "2/3/4G")) -> DataFrame:
    """JN-10 / JN-23: numbers seen only on the first platform, only on the second, or on
    both (full outer join of the distinct numbers), counted per company."""
    sides = J.classify_sides(left, right, ["mdn"], labels, "platform")
    return sides.join(J.sized(users.select("mdn", "companycode")), "mdn").groupBy("companycode", "platform").agg(
        F.count(F.lit(1)).alias("users"))


def activity_flags(users: DataFrame, usage: DataFrame, cutoff: Column) -> DataFrame:
    """JN-11 / JN-12 / JN-13 / JN-22 per company: users, users with usage, users whose
    first use is before ``cutoff`` and users without usage.  The semi, anti and membership
    questions all ask about the same per-user aggregate, so one left join and conditional
    counts answer them."""
    firsts = usage.groupBy("mdn").agg(F.min("starttime").alias("first_use"))
    j = users.select("mdn", "companycode").join(firsts.withColumn("is_member", F.lit(1)), "mdn", "left")
    j = j.withColumn("is_member", F.coalesce("is_member", F.lit(0)))
    member = F.col("is_member") == 1
    return j.groupBy("companycode").agg(
        F.count(F.lit(1)).alias("users"), A.count_if(member).alias("flagged"), A.count_if(member).alias("active"),
        A.count_if(member & (F.col("first_use") < cutoff)).alias("early"), A.count_if(~member).alias("idle"))


def message_pairs(sms: DataFrame, users: DataFrame, cycle: Column) -> DataFrame:
    """JN-15: each message enriched twice from the same dimension (caller and callee,
    aliased), counted per (calling customer, called customer)."""
    u = J.sized(users.select("mdn", "custid"))
    j = J.role_join(sms.withColumn("cycle", cycle), u, "caller", "mdn", "calling_", ["custid"])
    j = J.role_join(j, u, "callee", "mdn", "called_", ["custid"])
    return j.groupBy("cycle", "calling_custid", "called_custid").agg(F.count(F.lit(1)).alias("msgs"))


def hourly_cause_listing(events: DataFrame, time_col: str = "time") -> DataFrame:
    """SRT-3: stop causes counted per hour, listed in hour order (records without a cause are
    left out)."""
    hour = F.date_format(time_col, "yyyyMMddHH")
    return (events.where(P.not_blank("cause")).groupBy(hour.alias("hourid"), "cause")
            .agg(F.count(F.lit(1)).alias("tercase")).orderBy("hourid", "cause"))


def by_level(summary: DataFrame, id_col: str = "gid") -> DataFrame:
    """SRT-1: a grouping-sets result listed by grouping id, coarse keys of a level together."""
    return summary.orderBy(id_col, *[c for c in summary.columns if c != id_col])
