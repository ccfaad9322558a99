"""Outlier detection (survey AN-6..10).

Peers are aggregates (one row per peer group), so the comparison is a join of each
subject's aggregate to a small-per-key peer table.  The only step that needs the order of a
peer group's rows is the trimmed mean; counts find the rows at its two cuts, and no group is
sorted (``windows.trim_cuts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from . import joins as J
from . import windows as W
from ..session import stored_step
from .packing import codes_of, spread_packed


def exact_avg(col: str | Column) -> Column:
    """``sum / count`` as a double division of an exact integer sum (the same bits in
    every engine, unlike a floating running sum)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast("double") / F.count(c).cast("double")


def usage_outlier_day(day_usage: DataFrame, peer_keys: Sequence[str], join_keys: Sequence[str],
                      subject: str = "mdn", ratio: float = 1.5, min_users: int = 100) -> DataFrame:
    """AN-6: subjects whose mean daily volume exceeds ``ratio`` × their peer mean.

    Peer mean = mean of (up+down) over the peer group's rows; peers need more than
    ``min_users`` distinct subjects.  Subject means are over the subject's rows.
    The subject → peer join is a left join on ``join_keys``, but the ratio filter
    drops subjects without a qualifying peer (the reference's left-as-inner)."""
    total = F.col("upflow") + F.col("downflow")
    peers = (day_usage.groupBy(*peer_keys)
             .agg(exact_avg("upflow").alias("peer_avg_up"), exact_avg("downflow").alias("peer_avg_down"),
                  exact_avg(total).alias("avg_total_flow"), F.count_distinct(subject).alias("cnt"))
             .where(F.col("cnt") > min_users)
             .select(*join_keys, "avg_total_flow"))
    subjects = day_usage.groupBy(*peer_keys, subject).agg(
        exact_avg("upflow").alias("avg_upflow"), exact_avg("downflow").alias("avg_downflow"),
        exact_avg(total).alias("avg_flow"))
    j = subjects.join(peers, list(join_keys), "left")
    return j.where(F.col("avg_flow") * 100 / F.col("avg_total_flow") > ratio * 100)


def usage_outlier_period(period_usage: DataFrame, peer_keys: Sequence[str], tiebreak: Sequence[str],
                         subject: str = "mdn", lo: float = 0.5, hi: float = 1.5, trim_lo: int = 10,
                         trim_hi: int = 90, min_users: int = 100, tasks: int | None = None) -> DataFrame:
    """AN-7: week / month outliers against a trimmed peer mean.

    Peer rows (one per subject and day) are ordered by total volume; rows whose
    position percentile ``pos*100/n`` is strictly between ``trim_lo`` and ``trim_hi``
    form the trimmed mean (``tiebreak`` makes the order total; its columns after the subject
    change neither a subject's number of kept rows nor their volume and are not read; the two
    cuts of a peer group are found by counts, no group is sorted).  Rows whose peer key is null or
    blank are left out, as in the reference.  Peers need more than ``min_users`` distinct subjects
    among the kept rows.  Subjects whose mean is below ``lo`` × or above ``hi`` ×
    the peer mean are returned.  ``tasks``: among how many tasks the rows are dealt by subject
    (None: as Spark does)."""
    rows = period_usage
    for k in peer_keys:
        rows = rows.where(F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != ""))
    tie = list(tiebreak[:tiebreak.index(subject) + 1] if subject in tiebreak else tiebreak)
    # The rows are read for the cuts, for the peers' means and for the subjects' means.
    rows = stored_step(rows.select(*dict.fromkeys([*peer_keys, subject, *tie, "upflow", "downflow"])), "period-usage")
    codes = codes_of(rows, [c for c in rows.columns if c != subject]) if tasks is not None else {}
    rows_by_subject = spread_packed(rows, tasks, [subject], codes)
    total = F.col("upflow") + F.col("downflow")
    order = ["total_flow", *tie]
    cuts = stored_step(W.trim_cuts(rows.withColumn("total_flow", total), peer_keys, order, trim_lo, trim_hi), "period-cuts")

    placed = rows_by_subject.withColumn("total_flow", total).join(J.sized(cuts), list(peer_keys))
    values, start, end = ([F.col(f"{at}{c}") for c in order] for at in ("", "__from.", "__to."))
    alike = lambda cut: F.struct(*values).eqNullSafe(F.struct(*cut))
    between = W.after(values, start) & W.after(end, values)
    # Rows alike in the whole order belong to one subject: of those at a cut, so many are kept.
    at_cut = lambda cut, n: F.coalesce(F.max(F.when(alike(cut), F.col(n))), F.lit(0))
    volume = lambda cut, n: F.coalesce(F.max(F.when(alike(cut), F.col(n) * F.col("total_flow"))), F.lit(0))
    valued = lambda cut, n: F.coalesce(F.max(F.when(alike(cut) & F.col("total_flow").isNotNull(), F.col(n))), F.lit(0))
    ends = [(start, "__n_from"), (end, "__n_to")]
    part = placed.groupBy(*peer_keys, subject).agg(
        (F.coalesce(F.sum(F.when(between, F.col("total_flow"))), F.lit(0)) + sum(volume(*e) for e in ends)).alias("__kept_sum"),
        (F.count(F.when(between, F.col("total_flow"))) + sum(valued(*e) for e in ends)).alias("__kept"),
        (F.count(F.when(between, 1)) + sum(at_cut(*e) for e in ends)).alias("__kept_rows"))
    # A null subject is not counted among the users, but its rows are peer rows.
    counted = F.when((F.col("__kept_rows") > 0) & F.col(subject).isNotNull(), 1)
    peers = (part.groupBy(*peer_keys)
             .agg(F.sum("__kept_sum").cast("double").alias("__sum"), F.sum("__kept").cast("double").alias("__count"),
                  F.count(counted).alias("cnt"))
             .where(F.col("cnt") > min_users)
             .select(*peer_keys, F.when(F.col("__count") > 0, F.col("__sum") / F.col("__count")).alias("avg_total_flow")))
    peers = stored_step(peers, "period-peers")
    subjects = rows_by_subject.withColumn("total_flow", total).groupBy(*peer_keys, subject).agg(
        exact_avg("upflow").alias("avg_upflow"), exact_avg("downflow").alias("avg_downflow"),
        exact_avg("total_flow").alias("avg_flow"))
    j = subjects.join(J.sized(peers), list(peer_keys), "left")
    pct = F.col("avg_flow") * 100 / F.col("avg_total_flow")
    return j.where((pct < lo * 100) | (pct > hi * 100))


def message_outlier(sms: DataFrame, users: DataFrame, cycle: Column,
                    keys: Sequence[str] = ("custid", "beloprov", "belocity"),
                    min_numbers: int = 100, lo: float = 0.5, hi: float = 1.5) -> DataFrame:
    """AN-8: numbers whose sent+received messages are below ``lo`` × or above ``hi`` ×
    their customer's total, for customers with more than ``min_numbers`` numbers.

    Both roles of a message are enriched with one left join (explode (callee,
    caller) first).  Per (customer, number): sent and received counts.  Customer
    totals add the two roles (calls = sent + received; numbers = distinct senders
    + distinct receivers), which is what the reference's full outer join of the
    calling and called aggregates produced.  Only numbers that both sent and
    received are compared (the reference's inner join of the two roles)."""
    keys = list(keys)
    u = users.select("mdn", *keys)
    roles = sms.select(cycle.alias("summ_cycle"), F.inline(F.array(
        F.struct(F.lit("r").alias("role"), F.col("callee").alias("mdn")),
        F.struct(F.lit("s").alias("role"), F.col("caller").alias("mdn")))))
    enriched = roles.join(J.sized(u), "mdn", "left").where(F.col(keys[0]).isNotNull())
    per_number = enriched.groupBy("summ_cycle", *keys, "mdn").agg(
        F.count(F.when(F.col("role") == "s", 1)).alias("calling_cnt"),
        F.count(F.when(F.col("role") == "r", 1)).alias("called_cnt"))
    customers = per_number.groupBy("summ_cycle", *keys).agg(
        (F.sum("calling_cnt") + F.sum("called_cnt")).alias("total_cnt"),
        (F.count(F.when(F.col("calling_cnt") > 0, 1)) + F.count(F.when(F.col("called_cnt") > 0, 1))).alias("cnt"))
    qualifying = customers.where(P.having("cnt", ">", min_numbers)).drop("cnt")
    both = per_number.where((F.col("calling_cnt") > 0) & (F.col("called_cnt") > 0)) \
        .withColumn("calls_cnt", F.col("calling_cnt") + F.col("called_cnt"))
    j = both.join(qualifying, ["summ_cycle", *keys])
    pct = F.col("calls_cnt") * 100 / F.col("total_cnt")
    return j.where((pct < lo * 100) | (pct > hi * 100))


def movement_outlier(usage: DataFrame, keys: Sequence[str], cell: str = "cellid",
                     subject: Sequence[str] = ("mdn",), max_cells: int = 2,
                     record_filter: Column | None = None) -> DataFrame:
    """AN-9: subjects seen in more than ``max_cells`` distinct cells (counted over the
    records passing ``record_filter``), with every cell they used (all records) as
    sorted comma text.  The qualifying subjects are joined back to their records by
    subject (JN-17), as the reference does."""
    subject = list(subject)
    counted = usage if record_filter is None else usage.where(record_filter)
    movers = (counted.groupBy(*keys, *subject).agg(F.count_distinct(cell).alias("cnt"))
              .where(P.having("cnt", ">", max_cells)).drop("cnt"))
    # Only the movers' records are gathered; the partial collect_set of a map task dedups
    # cells before the shuffle.
    of_movers = usage.join(movers.select(*subject).distinct(), subject, "left_semi")
    cells = of_movers.groupBy(*subject).agg(F.concat_ws(",", F.sort_array(F.collect_set(cell))).alias("cells"))
    return movers.join(cells, subject)


def device_outlier(usage: DataFrame, devices: DataFrame, keys: Sequence[str],
                   disallowed: Sequence[str], subject: str = "mdn") -> DataFrame:
    """AN-10: distinct (keys, subject, device type) whose terminal (TAC) maps to a
    disallowed device type.  The device table is filtered to the disallowed types
    before the join, so only matching terminals are joined."""
    bad = devices.where(P.in_set("devicetype", disallowed)).select("tac", "devicetype")
    return usage.join(J.sized(bad), "tac").select(*keys, subject, "devicetype").distinct()
