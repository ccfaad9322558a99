"""Baselines and slot series (survey AN-18, AN-19, AN-49, WN-10, WN-11, WN-12).

A baseline for target day D uses the ``days`` days before D.  All target days are
computed at once: every series row is copied to the ``days`` target days it
serves (a bounded explode), so each (key, slot, target day) group has at most
``days`` rows and the ranking window never grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import predicates as P
from . import windows as W


def slot_series(df: DataFrame, keys: Sequence[str], ts: str, value: Column | str,
                slot_fmt: str = "HHmm", slot_minutes: int = 5) -> DataFrame:
    """Per (key, day, time-of-day slot) totals: the stored 5-minute series the
    baselines read.  ``slot`` is the slot start as text (HHmm by default)."""
    v = F.col(value) if isinstance(value, str) else value
    floored = C.bucket_floor(ts, slot_minutes * 60)
    return (df.select(*keys, F.to_date(ts).alias("day"), F.date_format(floored, slot_fmt).alias("slot"),
                      v.alias("value"))
            .groupBy(*keys, "day", "slot").agg(F.sum("value").alias("value")))


def _targets(series: DataFrame, days: int) -> DataFrame:
    return series.withColumn("target_day", F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", days))))


def baseline(series: DataFrame, keys: Sequence[str], days: int = 7,
             divisor: str = "fixed") -> DataFrame:
    """AN-18: per (key, slot, target day): when ``days`` > 2, the sum of the values
    ranked 2..days-1 (ascending; drops the smallest and, when all days are present,
    the largest) divided by ``days - 2``; when ``days`` <= 2 the plain sum divided
    by ``days``.  ``divisor="fixed"`` keeps the reference's fixed divisor even when
    days are missing; ``"observed"`` divides by the rows actually kept."""
    keys = list(keys)
    t = _targets(series, days)
    grp = [*keys, "slot", "target_day"]
    if days > 2:
        trimmed = W.drop_min_max_sum(t, grp, "value", days, tiebreak=["day"])
        kept = F.greatest(F.least(F.col("n_rows"), F.lit(days - 1)) - 1, F.lit(0))
        den = F.lit(float(days - 2)) if divisor == "fixed" else kept.cast("double")
        out = trimmed.select(*grp, (F.col("trimmed_sum").cast("double") / den).alias("baseline"))
    else:
        agg = t.groupBy(*grp).agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("n"))
        den = F.lit(float(days)) if divisor == "fixed" else F.col("n").cast("double")
        out = agg.select(*grp, (F.col("s").cast("double") / den).alias("baseline"))
    return out.withColumnRenamed("target_day", "day")


def baseline_avg(series: DataFrame, keys: Sequence[str], days: int = 7, trim: bool = True) -> DataFrame:
    """AN-19: older form — drop the smallest and the largest value (when there are
    more than two) and average the rest over the rows found; or a plain average."""
    keys = list(keys)
    t = _targets(series, days)
    grp = [*keys, "slot", "target_day"]
    if trim:
        from pyspark.sql import Window
        w = Window.partitionBy(*grp).orderBy(F.col("value").asc(), F.col("day").asc())
        ranked = t.withColumn("rn", F.row_number().over(w)).withColumn(
            "cnt", F.count(F.lit(1)).over(Window.partitionBy(*grp)))
        keep = (F.col("cnt") <= 2) | ((F.col("rn") > 1) & (F.col("rn") < F.col("cnt")))
        agg = ranked.where(keep).groupBy(*grp).agg(
            (F.sum("value").cast("double") / F.count("value").cast("double")).alias("baseline"))
    else:
        agg = t.groupBy(*grp).agg((F.sum("value").cast("double") / F.count("value").cast("double")).alias("baseline"))
    return agg.withColumnRenamed("target_day", "day")


def slot_history(series: DataFrame, keys: Sequence[str], days_ago: int = 7,
                 slot_seconds: int = 300) -> DataFrame:
    """WN-10 + WN-11: each slot's value with the previous slot's value (``p_value``,
    only when exactly one slot earlier) and the value at the same slot
    ``days_ago`` days earlier (``h_value``)."""
    keys = list(keys)
    ts = F.to_timestamp_ntz(F.concat(F.col("day").cast("string"), F.lit(" "), F.col("slot")),
                            F.lit("yyyy-MM-dd HHmm"))
    with_ts = series.withColumn("slot_ts", ts)
    prev = W.previous_slot(with_ts, keys, "slot_ts", ["value"], prefix="p_", step_seconds=slot_seconds)
    hist = W.same_slot_days_ago(prev, keys, "day", "slot", ["value"], days=days_ago, prefix="h_")
    return hist.drop("slot_ts")


def backfill(series: DataFrame, src_day: str, dst_day: str, t0: str, t1: str) -> DataFrame:
    """AN-49: replace the slots [t0, t1) of ``dst_day`` by the same slots of
    ``src_day`` (other rows unchanged)."""
    in_slice = P.half_open("slot", t0, t1)
    keep = series.where(~((F.col("day") == F.lit(dst_day).cast("date")) & in_slice))
    copied = series.where((F.col("day") == F.lit(src_day).cast("date")) & in_slice) \
        .withColumn("day", F.lit(dst_day).cast("date"))
    return keep.unionByName(copied)
