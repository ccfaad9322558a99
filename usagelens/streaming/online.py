"""Running online users on top of a stored base (survey ST-8).

The stream keeps only the change since the base in its state; the base itself is a stored
table that every micro-batch joins as a static side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the stored base: its day, the time it was taken, and its count per key.
BASE_DAY, BASE_TIME, BASE_COUNT = "day", "base_time", "base_cnt"


def _match(left: str, right: str, names: Sequence[str]):
    """Null-safe equality of the columns ``names`` of two aliased frames."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return out


def online_since_base(events: DataFrame, base: DataFrame, keys: Sequence[str], time_col: str = "time",
                      start_status: str = "Start", stop_status: str = "Stop",
                      watermark: str = "1 day") -> DataFrame:
    """ST-8: online users per (day, keys) = the day's stored base + (starts − stops) after it.

    ``events`` (streaming): status, ``time_col``, keys; ``base`` (static): day, base_time,
    base_cnt, keys.  Events before their day's base time are part of the base already and do
    not count; a day without a base counts from its start, a key without a base row from
    zero.  The state holds one change per (day, keys) and is dropped once the watermark has
    passed the day.  Use update mode; null keys are keys of their own.  A key that has a base
    but no event is not in the stream: :func:`with_idle_keys` adds it to the stored result."""
    ntz = dict(events.dtypes)[time_col] == "timestamp_ntz"
    et = F.timestamp_seconds(F.unix_timestamp(time_col)) if ntz else F.col(time_col)
    # One row per day: small, so Spark broadcasts it to every micro-batch.
    taken = base.groupBy(F.col(BASE_DAY).alias("__day")).agg(F.max(BASE_TIME).alias("__base_time"))
    timed = events.withColumn("__et", et).withWatermark("__et", watermark).withColumn(
        "__day", F.to_date(time_col))
    counted = timed.join(taken, "__day", "left").where(
        F.col("__base_time").isNull() | (F.col(time_col) >= F.col("__base_time")))
    change = (F.when(F.col("status") == start_status, 1).when(F.col("status") == stop_status, -1)
              .otherwise(0))
    state = (counted.groupBy(F.window("__et", "1 day").alias("__w"), *keys)
             .agg(F.sum(change).alias("online_delta")))
    # The window is a UTC day, like the days of the base under the session's UTC zone.
    changed = state.select(F.to_date("__w.start").alias(BASE_DAY), *keys, "online_delta").alias("s")
    joined = changed.join(base.alias("b"), _match("s", "b", [BASE_DAY, *keys]), "left")
    return joined.select(f"s.{BASE_DAY}", *[f"s.{k}" for k in keys], F.col("s.online_delta").cast("bigint")
                         .alias("online_delta"),
                         (F.coalesce(f"b.{BASE_COUNT}", F.lit(0)) + F.col("s.online_delta")).cast("bigint")
                         .alias("online"))


def with_idle_keys(current: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current counts of a stream plus the base rows whose keys had no event since."""
    names = [BASE_DAY, *keys]
    idle = base.alias("b").join(current.alias("s"), _match("b", "s", names), "left_anti").select(
        *[f"b.{n}" for n in names], F.lit(0).cast("bigint").alias("online_delta"),
        F.col(f"b.{BASE_COUNT}").cast("bigint").alias("online"))
    return current.select(*names, "online_delta", "online").unionByName(idle)
