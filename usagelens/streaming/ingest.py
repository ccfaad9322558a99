"""Structured Streaming jobs (survey ST-1..9).

Every query writes through a checkpoint folder under the cluster's shared
checkpoint directory, so offsets are committed only after the batch's output is
durable (at-least-once from Kafka, exactly-once into the file sink) and a restarted
or relocated driver resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import columns as C
from ..session import checkpoint_dir
from ..sources.sinks import remove_path, write_partitioned

# Fields of a radius session message (all text in the message).
RADIUS_FIELDS = ["MDN", "APN", "NetType", "Status", "StartTime", "StopTime", "TerminateCause",
                 "SessionID", "BSID", "Duration", "InputOctets", "OutputOctets"]
RADIUS_SCHEMA = StructType([StructField(f, StringType()) for f in RADIUS_FIELDS])
MISSING = "-1"


def parse_radius(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """ST-2 + ST-3: JSON message → typed session event.

    A message that is not a JSON object is dropped; a missing field becomes '-1'.
    The event time is StartTime for 'Start' and StopTime otherwise, normalised to
    ``yyyyMMddHHmmss`` (digits only, 14 long) or '-1'; ``dayid`` is its day
    (yyyyMMdd) or '-1', so unparseable rows land in their own partition."""
    objects = messages.where(F.json_object_keys(F.col(value_col)).isNotNull())   # JSON objects only
    parsed = objects.select(F.from_json(F.col(value_col), RADIUS_SCHEMA).alias("m"))
    cols = [F.coalesce(F.col(f"m.{f}"), F.lit(MISSING)).alias(f) for f in RADIUS_FIELDS]
    df = parsed.select(*cols)
    raw_time = F.when(F.col("Status") == "Start", F.col("StartTime")).otherwise(F.col("StopTime"))
    digits = F.regexp_replace(raw_time, "[^0-9]", "")
    time = F.when(F.length(digits) == 14, digits).otherwise(F.lit(MISSING))
    return df.withColumn("time", time).withColumn(
        "dayid", F.when(F.col("time") == MISSING, F.lit(MISSING)).otherwise(F.substring("time", 1, 8)))


def query_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location of a named streaming query inside the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def started(writer: DataStreamWriter, available_now: bool, trigger_seconds: int | None) -> StreamingQuery:
    """Start a query over what is there now (then stop), or every ``trigger_seconds``."""
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def ingest_to_partitions(events: DataFrame, path: str, name: str, partition_cols: Sequence[str] = ("dayid",),
                         trigger_seconds: int | None = 300, available_now: bool = False) -> StreamingQuery:
    """ST-1 + ST-4 + ST-5: micro-batches (300 s by default) appended to a table
    partitioned by day.  Late rows land in the partition of their own day; the
    file sink's commit log plus the source offsets in the checkpoint make each batch
    land exactly once."""
    spark = events.sparkSession
    w = (events.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", query_checkpoint(spark, name))
         .partitionBy(*partition_cols).outputMode("append").queryName(name))
    return started(w, available_now, trigger_seconds)


def word_count(lines: DataFrame) -> DataFrame:
    """ST-6: running word count over a stream of lines (complete / update mode)."""
    words = lines.select(F.explode(F.split(F.col("value"), r"\s+")).alias("word")).where(F.length("word") > 0)
    return words.groupBy("word").count()


def complete_results(df: DataFrame, path: str, name: str, available_now: bool = True,
                     trigger_seconds: int = 300) -> StreamingQuery:
    """ST-6: complete output mode.  Every micro-batch writes the whole running result under
    its batch id; a replayed batch replaces its own.  The one before it stays for readers that
    have it open, older ones go."""
    spark = df.sparkSession

    def write_all(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        remove_path(spark, f"{path}/batch_id={batch_id - 2}")

    w = (df.writeStream.outputMode("complete").foreachBatch(write_all).queryName(name)
         .option("checkpointLocation", query_checkpoint(spark, name)))
    return started(w, available_now, trigger_seconds)


def newest_complete(spark: SparkSession, path: str) -> DataFrame:
    """The last whole result that :func:`complete_results` wrote."""
    df = spark.read.parquet(path)
    newest = df.select(F.max(F.col("batch_id").cast("bigint"))).first()[0]
    return df.where(F.col("batch_id") == str(newest)).drop("batch_id")


def window_summary(events: DataFrame, ts: str, keys: Sequence[str], value: str,
                   window: str = "5 minutes", watermark: str = "10 minutes") -> DataFrame:
    """ST-7 + ST-9: tumbling-window counts and sums per key.  The watermark bounds the
    state kept for late rows: a row more than ``watermark`` behind the newest event
    time seen in earlier micro-batches is dropped instead of reopening a closed
    window.

    Watermarks need a zoned timestamp; a wall-clock (TIMESTAMP_NTZ) event time is
    read as UTC (``timestamp_seconds(unix_timestamp(ts))``, zone independent) and the
    window bounds are turned back into wall-clock values the same way."""
    ntz = dict(events.dtypes)[ts] == "timestamp_ntz"
    et = F.timestamp_seconds(F.unix_timestamp(ts)) if ntz else F.col(ts)
    back = (lambda c: C.ntz_from_epoch(F.unix_timestamp(c))) if ntz else (lambda c: c)
    return (events.withColumn("__et", et).withWatermark("__et", watermark)
            .groupBy(F.window("__et", window).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("total"))
            .select(back(F.col("w.start")).alias("window_start"), back(F.col("w.end")).alias("window_end"),
                    *keys, "events", "total"))


def running_online(events: DataFrame, keys: Sequence[str], start_status: str = "Start",
                   stop_status: str = "Stop") -> DataFrame:
    """ST-8: running online count per key = Σ(starts − stops) since the stream began,
    kept in the state store by an update-mode aggregation (a base count is added
    when reading the result)."""
    delta = (F.when(F.col("status") == start_status, 1).when(F.col("status") == stop_status, -1)
             .otherwise(0))
    return events.groupBy(*keys).agg(F.sum(delta).alias("online_delta"))


def upsert_batches(df: DataFrame, path: str, name: str, keys: Sequence[str],
                   available_now: bool = True, trigger_seconds: int = 300) -> StreamingQuery:
    """Update-mode result rows written per micro-batch into a partition of its id, so the
    newest row per key (the current value) can be read back with
    :func:`latest_versions`; a batch that is replayed after a failure replaces its own
    partition.  The stream itself never collects to the driver."""
    spark = df.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    w = (df.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", query_checkpoint(spark, name)).queryName(name))
    return started(w, available_now, trigger_seconds)


def latest_versions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key among the appended batches (max batch id, ``max_by``)."""
    df = spark.read.parquet(path)
    cols = [c for c in df.columns if c not in keys and c != "batch_id"]
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("batch_id").cast("bigint"))
    return df.groupBy(*keys).agg(picked.alias("p")).select(*keys, "p.*")


def rerun_slot(batch_summary: DataFrame, slot_filter: Column, path: str, partition_cols: Sequence[str]) -> None:
    """ST-9 (batch side): recompute one closed slot from the stored records and
    overwrite just that slot's partitions (picks up rows that arrived after the
    watermark closed it)."""
    write_partitioned(batch_summary.where(slot_filter), path, partition_cols)


def track_sessions(events: DataFrame, time_col: str = "time", watermark: str = "1 day") -> DataFrame:
    """ST-8: open / closed status and latest station of every session, kept in the state
    store by a native update-mode aggregation and updated as records arrive: a stop closes
    the session; the latest other record (time, then station id) gives the station.

    Sessions are told apart per day of their records, and that day is the event-time key of
    the state: once the watermark has passed it, the day's state is dropped."""
    ntz = dict(events.dtypes)[time_col] == "timestamp_ntz"
    et = F.timestamp_seconds(F.unix_timestamp(time_col)) if ntz else F.col(time_col)
    live = F.col("status") != "Stop"
    agg = (events.withColumn("__et", et).withWatermark("__et", watermark)
           .groupBy(F.window("__et", "1 day").alias("__day"), "mdn", "session_id")
           .agg(F.max(F.when(live, F.lit(0)).otherwise(F.lit(1))).alias("__stopped"),
                F.max(F.when(live, F.struct(F.col(time_col).alias("at"), F.col("enbid"), F.col("net"))))
                .alias("__last")))
    return agg.select(F.col("mdn").cast("bigint").alias("mdn"), "session_id",
                      ((F.col("__stopped") == 0) & F.col("__last").isNotNull()).alias("is_open"),
                      F.col("__last.enbid").cast("bigint").alias("enbid"), F.col("__last.net").alias("net"))
