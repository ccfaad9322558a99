"""Late rows (survey ST-9): the slots that a micro-batch touched are computed anew.

A watermark closes windows and drops what comes later.  Here nothing is dropped: every
micro-batch's rows are stored under their slots, and the slots among them, whatever their
age, are recomputed from all stored rows and replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import write_partitioned
from .ingest import query_checkpoint, started


def touched_slots(stored: DataFrame, batch_id: int, slot_cols: Sequence[str]) -> DataFrame:
    """Slots in which a micro-batch has rows (read from partition names alone)."""
    return stored.where(F.col("load_id") == f"b{batch_id}").select(*slot_cols).distinct()


def refresh_touched_slots(events: DataFrame, rows_path: str, summary_path: str, name: str,
                          summarise: Callable[[DataFrame], DataFrame], slot_cols: Sequence[str] = ("d", "h", "m5"),
                          available_now: bool = True, trigger_seconds: int = 300) -> StreamingQuery:
    """ST-9: keep ``summary_path`` equal to ``summarise`` of all rows seen, late ones included.

    ``events`` (streaming) carries the slot columns as text.  A batch's rows are stored under
    (slot, batch), so a replayed batch replaces its own rows and no others.  ``summarise``
    gets all stored rows of the touched slots and must keep the slot columns; its result
    overwrites exactly those partitions, so files of other slots are neither read nor
    written."""
    slots = list(slot_cols)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        write_partitioned(batch, rows_path, slots, load_id=f"b{batch_id}")
        stored = spark.read.parquet(rows_path)
        touched = touched_slots(stored, batch_id, slots)
        # The outermost slot column of a batch has few values (days); as a filter on a
        # partition column it keeps the scan to them, the semi join to the slots.
        outer = [r[0] for r in touched.select(slots[0]).distinct().collect()]
        again = stored.where(F.col(slots[0]).isin(outer)).join(touched, slots, "left_semi")
        write_partitioned(summarise(again.drop("load_id")), summary_path, slots)

    writer = (events.writeStream.foreachBatch(refresh).queryName(name)
              .option("checkpointLocation", query_checkpoint(events.sparkSession, name)))
    return started(writer, available_now, trigger_seconds)
