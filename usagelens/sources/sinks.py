"""Sinks (survey SNK-1..12).

Every write is idempotent per time slot: partitioned outputs use dynamic partition
overwrite, so re-running a slot replaces exactly that slot's partitions and a
retried task or a lost executor cannot leave half a slot behind.  Output files are
sized by AQE's rebalance (skew-aware) and ``maxRecordsPerFile`` instead of a fixed
``coalesce``, which would serialise the write into a few tasks.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.joins import sized
from ..session import scratch_path

TARGET_FILE_BYTES = 128 * 1024 * 1024


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet",
                      load_id: str | None = None, max_records_per_file: int | None = None,
                      rebalance: bool = True) -> None:
    """SNK-2/SNK-7: dynamic-partition overwrite of the partitions present in ``df``.

    With ``load_id`` the load id becomes the innermost partition column, so a re-run
    of the same load replaces only its own files and other loads' files in the same
    slot survive.  ``rebalance`` asks AQE to even out the partition sizes (splitting a
    hot partition over several tasks) before writing."""
    cols = list(partition_cols)
    out = df
    if load_id is not None:
        out = out.withColumn("load_id", F.lit(load_id))
        cols.append("load_id")
    if rebalance:
        out = out.hint("rebalance", *cols)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.format(fmt).save(path)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder of the file system ``path`` names; False if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _same_partition(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Null-safe equality of partition values (compared as text, as folders name them)."""
    out = F.lit(True)
    for c in cols:
        out = out & left[c].cast("string").eqNullSafe(right[c].cast("string"))
    return out


def replace_where(new: DataFrame, path: str, predicate: Column, partition_cols: Sequence[str],
                  fmt: str = "parquet") -> None:
    """SNK-7 by predicate: the stored rows for which ``predicate`` holds go, ``new`` comes.

    Only partitions that hold such rows or get new ones are rewritten: their other rows and
    the new ones are put together in a staging folder, which then overwrites exactly those
    partitions, so the job never writes to what it is reading.  A partition of which nothing
    is left is removed.  Every new row must satisfy the predicate: a run that was cut short
    and is started again then replaces its own rows.  A null predicate keeps the row."""
    spark = new.sparkSession
    cols = list(partition_cols)
    hit = F.coalesce(predicate, F.lit(False))
    if not new.where(~hit).isEmpty():
        raise ValueError("new rows outside the predicate would not be replaced by a second run")
    stored = spark.read.format(fmt).load(path)
    staging = scratch_path(spark, f"replace-{uuid.uuid4().hex}")
    touched = stored.where(hit).select(*cols).unionByName(new.select(*cols)).distinct()
    touched.write.parquet(f"{staging}/touched")
    touched = spark.read.schema(touched.schema).parquet(f"{staging}/touched")
    kept = stored.join(sized(touched), _same_partition(stored, touched, cols), "left_semi").where(~hit)
    write_partitioned(kept.unionByName(new), f"{staging}/rows", cols, fmt)
    rows = spark.read.format(fmt).schema(stored.schema).load(f"{staging}/rows")
    left = rows.select(*cols).distinct()
    # Folders of touched partitions that keep no row (one name per folder, not per row).
    emptied = touched.join(left, _same_partition(touched, left, cols), "left_anti")
    files = spark.read.format("binaryFile").load(path)
    folders = files.join(emptied, _same_partition(files, emptied, cols), "left_semi").select(
        F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect()
    write_partitioned(rows, path, cols, fmt)
    for r in folders:
        remove_path(spark, r["folder"])
    remove_path(spark, staging)


def write_partition(df: DataFrame, path: str, partition: Mapping[str, str], fmt: str = "parquet") -> None:
    """SNK-1: overwrite one time partition (``d``/``h``/``m5`` given as values)."""
    write_partitioned(df.withColumns({k: F.lit(v) for k, v in partition.items()}), path, list(partition), fmt)


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> None:
    """SNK-3: report export.  ``single_file`` (one output file) is only for small,
    already-aggregated reports: it funnels the write through one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", str(header).lower()).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """SNK-4: JSON-lines export (documents for a search index)."""
    df.write.mode("overwrite").json(path)


def write_text(df: DataFrame, path: str, cols: Sequence[str], sep: str = "|",
               partition_col: str | None = None) -> None:
    """SNK-5: delimited lines, optionally one folder per value of ``partition_col``."""
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("value")
    if partition_col:
        df.select(line, partition_col).write.mode("overwrite").partitionBy(partition_col).text(path)
    else:
        df.select(line).write.mode("overwrite").text(path)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-6: insert-or-update by key as a DataFrame: existing rows whose key is not
    in ``new`` (left-anti join) plus all new rows.  Write the result to a new
    location (or a new partition) and swap — no driver-side loop."""
    kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
               mode: str = "append", batch_size: int = 1000, num_partitions: int | None = None) -> None:
    """SNK-6 (relational form): executors write their partitions in batches of
    ``batch_size`` (the reference upserted from the driver after a ``collect``).
    Upsert semantics: write into a staging table, then merge in the database."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batch_size))
    for k, v in properties.items():
        w = w.option(k, v)
    w.mode(mode).save()


def keyed_rows(df: DataFrame, key_cols: Sequence[str], slot_col: str, metrics: Sequence[str],
               slot_seconds: int = 300) -> DataFrame:
    """SNK-8: a slot's metrics as tall keyed rows: the current value under its own
    slot (``c``), the same value as the *previous* value of the next slot (``p``),
    and the running day total up to the slot (``d``; the window is one entity's
    metric over one day, at most one row per slot).  Keys are
    ``key1_key2_..._yyyyMMddHHmm`` so a key-range scan (SRC-11) reads one entity's
    slots in time order."""
    long = df.select(*key_cols, slot_col, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))
    nxt = C.ntz_from_epoch(C.epoch_seconds(slot_col) + slot_seconds)
    day = F.to_date(slot_col)
    w = Window.partitionBy(*key_cols, "metric", day).orderBy(slot_col).rowsBetween(Window.unboundedPreceding, 0)
    cur = long.select(*key_cols, F.col(slot_col).alias("slot"), "metric", F.lit("c").alias("kind"), "value")
    prev = long.select(*key_cols, nxt.alias("slot"), "metric", F.lit("p").alias("kind"), "value")
    tot = long.select(*key_cols, F.col(slot_col).alias("slot"), "metric", F.lit("d").alias("kind"),
                      F.sum("value").over(w).alias("value"))
    out = cur.unionByName(prev).unionByName(tot)
    return out.withColumn("rowkey", C.compose_key(*key_cols, F.date_format("slot", "yyyyMMddHHmm")))


def write_encoded(df: DataFrame, path: str, charset: str, line_col: str = "value") -> None:
    """SRC-5, the way out: lines of text in another charset (GBK), one per row.

    Lines are encoded to bytes and written as they are, so blank lines and control characters
    stay.  A line feed inside a line would make two of it, and a character that the charset
    lacks would be lost: both fail the write."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    line = F.coalesce(F.col(line_col).cast("string"), F.lit(""))
    whole = F.when(F.contains(line, F.lit("\n")), F.raise_error(F.lit("line feed inside a line")).cast("string")
                   ).otherwise(line)
    df.select(F.encode(whole, charset).cast("string").alias("value")).write.mode("overwrite").text(path)


def insert_into_table(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """SNK-9: append (or dynamically overwrite) into a partitioned catalog table."""
    df.write.insertInto(table, overwrite=overwrite)


def register_partitions(spark: SparkSession, table: str) -> None:
    """SNK-10: make partitions written by path visible to the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file metadata only; the binary-file
    source does not read file contents when only ``length`` is selected)."""
    sizes = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .agg(F.sum("length").alias("b")).collect())
    return int(sizes[0]["b"] or 0)


def compact(spark: SparkSession, path: str, out_path: str, fmt: str = "parquet",
            target_bytes: int = TARGET_FILE_BYTES, partition_cols: Sequence[str] = ()) -> int:
    """SNK-11: rewrite ``path`` into files of about ``target_bytes`` at ``out_path``.

    The sizes come from file metadata alone.  Unpartitioned: ``ceil(bytes / target)`` files;
    returns their number.  Partitioned: every partition gets that many files for its own
    bytes, each written by a task of its own, so a large partition is spread over many tasks
    and a small one is a single file; rows are dealt round robin within a partition.  Returns
    the bytes planned for the largest file (at most ``target_bytes``)."""
    if not partition_cols:
        n = max(1, math.ceil(input_bytes(spark, path) / target_bytes))
        spark.read.format(fmt).load(path).repartition(n).write.mode("overwrite").format(fmt).save(out_path)
        return n
    cols = list(partition_cols)
    plan = file_plan(spark, path, cols, target_bytes)
    total, largest = plan.agg(F.sum("__files"), F.max(F.ceil(F.col("__bytes") / F.col("__files")))).first()
    if not total:
        return 0
    rows = spark.read.format(fmt).load(path)
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"r.{c}").cast("string").eqNullSafe(F.col(f"p.{c}"))
    turn = F.pmod(F.monotonically_increasing_id(), F.col("p.__files"))
    dealt = (rows.alias("r").join(sized(plan).alias("p"), same)
             .select("r.*", (F.col("p.__first") + turn).cast("int").alias("__task"))
             .repartitionById(int(total), F.col("__task")).drop("__task"))
    (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
     .format(fmt).save(out_path))
    return int(largest)


def file_plan(spark: SparkSession, path: str, partition_cols: Sequence[str], target_bytes: int) -> DataFrame:
    """Per partition (values as text): ``__files``, its number of files at ``target_bytes``, and
    ``__first``, the files of the partitions before it.  Reads file metadata only."""
    cols = list(partition_cols)
    sizes = (spark.read.format("binaryFile").load(path).groupBy(*[F.col(c).cast("string").alias(c) for c in cols])
             .agg(F.sum("length").alias("__bytes")))
    files = sizes.where(F.col("__bytes") > 0).withColumn("__files", F.ceil(F.col("__bytes") / target_bytes))
    # One row per partition folder: the driver lists them all anyway to plan the scan.
    before = Window.orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("__first", F.coalesce(F.sum("__files").over(before), F.lit(0)))


def advance_breakpoint(state: DataFrame, updates: DataFrame) -> DataFrame:
    """SNK-12: monotone (current, last) cycle per job name.  ``state``: (name, curr,
    last); ``updates``: (name, cycle).  A cycle at or after the current one becomes the
    current, and the one before it the last: a re-run of the current cycle therefore sets
    ``last`` to it too, as the reference does.  A cycle between the two becomes the last; an
    older one changes nothing.  So the two are the greatest of all cycles seen, in whatever
    order they come."""
    values = (state.select("name", F.col("curr").alias("cycle"))
              .unionAll(state.select("name", F.col("last").alias("cycle")))
              .unionAll(updates.select("name", "cycle"))).where(F.col("cycle").isNotNull())
    order = Window.partitionBy("name").orderBy(F.col("cycle").desc())
    top = values.withColumn("__k", F.row_number().over(order)).where(F.col("__k") <= 2)
    return top.groupBy("name").agg(F.max(F.when(F.col("__k") == 1, F.col("cycle"))).alias("curr"),
                                   F.max(F.when(F.col("__k") == 2, F.col("cycle"))).alias("last"))


BREAKPOINTS = "name string, curr string, last string"


def stored_breakpoints(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Breakpoints as the last step (below ``before``) left them; empty before the first."""
    try:
        steps = spark.read.schema(f"{BREAKPOINTS}, step string").parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], BREAKPOINTS)
    number = F.col("step").cast("bigint")
    known = steps if before is None else steps.where(number < before)
    newest = known.agg(F.max(number)).first()[0]
    return known.where(number == newest).drop("step")


def advance_stored_breakpoint(updates: DataFrame, path: str, step: int) -> None:
    """SNK-12 as kept state: read, advance and write back in one step that may be repeated.

    ``step`` numbers the runs upwards (a micro-batch's id, a cycle's number).  A step starts
    from the newest state below its number and overwrites its own, so running it again, after
    a failure or by mistake, gives the same state and no cycle counts twice."""
    spark = updates.sparkSession
    now = advance_breakpoint(stored_breakpoints(spark, path, step), updates)
    now.write.mode("overwrite").parquet(f"{path}/step={step}")
