"""Session construction and the few session-level settings the operators rely on.

Operators never build a session themselves; they take DataFrames.  Jobs and tests
call :func:`build_session`.  On a cluster the session already exists (spark-submit)
and :func:`configure` only fills in settings that are still unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants.  They are defaults: a value the cluster already set wins.
DEFAULTS = {
    # Text labels (d/h/m5, yyyyMMddHHmmss) must not depend on the JVM zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing, skew-join splitting, and
    # broadcast conversion decided on measured (not estimated) sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Re-running one time slot replaces only that slot's partitions.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values such as h=00 / m5=05 stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Non-Unicode source encodings (GBK logs) are decoded by the CSV/JSON readers.
    "spark.sql.legacy.javaCharsets": "true",
    # Arrow for the few pandas paths (tests).
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`DEFAULTS` where the session has no value yet."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "usagelens", extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests, the bench and examples (UI off, no server)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("USAGELENS_DRIVER_MEMORY", "16g")))
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value is always used.
    Only a ``local`` master (a laptop or a test) may leave it unset: a private temporary
    folder is taken then.  On any other master the driver's folder would be out of the
    executors' sight, so an unset value is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all "
                           f"executors share (master {sc.master})")
    local = tempfile.mkdtemp(prefix="usagelens-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a materialized table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared scratch folder and read back: for a result that
    a plan reads more than once and that costs more to compute twice than to write."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Spark deletes the shuffle files of a finished job at once where this is on, and otherwise when
# the driver's garbage collector meets the job, which may be after the end of the query.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_step(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored` for a step whose shuffles nobody reads again: their files go as soon as it
    is written, so that the steps of a query are not on disk together."""
    spark = df.sparkSession
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        return stored(df, name)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
