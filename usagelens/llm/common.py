"""Helpers shared by the operators: input columns, scratch tables, shipping the package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import configure, scratch_path

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Rows and bytes per Arrow batch handed to Python: bound a worker's memory, also with long
# texts (a single longer text is a batch of its own).
ARROW_ROWS = 1000
ARROW_BYTES = 8_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators and the package on every executor.

    The limits on Arrow batches hold for the whole session: plans are lazy and read them when
    they run.

    The package travels as a zip through Spark's own file distribution, so workers
    import it (and keep their caches between tasks) wherever they run.
    """
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if not getattr(sc, "_usagelens_llm_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="usagelens-llm-"), "usagelens_llm.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        sc._usagelens_llm_shipped = True
    return spark


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage on shared storage: a lost executor re-reads files instead of
    recomputing, and several readers see the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_bucket(doc_id, modulus: int):
    """crc32 of the id as text modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def batches(rows: list, size_of, limit: int) -> Iterator[list]:
    """Cut a list into runs whose sizes add up to about ``limit``."""
    run, total = [], 0
    for r in rows:
        run.append(r)
        total += size_of(r)
        if total >= limit:
            yield run
            run, total = [], 0
    if run:
        yield run


def run_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Start index of every run of equal values of a sorted array."""
    if len(sorted_keys) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64 constants), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def set_aside(docs: DataFrame):
    """``docs`` as (doc_id, text, rest) with all other columns in one struct, whatever their
    names, and the function that gives a result of that form its columns back."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)] or [F.lit(0).alias("c")])

    def back(df: DataFrame, *added: str) -> DataFrame:
        columns = [F.col(c) if c in ("doc_id", "text") else F.col(f"rest.c{others.index(c)}").alias(c)
                   for c in docs.columns]
        return df.select(*columns, *added)

    return docs.select("doc_id", "text", rest.alias("rest")), back


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a distinct long ``row`` in document order and null texts as empty.

    Distinct non-null ids number the rows themselves.  Otherwise rows are sorted by id
    (nulls first), then text, and numbered in that order.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    repeated = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if repeated.isEmpty():
        return docs.withColumn("text", text).withColumn("row", F.col("doc_id").cast("long"))
    return materialize(docs.withColumn("text", text).orderBy("doc_id", "text")
                       .withColumn("row", F.monotonically_increasing_id()), "numbered-texts")
