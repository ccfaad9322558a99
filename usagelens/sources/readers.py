"""Sources (survey SRC-1..15).

Partitioned tables are read once at their base path and narrowed with predicates on
the partition columns, so Spark prunes partitions (and pushes the remaining filters
into the Parquet/ORC scan) instead of the job building path lists.  Text inputs are
parsed with column expressions (``split``/``size``), never with Python per line.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import predicates as P


def _reader(spark: SparkSession, fmt: str, schema: StructType | None = None):
    r = spark.read.format(fmt)
    return r.schema(schema) if schema is not None else r


def scan_partition(spark: SparkSession, path: str, fmt: str = "parquet", **partition: str) -> DataFrame:
    """SRC-1: one time partition (``d=.., h=.., m5=..``) — or a whole day when only
    ``d`` is given — as a pruned predicate on the partition columns."""
    df = _reader(spark, fmt).load(path)
    return df.where(P.partition_is(partition)) if partition else df


def scan_range(spark: SparkSession, path: str, col: str, lo: str, hi: str, fmt: str = "parquet",
               inclusive_hi: bool = True) -> DataFrame:
    """SRC-2: the partitions whose ``col`` lies in [lo, hi] (e.g. the 7 days of a week
    or the days of a month, yyMMdd labels compare as text)."""
    df = _reader(spark, fmt).load(path)
    upper = F.col(col) <= hi if inclusive_hi else F.col(col) < hi
    return df.where((F.col(col) >= lo) & upper)


def scan_with_base(spark: SparkSession, base: str, subpaths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """SRC-3: several sub-paths of one table, keeping the partition columns."""
    return spark.read.format(fmt).option("basePath", base).load([f"{base.rstrip('/')}/{p}" for p in subpaths])


def scan_json(spark: SparkSession, path: str, schema: StructType, corrupt_col: str | None = None) -> DataFrame:
    """SRC-4: JSON lines with an explicit schema (inference over hundreds of
    positional fields is unstable and costs an extra pass)."""
    r = spark.read.schema(schema)
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.json(path)


def scan_lines(spark: SparkSession, path: str, charset: str | None = None) -> DataFrame:
    """Raw lines (column ``value``), decoded from ``charset`` (e.g. GBK) when given.

    The text source hands on the bytes of a line as they are, so they are decoded line by
    line: blank lines and control characters stay.  The charset's line feed must be the
    single byte 0A (true for GBK, Latin-1 and the like, not for UTF-16)."""
    lines = spark.read.text(path)
    if not charset or charset.upper().replace("-", "") == "UTF8":
        return lines
    if charset.upper().startswith(("UTF-16", "UTF16", "UTF-32", "UTF32")):
        raise ValueError(f"{charset}: lines cannot be told apart byte by byte")
    # Spark 4 decodes only the standard Unicode / ASCII / Latin-1 charsets unless the full
    # Java charset list is enabled; GBK logs need it.
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return lines.select(F.decode(F.col("value").cast("binary"), charset).alias("value"))


def scan_encoded(spark: SparkSession, path: str, charset: str, fmt: str = "text",
                 schema: StructType | None = None) -> DataFrame:
    """SRC-5: decode non-UTF-8 input, then parse as JSON (``fmt="json"``) or return
    the lines for delimited parsing."""
    lines = scan_lines(spark, path, charset)
    if fmt == "json":
        if schema is None:
            raise ValueError("JSON parsing needs an explicit schema")
        objects = lines.where(F.json_object_keys("value").isNotNull())   # JSON objects only
        return objects.select(F.from_json("value", schema).alias("r")).select("r.*")
    return lines


def parse_delimited(lines: DataFrame, sep: str, names: Sequence[str], n_fields: int | None = None,
                    header_first_field: str | None = None, regex: bool = False,
                    first_line_is_header: bool = False) -> DataFrame:
    """SRC-6/7/8 on a DataFrame of lines: split on ``sep``; keep lines with exactly
    ``n_fields`` fields (a malformed line is dropped, not failed); drop header lines —
    those whose first field equals ``header_first_field``, or those equal to the input's
    first line (one line is read for it); name the fields."""
    if first_line_is_header:
        for header in lines.head(1):
            lines = lines.where(F.col("value") != header["value"])
    pattern = sep if regex else re.escape(sep)
    parts = F.split(F.col("value"), pattern, -1)
    n = n_fields or len(names)
    df = lines.select(parts.alias("p")).where(F.size("p") == n)
    if header_first_field is not None:
        df = df.where(F.col("p")[0] != header_first_field)
    return df.select(*[F.col("p")[i].alias(name) for i, name in enumerate(names)])


def scan_delimited(spark: SparkSession, path: str, sep: str, names: Sequence[str],
                   n_fields: int | None = None, header_first_field: str | None = None,
                   charset: str | None = None, first_line_is_header: bool = False) -> DataFrame:
    """SRC-6/7/8: delimited text (``,`` ``\\t`` ``|``) with field-count validation,
    header dropping and optional decoding."""
    return parse_delimited(scan_lines(spark, path, charset), sep, names, n_fields, header_first_field,
                           first_line_is_header=first_line_is_header)


def scan_delimited_observed(spark: SparkSession, path: str, sep: str, names: Sequence[str],
                            observation: Observation, charset: str | None = None) -> DataFrame:
    """SRC-6/8 with an account of what was dropped: :func:`scan_delimited`, and in the same
    pass ``observation`` counts ``lines``, ``kept`` and ``dropped`` ones and those with too
    few (``short``) or too many (``long``) fields.  The counts are there once an action over
    the rows has run to its end (``observation.get``); there is no second scan."""
    n = len(names)
    fields = F.size(F.split(F.col("value"), re.escape(sep), -1))
    lines = scan_lines(spark, path, charset).withColumn("__fields", fields)
    count = lambda when: F.count(F.when(when, 1))
    seen = F.col("__fields")
    observed = lines.observe(observation, F.count(F.lit(1)).alias("lines"), count(seen == n).alias("kept"),
                             count(seen != n).alias("dropped"), count(seen < n).alias("short"),
                             count(seen > n).alias("long"))
    return parse_delimited(observed.select("value"), sep, names)


def scan_table(spark: SparkSession, name: str, where: Column | None = None) -> DataFrame:
    """SRC-9: metastore table narrowed by a (partition) predicate."""
    df = spark.table(name)
    return df.where(where) if where is not None else df


def scan_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """SRC-10: relational table.  Credentials and driver come from the caller.  With a
    partition column the read is split into ``num_partitions`` range queries so it is
    not a single-task scan.  (Needs the JDBC driver on the classpath.)"""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
    return r.load()


def scan_keyed(spark: SparkSession, path: str, start: str, stop: str, names: Sequence[str],
               key_col: str = "rowkey", sep: str = "_", fmt: str = "parquet") -> DataFrame:
    """SRC-11: key-range scan of a keyed table (the key-value store re-aimed as a
    Parquet table sorted by key; the range predicate is pushed to the scan and
    prunes row groups), with the composite key split into named columns."""
    df = _reader(spark, fmt).load(path).where((F.col(key_col) >= start) & (F.col(key_col) < stop))
    parts = F.split(F.col(key_col), re.escape(sep), len(names))
    return df.select(*[parts[i].alias(n) for i, n in enumerate(names)],
                     *[c for c in df.columns if c != key_col])


def scan_optional(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """SRC-12: the input when it exists, otherwise an empty DataFrame of ``schema``
    (a missing 5-minute drop must not fail the slot)."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as e:
        if _path_missing(e):
            return spark.createDataFrame([], schema)
        raise


def _path_missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def scan_multi_vendor(spark: SparkSession, specs: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]],
                      charset: str | None = None) -> DataFrame:
    """SRC-13: for each (path pattern, parser) whose input exists, read the lines and
    parse them with that vendor's parser; union by column name (vendors may lack
    some columns).  Missing patterns are skipped."""
    frames = []
    for pattern, parser in specs:
        try:
            lines = scan_lines(spark, pattern, charset)
            lines.schema  # resolves the path now, so a missing input is skipped here
        except AnalysisException as e:
            if _path_missing(e):
                continue
            raise
        frames.append(parser(lines))
    if not frames:
        raise FileNotFoundError("none of the vendor inputs exists")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_vendors(spark: SparkSession, path: str, parsers: Mapping[str, Callable[[Column], Column]],
                 charset: str | None = None) -> DataFrame:
    """SRC-13 in one scan: every file under ``path`` is read once, and each line is parsed by
    the vendor whose pattern (a regular expression, the first that matches) occurs in the
    path of its file.

    A parser turns the line into a struct; all parsers must give the same fields, and a null
    struct drops the line (malformed).  Lines of files that no pattern names are dropped too.
    Missing vendors cost nothing; a missing folder is an error."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    origin = F.col("_metadata.file_path")
    value = F.col("value")
    if charset and charset.upper().replace("-", "") != "UTF8":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        value = F.decode(value.cast("binary"), charset)
    lines = lines.select(value.alias("value"), origin.alias("__origin"))
    record = None
    for pattern, parser in parsers.items():
        found = F.col("__origin").rlike(pattern)
        parsed = parser(F.col("value"))
        record = F.when(found, parsed) if record is None else record.when(found, parsed)
    if record is None:
        raise ValueError("no vendor parser is given")
    return lines.select(record.alias("r")).where(F.col("r").isNotNull()).select("r.*")


def kafka_stream(spark: SparkSession, servers: str, topics: str, starting_offsets: str = "latest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """SRC-14: Kafka records as a stream (key, value as text, topic, partition,
    offset, timestamp).  Offsets are tracked in the query checkpoint, not in an
    external store.  (Needs the Kafka connector package on the classpath.)"""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topics).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "topic",
                           "partition", "offset", "timestamp")


def text_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-15: new text files appearing in a directory, as a stream of lines."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(directory)


def file_stream(spark: SparkSession, directory: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet/JSON/CSV files in a directory as a stream (schema required)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(directory)


# Column layout of the externally computed online / offline / forecast
# series files.
GEO_SERIES_FIELDS = {
    "online": ["id", "custid", "prov", "city", "num"],
    "offline": ["id", "custid", "prov", "city", "cause", "num", "sessionNum"],
    "forecast": ["id", "custid", "prov", "city", "num", "low", "high", "fcst"],
}


def geo_series_load(spark: SparkSession, path: str, kind: str, level: str, cycle: str,
                    sep: str = ",", placeholder: str = "-") -> DataFrame:
    """AN-42: an externally computed series file (city, province or nation level)
    normalised to (cycle, level, custid, prov, city, measure, value): the levels a
    file does not carry get ``placeholder`` (``'-'``), every numeric field becomes a
    (measure, value) row, malformed lines are dropped (SRC-6/SRC-8)."""
    names = GEO_SERIES_FIELDS[kind]
    df = scan_delimited(spark, path, sep, names, header_first_field="id")
    if level in ("province", "nation"):
        df = df.withColumn("city", F.lit(placeholder))
    if level == "nation":
        df = df.withColumn("prov", F.lit(placeholder))
    measures = [c for c in names if c not in ("id", "custid", "prov", "city", "cause")]
    cause = F.col("cause") if "cause" in names else F.lit(placeholder)
    long = df.select(F.lit(cycle).alias("cycle"), F.lit(level).alias("level"), "custid", "prov", "city",
                     cause.alias("cause"), F.inline(F.array(*[
                         F.struct(F.lit(m).alias("measure"), F.col(m).try_cast("double").alias("value"))
                         for m in measures])))
    return long.where(F.col("value").isNotNull())
