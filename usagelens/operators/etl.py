"""Log normalisation and enrichment (survey AN-46, AN-47).

Raw logs arrive with positional columns (``T0..Tn``, all text).  Normalisation is
one projection: rename by a per-type mapping (PRJ-1), cast measures once, derive
the time partition columns (PRJ-5) and drop rows missing required fields (FLT-5);
the result is written with ``partitionBy("d", "h", "m5")`` by the sinks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import joins as J


def normalize_log(raw: DataFrame, mapping: Mapping[str, str], time_col: str, time_fmt: str,
                  numeric: Sequence[str] = (), required: Sequence[str] = (),
                  extra: Mapping[str, Column] | None = None) -> DataFrame:
    """AN-46: positional → named columns, typed time, numeric casts (``try_cast`` so a
    dirty value becomes null instead of failing the job), d/h/m5 partitions, and a
    not-null / not-blank filter on ``required``."""
    named = C.rename_positional(raw, mapping)
    ts = F.to_timestamp_ntz(F.col(time_col), F.lit(time_fmt))
    out = named.withColumn(time_col, ts)
    for c in numeric:
        out = out.withColumn(c, F.col(c).try_cast("bigint"))
    if extra:
        out = out.withColumns(dict(extra))
    out = out.withColumns(C.time_partition(time_col))
    for c in required:
        out = out.where(F.col(c).isNotNull() & (F.length(F.col(c).cast("string")) > 0))
    return out


def enrich_log(log: DataFrame, users: DataFrame, devices: DataFrame, time_col: str,
               unknown: str = "-1") -> DataFrame:
    """AN-47: second-stage enrichment — company and domains of the user (left join,
    sentinel for unknown users), the terminal (TAC of the user's IMEI, PRJ-11,
    against the device table), a digits-only time text (PRJ-37) and the result
    flag."""
    u = users.select("mdn", "companycode", "vpdndomain", C.tac_of("imei").cast("bigint").alias("tac"))
    d = devices.select("tac", "modelname", "devicetype")
    j = log.join(J.sized(u), "mdn", "left").join(J.sized(d), "tac", "left")
    return j.select(*log.columns, C.default_if_blank("companycode", unknown).alias("companycode"),
                    C.default_if_blank("vpdndomain", unknown).alias("vpdndomain"),
                    C.default_if_null("modelname", unknown).alias("modelname"),
                    C.default_if_null("devicetype", unknown).alias("devicetype"),
                    C.digits_only(F.date_format(time_col, "yyyy-MM-dd HH:mm:ss")).alias("timekey"),
                    F.when(F.col("result") == "success", 1).otherwise(0).alias("result_flag"))


def normalize_mme(raw: DataFrame, hex_station_vendors: Sequence[str] = ("huawei",)) -> DataFrame:
    """AN-46 (MME logs): vendor-coded positional fields → result ('success'/'failed',
    PRJ-3), attach flag (PRJ-4), station id (hex text → decimal for vendors that log
    it in hex, PRJ-12), cause code and the d/h/m5 partitions (PRJ-5).

    ``raw``: vendor, T0 (msisdn), T1 (start time text), T8 (procedure code),
    T12 (station id text), T13 (cause code)."""
    station = F.when(F.col("vendor").isin(*hex_station_vendors), C.hex_to_dec("T12")).otherwise(F.col("T12"))
    ts = F.to_timestamp_ntz(F.col("T1"), F.lit("yyyy-MM-dd HH:mm:ss"))
    out = raw.select(F.col("T0").alias("msisdn"), ts.alias("starttime"), F.col("vendor").alias("mmetype"),
                     F.col("T8").alias("procedure"), station.alias("enbid"), F.col("T13").alias("pcause"),
                     C.vendor_result("vendor", "T13").alias("result"), C.is_attach("vendor", "T8").alias("isattach"))
    return out.withColumns(C.time_partition("starttime")).where(F.col("msisdn").isNotNull())
