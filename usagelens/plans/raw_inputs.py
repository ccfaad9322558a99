"""Stand-in raw logs: the test tables in the positional formats of :mod:`operators.formats`.

Like :mod:`inputs`, only names, casts and attributes; whole tables; texts as a sender would
write them.  Positions a sender leaves out are simply absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import inputs as I

FMT = "yyyy-MM-dd HH:mm:ss"
# Network flag of the usage records that each class of records stands for.
CDR_NET = {"pdsn": "A", "haccg": "N", "pgw": "R"}
AUTH_CLASSES = ("3g", "4g", "vpdn")
SECTION_SIZE = 100


def _text(c: str) -> F.Column:
    return F.col(c).cast("string")


def raw_cdr(spark: SparkSession, sf_dir: str, klass: str) -> DataFrame:
    """Raw usage records of a class; the time of day is the session number in seconds, and a
    gateway record without volume up to 3 has no last usage."""
    u = I.usage_records(spark, sf_dir).where(F.col("net") == CDR_NET[klass])
    at = F.date_format(F.timestamp_add("SECOND", F.col("session_id") % 86400, F.col("starttime")), FMT)
    if klass == "pgw":
        place = F.concat(F.lit("TAI=460;eNodeBId="), _text("enbid"), F.lit(";CELL="), F.col("cellid"))
        return u.select(F.concat(F.lit("46003"), _text("mdn")).alias("IMSI"), _text("mdn").alias("MDN"),
                        F.col("session_id").alias("T6"), F.concat(F.lit("apn."), "nai_domain").alias("T11"),
                        place.alias("T28"), F.when(F.col("upflow") > 3, at).alias("T46"),
                        F.col("upflow").alias("T50"), F.col("downflow").alias("T51"), _text("enbid").alias("T804"))
    return u.select(_text("mdn").alias("MDN"), _text("mdn").alias("T4"),
                    F.concat(_text("mdn"), F.lit("@"), "nai_domain").alias("T9"), F.col("session_id").alias("T12"),
                    F.col("gwaddress").alias("T19"), F.hex("enbid").alias("T21"), at.alias("T37"),
                    F.col("duration").alias("T53"), F.col("upflow").alias("T54"), F.col("downflow").alias("T55"),
                    F.lit("f").alias("T66"), F.col("cellid").alias("T806"))


def raw_auth(spark: SparkSession, sf_dir: str, klass: str) -> DataFrame:
    """Raw authentication log of a class: the events take turns; errors carry another code."""
    ev = I.table(spark, sf_dir, "events").where(F.col("event_id") % 3 == AUTH_CLASSES.index(klass))
    good = "1" if klass == "vpdn" else "0"
    return ev.select(F.when(F.col("event_type") == "error", F.get_json_object("props", "$.k")).otherwise(F.lit(good))
                     .alias("AUTH_RESULT"), F.date_format("ts", FMT).alias("auth_time"),
                     F.concat(F.lit("46003"), _text("user_id")).alias("imsicdma"), _text("user_id").alias("mdn"),
                     F.concat(_text("user_id"), F.lit("@d"), (F.col("event_id") % 7).cast("string")).alias("nai_sercode"),
                     F.concat(F.lit("10.2."), (F.col("event_id") % 9).cast("string")).alias("pcfip"),
                     F.concat(F.lit("ent"), (F.col("user_id") % 5).cast("string")).alias("entname"))


def _number() -> F.Column:
    """Subscriber number as an EPC record writes it: 00, country code, eleven digits."""
    return F.concat(F.lit("0086"), F.lpad(_text("mdn"), 9, "0"))


def raw_epc(spark: SparkSession, sf_dir: str, gateway: str) -> DataFrame:
    """Raw gateway records, one per usage record; some have no duration."""
    u = I.usage_records(spark, sf_dir)
    at = F.date_format(F.timestamp_add("SECOND", F.col("session_id") % 86400, F.col("starttime")), FMT)
    common = [_number().alias("mdn"), F.concat(F.lit("46003"), _text("mdn")).alias("imsi"), at.alias("t16"),
              F.when(F.col("duration") > 0, F.col("duration") * 60).alias("t17"), _text("enbid").alias("t804")]
    if gateway == "sgw":
        return u.select(*common, F.col("net").alias("t11"))
    return u.select(*common, F.col("upflow").alias("T50"), F.col("downflow").alias("T51"), F.col("net").alias("T35"),
                    at.alias("T46"))


def number_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number sections (the first nine digits cover SECTION_SIZE numbers) and where they were
    issued; every fourth section is not registered, every fifth belongs to the IOT network."""
    block = F.floor(F.col("c_custkey") / SECTION_SIZE)
    first = F.concat(F.lit("86"), F.lpad((block * SECTION_SIZE).cast("string"), 9, "0"))
    g = I.geo(spark, sf_dir)
    s = (I.table(spark, sf_dir, "customer").select(block.alias("block"), F.substring(first, 1, 9).alias("sectionno"))
         .distinct().where(F.col("block") % 4 != 3))
    return s.join(F.broadcast(g), F.col("block") % 25 == F.col("city_id")).select(
        "sectionno", F.col("prov").alias("atrb_pr"), F.col("prov").alias("user_pr"), F.col("city").alias("user_city"),
        F.when(F.col("block") % 5 == 0, "IOT").otherwise("CDMA").alias("network"))
