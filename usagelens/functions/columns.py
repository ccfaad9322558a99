"""Column helpers (survey PRJ-1..37).

Every helper returns a ``Column`` (or a DataFrame for the few that change the row
set) built only from ``pyspark.sql.functions``, so each one stays inside
whole-stage codegen and is pushed through Catalyst like hand-written SQL.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- fixed values that must equal the reference's --------------------------------
# MME vendor success codes and attach procedure codes.
VENDOR_SUCCESS_CODES = {
    "huawei": ["0x0000"],
    "zte": ["4294967295"],
    "ericsson": ["nocausecode"],
}
VENDOR_ATTACH_PROCEDURES = {
    "huawei": ["0x00", "0x18"],
    "zte": ["2101", "2102"],
    "ericsson": ["attach"],
}
# 3G radius stop causes that count as a normal (user) logout; 4G uses
# the single cause "User-Request".
NORMAL_STOP_CAUSES_3G = ["1", "2", "3", "7", "8", "9", "11", "12", "13", "14", "15"]
NORMAL_STOP_CAUSE_4G = "User-Request"
# Customer size tiers (users >= 1000 -> A, >= 200 -> B, else C).
SIZE_TIERS = [(1000, "A"), (200, "B")]
SIZE_TIER_DEFAULT = "C"


# --- PRJ-1, PRJ-2: naming and typing ----------------------------------------------
def rename_positional(df: DataFrame, mapping: Mapping[str, str],
                      keep: Sequence[str] = ()) -> DataFrame:
    """PRJ-1: select positional columns (T0..Tn) under business names."""
    cols = [F.col(src).alias(dst) for src, dst in mapping.items()]
    return df.select(*cols, *keep)


def cast_all(df: DataFrame, type_name: str = "string") -> DataFrame:
    """PRJ-2: every column to one type (text by default)."""
    return df.select(*[F.col(c).cast(type_name).alias(c) for c in df.columns])


# --- PRJ-3, PRJ-4: vendor codes -----------------------------------------------------
def vendor_result(vendor: ColumnOrName, code: ColumnOrName,
                  success_codes: Mapping[str, Sequence[str]] = VENDOR_SUCCESS_CODES) -> Column:
    """PRJ-3: 'success' when ``code`` is the vendor's success code, else 'failed'."""
    expr = None
    for name, codes in success_codes.items():
        cond = (_c(vendor) == F.lit(name)) & _c(code).isin(*codes)
        expr = F.when(cond, F.lit("success")) if expr is None else expr.when(cond, F.lit("success"))
    return expr.otherwise(F.lit("failed"))


def is_attach(vendor: ColumnOrName, procedure: ColumnOrName,
              procedures: Mapping[str, Sequence[str]] = VENDOR_ATTACH_PROCEDURES) -> Column:
    """PRJ-4: 1 when the procedure is one of the vendor's attach procedures."""
    expr = None
    for name, codes in procedures.items():
        cond = (_c(vendor) == F.lit(name)) & _c(procedure).isin(*codes)
        expr = F.when(cond, F.lit(1)) if expr is None else expr.when(cond, F.lit(1))
    return expr.otherwise(F.lit(0))


# --- PRJ-5..7: time slots -----------------------------------------------------------
def time_partition(ts: ColumnOrName) -> dict[str, Column]:
    """PRJ-5: ``d`` = yyMMdd, ``h`` = HH, ``m5`` = minute floored to 5, zero padded."""
    t = _c(ts)
    return {
        "d": F.date_format(t, "yyMMdd"),
        "h": F.date_format(t, "HH"),
        "m5": F.lpad((F.floor(F.minute(t) / 5) * 5).cast("int").cast("string"), 2, "0"),
    }


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Seconds since the epoch; for TIMESTAMP_NTZ input this is zone independent."""
    return F.unix_timestamp(_c(ts))


def ntz_from_epoch(seconds: ColumnOrName) -> Column:
    """Wall-clock TIMESTAMP_NTZ for epoch seconds, independent of the session time
    zone (``timestamp_seconds`` would produce a zoned instant)."""
    return F.timestamp_add("SECOND", _c(seconds), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def bucket_ceil(ts: ColumnOrName, seconds: int, origin: int = 0) -> Column:
    """PRJ-6: end of the ``seconds``-long interval holding ``ts`` (relative to an origin
    epoch second), as a timestamp.  A time on a boundary is its own bucket end."""
    e = epoch_seconds(ts)
    return ntz_from_epoch(F.ceil((e - F.lit(origin)) / F.lit(seconds)) * F.lit(seconds) + F.lit(origin))


def bucket_floor(ts: ColumnOrName, seconds: int, origin: int = 0) -> Column:
    """Start of the ``seconds``-long interval holding ``ts``."""
    e = epoch_seconds(ts)
    return ntz_from_epoch(F.floor((e - F.lit(origin)) / F.lit(seconds)) * F.lit(seconds) + F.lit(origin))


def quarter_label(ts: ColumnOrName) -> Column:
    """PRJ-7: minute label of the next 15-minute mark inside the hour:
    ``floor(minute(ts + 15 min) / 15) * 15``, zero padded (00, 15, 30, 45)."""
    shifted = _c(ts) + F.expr("INTERVAL 15 MINUTES")
    return F.lpad((F.floor(F.minute(shifted) / 15) * 15).cast("int").cast("string"), 2, "0")


# --- PRJ-8..10: defaults ------------------------------------------------------------
def default_if_blank(col: ColumnOrName, sentinel: str) -> Column:
    """PRJ-8: null or empty text becomes ``sentinel``."""
    c = _c(col)
    return F.when(c.isNull() | (F.length(c) == 0), F.lit(sentinel)).otherwise(c)


def default_if_null(col: ColumnOrName, value) -> Column:
    """PRJ-9: ``nvl``."""
    return F.coalesce(_c(col), F.lit(value))


def default_via_if(key_present: Column, when_present: ColumnOrName, otherwise: ColumnOrName) -> Column:
    """PRJ-10: take ``when_present`` when the driving key matched, else ``otherwise``
    (column-wise merge driven by key presence, not by value nullness)."""
    return F.when(key_present, _c(when_present)).otherwise(_c(otherwise))


# --- PRJ-11..20: text transforms ----------------------------------------------------
def tac_of(imei: ColumnOrName, digits: int = 8) -> Column:
    """PRJ-11: type allocation code = first 8 characters of the IMEI."""
    return F.substring(_c(imei), 1, digits)


def hex_to_dec(col: ColumnOrName, prefix_len: int = 2) -> Column:
    """PRJ-12: ``conv(substr(x, 3), 16, 10)`` (drops a ``0x`` prefix)."""
    c = _c(col)
    return F.conv(c.substr(F.lit(prefix_len + 1), F.length(c)), 16, 10)


def dec_to_hex(col: ColumnOrName) -> Column:
    """PRJ-13: decimal text to upper-case hex text."""
    return F.upper(F.hex(_c(col).cast("bigint")))


def strip_words(col: ColumnOrName, words: Iterable[str]) -> Column:
    """PRJ-14: remove administrative words (regexp alternatives, literal match)."""
    import re
    pattern = "|".join(re.escape(w) for w in words)
    return F.regexp_replace(_c(col), pattern, "")


def drop_last_n(col: ColumnOrName, n: int) -> Column:
    """PRJ-15: all but the last ``n`` characters."""
    c = _c(col)
    return c.substr(F.lit(1), F.greatest(F.length(c) - F.lit(n), F.lit(0)))


def normalize_number(col: ColumnOrName, country: str = "86") -> Column:
    """PRJ-16: drop a leading international ``00`` and make sure the country code
    prefix is present."""
    c = F.regexp_replace(_c(col), "^00", "")
    return F.when(c.startswith(country), c).otherwise(F.concat(F.lit(country), c))


def section_key(col: ColumnOrName, length: int = 9) -> Column:
    """PRJ-17: number-section prefix used to join the number-section dimension."""
    return F.substring(_c(col), 1, length)


def domain_of(nai: ColumnOrName) -> Column:
    """PRJ-18: text after ``@`` of a network access identifier ('' when absent)."""
    return F.regexp_extract(_c(nai), "@(.*)$", 1)


def extract_tag(col: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """PRJ-19: pull a value out of free text, e.g. ``eNodeBId=([0-9]+)``."""
    return F.regexp_extract(_c(col), pattern, group)


def stop_time(start: ColumnOrName, duration_s: ColumnOrName) -> Column:
    """PRJ-20: start + duration seconds."""
    return ntz_from_epoch(epoch_seconds(start) + _c(duration_s).cast("bigint"))


def tag(df: DataFrame, **literals) -> DataFrame:
    """PRJ-21: constant columns (cycle, type, dimension labels)."""
    return df.withColumns({k: F.lit(v) for k, v in literals.items()})


def row_fingerprint(cols: Sequence[ColumnOrName], sep: str = "|",
                    null_token: str = "\\N") -> Column:
    """PRJ-22: md5 over the concatenated columns.  Nulls are replaced by a token so a
    null does not null the whole fingerprint (the reference's ``concat`` did)."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def compose_key(*cols: ColumnOrName, sep: str = "_") -> Column:
    """PRJ-23: ``_``-joined composite key."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def split_key(key: ColumnOrName, names: Sequence[str], sep: str = "_") -> list[Column]:
    """PRJ-23 inverse: split at the text ``sep`` into at most ``len(names)`` parts (the last
    keeps the rest)."""
    parts = F.split(_c(key), re.escape(sep), len(names))
    return [parts.getItem(i).alias(n) for i, n in enumerate(names)]


# --- PRJ-24..31: measures and classifications ---------------------------------------
def bytes_to_gb(col: ColumnOrName, scale: int = 2) -> Column:
    """PRJ-24: bytes / 1024^3, rounded."""
    return F.round(_c(col) / F.lit(1024 * 1024 * 1024), scale)


def round_div(num: ColumnOrName, den: ColumnOrName, scale: int = 4) -> Column:
    """Exact ``round(num / den, scale)`` (half up) for non-negative integer counts, done
    in integer arithmetic so every engine returns the same digits."""
    p = 10 ** scale
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    q = F.floor((n * F.lit(2 * p) + d) / (d * F.lit(2))).cast("bigint")
    return (q.cast("decimal(38,0)") / F.lit(p).cast("decimal(38,0)")).cast(f"decimal(38,{scale})")


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 4) -> Column:
    """PRJ-25: 0 when den <= 0; num/den (4 decimals) when den > num; else 1 (capped)."""
    n, d = _c(num), _c(den)
    return (F.when(d <= 0, F.lit(0).cast(f"decimal(38,{scale})"))
            .when(d > n, round_div(n, d, scale))
            .otherwise(F.lit(1).cast(f"decimal(38,{scale})"))).cast("double")


def ratio_or_zero(num: ColumnOrName, den: ColumnOrName) -> Column:
    """PRJ-26: num/den when den > 0 else 0 (numeric comparison, double division)."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def avg_per_user(total: ColumnOrName, users: ColumnOrName) -> Column:
    """PRJ-27: ``round(total / users, 0)``, 0 when there are no users."""
    t, u = _c(total).cast("double"), _c(users).cast("double")
    return F.when(u > 0, F.round(t / u, 0)).otherwise(F.lit(0.0))


def size_tier(n: ColumnOrName, tiers=SIZE_TIERS, default: str = SIZE_TIER_DEFAULT) -> Column:
    """PRJ-28: A/B/C tier by count thresholds (highest first)."""
    expr = None
    for threshold, label in tiers:
        cond = _c(n) >= threshold
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def decode(col: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """PRJ-29: simple ``case x when k then v`` decoding from a literal map."""
    expr = None
    for k, v in mapping.items():
        cond = _c(col) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(default))


def service_type(is_direct: ColumnOrName, is_vpdn: ColumnOrName, domains: ColumnOrName,
                 domain: ColumnOrName) -> Column:
    """PRJ-30: 'D' for direct users; 'C' for VPDN users that own ``domain``; else 'P'.

    ``domains`` is the user's comma list of VPDN domains."""
    owns = F.array_contains(F.split(_c(domains), ","), _c(domain))
    return (F.when(_c(is_direct) == "1", F.lit("D"))
            .when((_c(is_vpdn) == "1") & owns, F.lit("C"))
            .otherwise(F.lit("P")))


def radius_result(status: ColumnOrName, cause: ColumnOrName, net: ColumnOrName) -> Column:
    """PRJ-31: 's' normal stop, 'f' abnormal stop, ' ' not a stop.

    4G: normal iff cause = 'User-Request'; 3G: normal iff cause in the 3G set."""
    is_stop = _c(status) == "Stop"
    normal = F.when(_c(net) == "4g", _c(cause) == F.lit(NORMAL_STOP_CAUSE_4G)) \
        .otherwise(_c(cause).isin(*NORMAL_STOP_CAUSES_3G))
    return F.when(is_stop & normal, F.lit("s")).when(is_stop, F.lit("f")).otherwise(F.lit(" "))


# --- PRJ-32, PRJ-33: lists ----------------------------------------------------------
def explode_csv(df: DataFrame, col: str, out: str | None = None, sep: str = ",") -> DataFrame:
    """PRJ-32: one row per comma item."""
    return df.withColumn(out or col, F.explode(F.split(F.col(col), sep)))


def explode_unique(df: DataFrame, col: str, out: str | None = None, sep: str = ",") -> DataFrame:
    """PRJ-33: one row per distinct, non-empty comma item."""
    items = F.filter(F.array_distinct(F.split(F.col(col), sep)), lambda x: F.length(x) > 0)
    return df.withColumn(out or col, F.explode(items))


def zip_explode(df: DataFrame, cols: Sequence[str], sep: str = ",") -> DataFrame:
    """PRJ-33: parallel comma lists zipped position by position into rows."""
    rest = [c for c in df.columns if c not in cols]
    arrays = [F.split(F.col(c), sep).alias(c) for c in cols]
    return df.select(*rest, F.inline(F.arrays_zip(*arrays)))


# --- PRJ-34..37: time text ----------------------------------------------------------
def shift_time(text: ColumnOrName, fmt: str, seconds: int, out_fmt: str | None = None) -> Column:
    """PRJ-34: parse a time label, add seconds, format again."""
    t = F.to_timestamp_ntz(_c(text), F.lit(fmt))
    shifted = ntz_from_epoch(epoch_seconds(t) + F.lit(seconds))
    return F.date_format(shifted, out_fmt or fmt)


def time_interval(a: ColumnOrName, b: ColumnOrName, fmt: str | None = None) -> Column:
    """PRJ-35: seconds from ``a`` to ``b`` (labels parsed with ``fmt`` when given)."""
    ta = F.to_timestamp_ntz(_c(a), F.lit(fmt)) if fmt else _c(a)
    tb = F.to_timestamp_ntz(_c(b), F.lit(fmt)) if fmt else _c(b)
    return epoch_seconds(tb) - epoch_seconds(ta)


def week_bounds(d: ColumnOrName) -> dict[str, Column]:
    """PRJ-36: Monday-start week: day of week (1=Monday), first and last day."""
    day = F.to_date(_c(d))
    first = F.date_trunc("week", day).cast("date")
    return {"dow": ((F.dayofweek(day) + 5) % 7 + 1), "week_first": first,
            "week_last": F.date_add(first, 6)}


def month_bounds(d: ColumnOrName) -> dict[str, Column]:
    """PRJ-36: day of month, first and last day of the month."""
    day = F.to_date(_c(d))
    return {"dom": F.dayofmonth(day), "month_first": F.trunc(day, "month"),
            "month_last": F.last_day(day)}


def digits_only(col: ColumnOrName) -> Column:
    """PRJ-37: drop ``:``, ``-`` and spaces from a time text."""
    return F.regexp_replace(_c(col), "[: -]", "")
