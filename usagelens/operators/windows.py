"""Window shapes (survey WN-1..12).

Ranks are computed on already-aggregated rows (one row per group member), with a
unique tie-break as the last order column so results are deterministic.  Top-N
filters keep the ``row_number() <= n`` shape so Spark inserts a partial
WindowGroupLimit before the shuffle.  "Latest per key" is an aggregate
(``max_by``), not a window, so it combines map-side and is immune to hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored_step
from .joins import sized


def _order(cols: Sequence[str | Column], ascending: bool) -> list[Column]:
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        out.append(col.asc() if ascending else col.desc())
    return out


def rank_within(df: DataFrame, partition: Sequence[str], order: Sequence[str | Column],
                out: str = "rank", ascending: bool = False,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """WN-1/WN-2/WN-4: ``row_number()`` per partition by measure(s); ``tiebreak``
    columns (ascending) make the order total."""
    w = Window.partitionBy(*partition).orderBy(*_order(order, ascending),
                                               *[F.col(t).asc() for t in tiebreak])
    return df.withColumn(out, F.row_number().over(w))


def ranks_within(df: DataFrame, partition: Sequence[str], measures: Sequence[str],
                 ascending: bool = False, tiebreak: Sequence[str] = (),
                 suffix: str = "_rank") -> DataFrame:
    """WN-3: one rank column per measure.  All windows share the partitioning, so
    Spark shuffles once and only re-sorts per measure."""
    out = df
    for m in measures:
        out = rank_within(out, partition, [m], f"{m}{suffix}", ascending, tiebreak)
    return out


def with_exact_ratio(df: DataFrame, num: str, den: str, names: Sequence[str]) -> DataFrame:
    """Three whole columns ``names`` that order rows as the exact quotient ``num / den`` does.

    Double division makes unlike quotients of large sums alike, and two engines may round
    them differently.  Long division in whole numbers does not: the whole part and two blocks
    of 18 decimal digits tell apart any two quotients of 63-bit numbers whose denominators
    are below 10^18, and equal quotients (1/3 and 2/6) get equal digits.  ``num`` is not
    negative; a denominator that is null or not above zero gives nulls."""
    whole, first, second = names
    shifted = "CAST(__rest * CAST(1000000000000000000 AS DECIMAL(19,0)) AS DECIMAL(38,0))"
    out = df.withColumns({"__num": F.col(num).cast("decimal(38,0)"),
                          "__den": F.when(F.col(den) > 0, F.col(den).cast("decimal(38,0)"))})
    out = out.withColumns({whole: F.expr("__num div __den"), "__rest": F.expr("__num % __den")})
    out = out.withColumns({first: F.expr(f"{shifted} div __den"), "__rest": F.expr(f"{shifted} % __den")})
    return out.withColumn(second, F.expr(f"{shifted} div __den")).drop("__num", "__den", "__rest")


def rank_by_ratio(df: DataFrame, partition: Sequence[str], num: str, den: str, out: str = "rank",
                  below: int | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """WN-4: ``row_number()`` by the exact ratio ``num / den``, highest first, equal ratios by
    the greater ``den``, then by ``tiebreak`` ascending; ranks from ``below`` on are left out
    (the filter keeps the shape from which Spark drops rows before the shuffle).  Rows whose
    denominator is not above zero come last."""
    digits = ["__ratio_0", "__ratio_1", "__ratio_2"]
    w = Window.partitionBy(*partition).orderBy(*[F.col(d).desc_nulls_last() for d in digits],
                                               F.col(den).desc_nulls_last(), *[F.col(t).asc() for t in tiebreak])
    ranked = with_exact_ratio(df, num, den, digits).withColumn(out, F.row_number().over(w)).drop(*digits)
    return ranked if below is None else ranked.where(F.col(out) < below)


def top_n(df: DataFrame, partition: Sequence[str], order: Sequence[str | Column], n: int,
          out: str = "rank", ascending: bool = False, tiebreak: Sequence[str] = ()) -> DataFrame:
    """WN-7: keep ranks below ``n`` (the reference keeps ``rank < 1000``)."""
    return rank_within(df, partition, order, out, ascending, tiebreak).where(F.col(out) < n)


def global_rank(df: DataFrame, order: Sequence[str], out: str = "rank",
                ascending: bool = False, tiebreak: Sequence[str] = ()) -> DataFrame:
    """WN-8: position of every row in one global order, without an unpartitioned
    window over the rows (which would pull them all into one task): positions inside
    one all-embracing group, see :func:`positions_within`."""
    ranked = positions_within(df, [], [*[(c, ascending) for c in order],
                                       *[(c, True) for c in tiebreak]], out, "__n")
    return ranked.withColumn(out, F.col(out).cast("int")).drop("__n")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   cols: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """WN-5: the row with the greatest ``order_col`` per key (``row_number() = 1`` by
    time desc), as a ``max_by`` aggregate over a struct so it combines map-side."""
    order = F.struct(F.col(order_col), *[F.col(t) for t in tiebreak])
    picked = F.max_by(F.struct(*[F.col(c) for c in cols]), order)
    return df.groupBy(*keys).agg(picked.alias("__p")).select(*keys, "__p.*")


def any_per_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """WN-6: one row per key where the reference took an arbitrary one; made
    deterministic as the smallest row (min over a struct)."""
    picked = F.min(F.struct(*[F.col(c) for c in cols]))
    return df.groupBy(*keys).agg(picked.alias("__p")).select(*keys, "__p.*")


def position_trim(df: DataFrame, partition: Sequence[str], order_col: str, lo: int = 10,
                  hi: int = 90, tiebreak: Sequence[str] = ()) -> DataFrame:
    """WN-9: keep rows whose position percentile ``row_number*100/count`` is strictly
    between ``lo`` and ``hi`` (ascending by ``order_col``)."""
    w = Window.partitionBy(*partition).orderBy(F.col(order_col).asc(), *[F.col(t).asc() for t in tiebreak])
    wc = Window.partitionBy(*partition)
    pct = F.row_number().over(w) * 100 / F.count(F.lit(1)).over(wc)
    return df.withColumn("__pct", pct).where((F.col("__pct") > lo) & (F.col("__pct") < hi)).drop("__pct")


def previous_slot(df: DataFrame, keys: Sequence[str], slot_col: str, value_cols: Sequence[str],
                  prefix: str = "p_", step_seconds: int | None = None) -> DataFrame:
    """WN-10: value of the previous slot per key (``lag``).  With ``step_seconds`` the
    previous row only counts when it is exactly one slot earlier (dense axis);
    otherwise the value is null."""
    w = Window.partitionBy(*keys).orderBy(slot_col)
    out = df
    for c in value_cols:
        prev = F.lag(c, 1).over(w)
        if step_seconds is not None:
            gap = F.unix_timestamp(F.col(slot_col)) - F.unix_timestamp(F.lag(slot_col, 1).over(w))
            prev = F.when(gap == step_seconds, prev)
        out = out.withColumn(f"{prefix}{c}", prev)
    return out


def same_slot_days_ago(df: DataFrame, keys: Sequence[str], day_col: str, slot_col: str,
                       value_cols: Sequence[str], days: int = 7, prefix: str = "h_") -> DataFrame:
    """WN-11: value at the same time-of-day slot ``days`` days earlier (equi self join
    on (key, slot, day - days)); null when that day has no row."""
    hist = df.select(*keys, slot_col, F.date_add(F.col(day_col), days).alias(day_col),
                     *[F.col(c).alias(f"{prefix}{c}") for c in value_cols])
    return df.join(hist, [*keys, slot_col, day_col], "left")


def drop_min_max_sum(df: DataFrame, keys: Sequence[str], value_col: str, n_days: int,
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """WN-12: per key, the sum of values ranked 2..n_days-1 (ascending), i.e. without
    the smallest and the largest, plus the number of rows seen."""
    w = Window.partitionBy(*keys).orderBy(F.col(value_col).asc(), *[F.col(t).asc() for t in tiebreak])
    ranked = df.withColumn("__rn", F.row_number().over(w))
    keep = (F.col("__rn") >= 2) & (F.col("__rn") <= n_days - 1)
    return ranked.groupBy(*keys).agg(
        F.sum(F.when(keep, F.col(value_col)).otherwise(F.lit(0))).alias("trimmed_sum"),
        F.sum(F.col(value_col)).alias("total_sum"),
        F.count(F.lit(1)).alias("n_rows"))


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


INTEGERS = ("tinyint", "smallint", "int", "bigint")
STEPS = 16            # buckets per doubling of a number: few, as every bucket costs a window its set-up
EXACT = 16            # below this distance from zero a bucket holds one whole number


def _bucket(df: DataFrame, column: str, steps: int = STEPS) -> Column:
    """A coarse key that never decreases from a smaller value of ``column`` to a greater one.

    Numbers: ``steps`` steps per doubling of the distance from zero; dates and times: the day;
    text: its first four characters; anything else: one bucket.  Nulls stay null."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    if kind.startswith(NUMBERS):
        x = c.cast("double")
        far = F.floor(F.log2(F.abs(x) + 1) * steps)
        step = F.when(F.isnan(x), F.lit(1 << 40)).when(x < 0, -far).otherwise(far)
        return F.when(x.isNotNull(), step)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_date(F.to_date(c))
    if kind == "string":
        return F.substring(column, 1, 4)
    return F.lit(0)


def _one_value(df: DataFrame, column: str) -> Column:
    """Whether the bucket of a row is known to hold a single value (or null) of ``column``."""
    c = F.col(column)
    if dict(df.dtypes)[column] in INTEGERS:
        return c.isNull() | (F.abs(c.cast("double")) < EXACT)
    return c.isNull()


def _directed(column: Column, ascending: bool) -> Column:
    """Nulls first ascending and last descending."""
    return column.asc_nulls_first() if ascending else column.desc_nulls_last()


def positions_within(df: DataFrame, partition: Sequence[str],
                     order: Sequence[str | tuple[str, bool]], pos: str = "__pos",
                     size: str = "__n") -> DataFrame:
    """Exact 1-based position of each row inside its group and the group size.

    ``order`` must make the rows of a group unique; entries are column names
    (ascending) or (name, ascending) pairs; nulls come first ascending and last
    descending, and null group keys form a group like any other.

    A window over the group would sort it in one task, and one group may hold a third
    of the data.  Here rows are numbered only among rows of one group that share a narrow,
    order-preserving bucket of the first order column; where such a bucket holds one value
    (nulls and whole numbers near zero, the ones that many rows share), it is split again by
    a bucket of the second column.  The rows before them come from counts per bucket.  The
    rows are read twice, for the counts and for the numbers, and shuffled once: counts and
    windows share their keys.  It is one lazy plan, the same at every size."""
    pairs = [(o, True) if isinstance(o, str) else o for o in order]
    cols = [_directed(F.col(c), up) for c, up in pairs]
    value, up = pairs[0]
    second, up2 = pairs[1] if len(pairs) > 1 else (None, True)
    group = _never_null(df, {f"__g{i}": F.col(c) for i, c in enumerate(partition)}) or {"__g0": F.lit(0)}
    bucket = {**group, **_never_null(df, {"__b1": _bucket(df, value)})}
    split = F.when(_one_value(df, value), _bucket(df, second)) if second else F.lit(0)
    key = {**bucket, **_never_null(df, {"__b2": split})}
    rows = df.withColumns(key)

    def ordered(name: str, ascending: bool) -> list[Column]:
        """The order of a key column whose nulls stand in a column of their own."""
        flag = [_directed(F.col(f"{name}_null"), not ascending)] if f"{name}_null" in key else []
        return [*flag, _directed(F.col(name), ascending)]

    before = lambda w: F.coalesce(F.sum("__c").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fine = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__c"))
    coarse = fine.groupBy(*bucket).agg(F.sum("__c").alias("__c"))
    groups = Window.partitionBy(*group)
    coarse = coarse.select(*bucket, before(groups.orderBy(*ordered("__b1", up))).alias("__before"),
                           F.sum("__c").over(groups).alias(size))
    inside = Window.partitionBy(*bucket).orderBy(*ordered("__b2", up2))
    offsets = (fine.withColumn("__off", before(inside)).join(coarse, list(bucket))
               .select(*key, (F.col("__before") + F.col("__off")).alias("__first"), size))
    numbered = rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*key).orderBy(*cols)))
    return (numbered.join(offsets, list(key)).withColumn(pos, F.col("__first") + F.col("__rn"))
            .drop(*key, "__first", "__rn"))


STAND_INS = {"string": "", "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01", "boolean": False}


def _never_null(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, Column]:
    """Key columns in which nulls equal each other under plain equality, so that groups, windows
    and joins on them share one partitioning: a stand-in, and a flag beside it."""
    kinds = dict(df.select(*[c.alias(n) for n, c in columns.items()]).dtypes)
    fields = {f.name: f.nullable for f in df.select(*[c.alias(n) for n, c in columns.items()]).schema.fields}
    out: dict[str, Column] = {}
    for name, c in columns.items():
        if not fields[name]:
            out[name] = c
        else:
            out[f"{name}_null"] = c.isNull()
            out[name] = F.coalesce(c, F.lit(STAND_INS.get(kinds[name], 0)).cast(kinds[name]))
    return out


def position_trim_skew_safe(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                            lo: int = 10, hi: int = 90) -> DataFrame:
    """WN-9 for groups that grow with the data: the rows of :func:`position_trim`
    (``pos*100/n`` strictly between ``lo`` and ``hi``), with the positions of
    :func:`positions_within`, which spread a hot group over many tasks."""
    return positions_within(df, partition, order).where(within_percent(lo, hi)).drop("__pos", "__n")


def within_percent(lo: int, hi: int, pos: str = "__pos", size: str = "__n") -> Column:
    """Position percentile strictly between ``lo`` and ``hi``."""
    pct = F.col(pos) * 100 / F.col(size)
    return (pct > lo) & (pct < hi)


FINE_STEPS = 4096     # buckets per doubling of a number, within one coarse bucket


def trim_cuts(df: DataFrame, partition: Sequence[str], order: Sequence[str], lo: int = 10, hi: int = 90) -> DataFrame:
    """WN-9 without numbering the rows: the rows between which :func:`within_percent` of a row's
    position in its group (ascending by ``order``, nulls first) lies.

    One row per group that keeps any: ``partition``, structs ``__from`` and ``__to`` of the
    ``order`` values at the first and the last kept position, and ``__n_from`` / ``__n_to``: how
    many of the rows with just those values are kept (``__n_to`` 0 where they are the same ones).
    The positions are found by counts alone: per bucket of the first column, then inside the bucket
    that holds the position per finer bucket, per value, and so on for the next column.  ``df`` is
    read once for each of these steps and should be stored; nothing but counts is shuffled, and
    the group keys must not be null."""
    keys: list[Column] = []
    exact: dict[str, str] = {}
    for c in order:
        keys += [_bucket(df, c), *([_bucket(df, c, FINE_STEPS)] if dict(df.dtypes)[c].startswith(NUMBERS) else []), F.col(c)]
        exact[c] = f"__at{len(keys) - 1}"
    rows = df.select(*partition, *[k.alias(f"__k{i}") for i, k in enumerate(keys)])
    # Counts per bucket for the whole group give its size and so the two positions to look for.
    groups = Window.partitionBy(*partition)
    by_key = lambda w, i: F.sum("__c").over(w.orderBy(F.col(f"__k{i}").asc_nulls_first()))
    counts = (rows.groupBy(*partition, "__k0").agg(F.count(F.lit(1)).alias("__c"))
              .withColumns({"__upto": by_key(groups, 0), "__n": F.sum("__c").over(groups)}))
    first, last = F.expr(f"greatest(__n * {lo} div 100 + 1, 1)"), F.expr(f"least((__n * {hi} - 1) div 100, __n)")
    side = lambda k, place: F.struct(F.lit(k).alias("__side"), place.alias("__place"))
    counts = counts.where(first <= last).select("*", F.inline(F.array(side(0, first), side(1, last))))
    known: list[str] = []
    for i in range(len(keys)):
        if i:
            found = rows.join(sized(at), list(partition))
            for j in range(i):
                found = found.where(F.col(f"__k{j}").eqNullSafe(F.col(f"__at{j}")))
            counts = found.groupBy(*partition, "__side", "__place", "__before", *known, f"__k{i}").agg(F.count(F.lit(1)).alias("__c"))
            counts = counts.withColumn("__upto", F.col("__before") + by_key(Window.partitionBy(*partition, "__side"), i))
        below = F.col("__upto") - F.col("__c")
        at = stored_step(counts.where((F.col("__upto") >= F.col("__place")) & (below < F.col("__place")))
                         .select(*partition, "__side", "__place", below.alias("__below"), "__c", *known,
                                 F.col(f"__k{i}").alias(f"__at{i}")), "trim-cuts")
        known.append(f"__at{i}")
        if i < len(keys) - 1:
            at = at.drop("__c").withColumnRenamed("__below", "__before")
    values = F.struct(*[F.col(k).alias(c) for c, k in exact.items()])
    of = lambda k, v: F.first(F.when(F.col("__side") == k, v), ignorenulls=True)
    cuts = at.groupBy(*partition).agg(
        of(0, values).alias("__from"), of(1, values).alias("__to"),
        of(0, F.col("__place")).alias("__p1"), of(1, F.col("__place")).alias("__p2"),
        of(0, F.col("__below") + F.col("__c")).alias("__end1"), of(1, F.col("__below")).alias("__below2"))
    same = F.col("__from").eqNullSafe(F.col("__to"))
    return cuts.select(*partition, "__from", "__to",
                       (F.least("__end1", "__p2") - F.col("__p1") + 1).alias("__n_from"),
                       F.when(same, 0).otherwise(F.col("__p2") - F.col("__below2")).alias("__n_to"))


def after(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Whether the values ``left`` come after ``right`` in ascending order, nulls first; never null."""
    out = F.lit(False)
    for a, b in reversed([*zip(left, right, strict=True)]):
        greater = F.coalesce(a > b, a.isNotNull() & b.isNull())
        out = greater | (a.eqNullSafe(b) & out)
    return out
