"""Aggregation shapes (survey AG-1..23).

All aggregates here are plain ``groupBy``/``groupingSets``/``rollup`` with built-in
aggregate functions, so Spark plans a partial (map-side) aggregate before the
shuffle.  A hot key therefore costs one partial row per map task, not a third of
the input in one reducer.  Distinct counts go through Spark's Expand-based plan,
which shuffles on (group keys, distinct value) and so also spreads a hot group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P


def count_if(cond: Column) -> Column:
    """AG-4: ``count(case when cond then 1 end)``."""
    return F.count(F.when(cond, F.lit(1)))


def sum_if(value: Column, cond: Column) -> Column:
    """AG-4: ``sum(case when cond then value else 0 end)``."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def count_distinct_if(value: Column, cond: Column) -> Column:
    """AG-5: ``count(distinct case when cond then value end)``."""
    return F.count_distinct(F.when(cond, value))


def distinct_list(col: str | Column, sep: str = ",") -> Column:
    """AG-8: distinct values as sorted, comma-joined text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat_ws(sep, F.sort_array(F.collect_set(c)))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggs: Sequence[Column],
                  id_col: str | None = "gid") -> DataFrame:
    """AG-9/AG-10/AG-11/AG-13: one Expand + aggregate for all sets.

    Columns absent from a set come back null; ``id_col`` carries Spark's
    ``grouping_id()`` (bit i set = i-th grouping column aggregated away, in the order
    the columns first appear in ``sets``)."""
    cols = set_columns(sets)
    gs = [[F.col(c) for c in s] for s in sets]
    extra = [F.grouping_id(*[F.col(c) for c in cols]).alias(id_col)] if id_col else []
    return df.groupingSets(gs, *[F.col(c) for c in cols]).agg(*aggs, *extra)


def set_columns(sets: Sequence[Sequence[str]]) -> list[str]:
    """Grouping columns in first-appearance order (the order ``grouping_id`` uses)."""
    cols: list[str] = []
    for s in sets:
        for c in s:
            if c not in cols:
                cols.append(c)
    return cols


def grouping_id_of(cols: Sequence[str], present: Sequence[str]) -> int:
    """Spark's ``grouping_id()`` value for a set: bit (n-1-i) is 1 when column i is
    aggregated away."""
    n = len(cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in present)


def grouping_id_bit(sets: Sequence[Sequence[str]], column: str) -> int:
    """Bit of Spark's ``grouping_id()`` that is 1 where ``column`` is aggregated away."""
    cols = set_columns(sets)
    return 1 << (len(cols) - 1 - cols.index(column))


def level_of(id_col: str, sets: Sequence[Sequence[str]], names: Mapping[str, Sequence[str]]) -> Column:
    """Level name per grouping-sets row, from its grouping id."""
    cols = set_columns(sets)
    expr = None
    for name, present in names.items():
        cond = F.col(id_col) == grouping_id_of(cols, present)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def label_levels(df: DataFrame, cols: Sequence[str], total: str = "t") -> DataFrame:
    """AG-13: replace the nulls a grouping set leaves in absent columns by a label."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(total)) for c in cols})


def rollup(df: DataFrame, cols: Sequence[str], aggs: Sequence[Column],
           id_col: str | None = None) -> DataFrame:
    """AG-12: ``GROUP BY ... WITH ROLLUP``."""
    extra = [F.grouping_id(*[F.col(c) for c in cols]).alias(id_col)] if id_col else []
    return df.rollup(*cols).agg(*aggs, *extra)


def mark_first(df: DataFrame, keys: Sequence[str], path: Sequence[str], prefix: str) -> DataFrame:
    """AG-2 without a distinct shuffle: columns ``<prefix>0`` .. ``<prefix>k`` (1 or 0) that mark,
    for each depth of ``path``, the first row of ``keys`` with its first so many path columns.
    ``keys[0]`` is the column to count: a row where it is null is never marked.  The sum of
    mark d over any rows grouped by ``keys[1:]`` and the first d path columns is their
    distinct count of ``keys[0]``, and can be added up map-side."""
    w = Window.partitionBy(*keys).orderBy(*path)
    new = F.lag(F.lit(1)).over(w).isNull()
    marks = {}
    for depth in range(len(path) + 1):
        if depth:
            new = new | ~F.lag(path[depth - 1]).over(w).eqNullSafe(F.col(path[depth - 1]))
        marks[f"{prefix}{depth}"] = F.when(new & F.col(keys[0]).isNotNull(), 1).otherwise(0)
    return df.withColumns(marks)


def with_total_row(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
                   total_labels: Mapping[str, str]) -> DataFrame:
    """AG-17: per-group rows plus one grand-total row whose key columns carry
    labels (e.g. '全国' / '-1'); one pass through grouping sets (keys) and ()."""
    out = df.groupingSets([[F.col(k) for k in keys], []], *[F.col(k) for k in keys]).agg(
        *aggs, F.grouping_id(*[F.col(k) for k in keys]).alias("__gid"))
    is_total = F.col("__gid") > 0
    return out.select(*[F.when(is_total, F.lit(total_labels.get(k))).otherwise(F.col(k).cast("string")).alias(k)
                        for k in keys],
                      *[c for c in out.columns if c not in keys and c != "__gid"])


def unpivot_measures(df: DataFrame, ids: Sequence[str], measures: Mapping[str, str],
                     type_col: str = "meas_obj", value_col: str = "meas_value",
                     drop_zero: bool = True) -> DataFrame:
    """AG-21 (+FLT-6): wide measures to long (id..., type, value) rows in one pass.

    ``measures`` maps the label written to ``type_col`` to the source column."""
    src = df.select(*ids, *[F.col(c).alias(label) for label, c in measures.items()])
    long = src.unpivot(list(ids), list(measures.keys()), type_col, value_col)
    return long.where(P.nonzero(value_col)) if drop_zero else long


def tagged_explode(df: DataFrame, tags: Column, names: Sequence[str]) -> DataFrame:
    """AG-14: instead of unioning N filtered copies of the input (one per dimension
    branch), give each row the array of (tag...) structs it belongs to and explode
    once; a following ``groupBy`` then aggregates every branch in one shuffle."""
    out = df.withColumn("__tag", F.explode(tags))
    return out.withColumns({n: F.col("__tag")[n] for n in names}).drop("__tag")


def pivot_counts(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence,
                 agg: Column) -> DataFrame:
    """AG-22: one column per pivot value.  The value list is explicit, so Spark does
    not run an extra job to discover it."""
    return df.groupBy(*keys).pivot(pivot_col, list(values)).agg(agg)


def running_total(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str,
                  out: str) -> DataFrame:
    """AG-23: accumulate-to-now (sum of all earlier slots and this one) per key, as a
    running window sum over already-aggregated slot rows."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value_col).over(w))
