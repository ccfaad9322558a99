"""Predicates (survey FLT-1..8).

Plain column expressions: Catalyst pushes the ones on stored columns into the scan
(partition pruning for partition columns, Parquet row-group filters otherwise).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def partition_is(values: Mapping[str, str]) -> Column:
    """FLT-1: ``d = .. AND h = .. AND m5 = ..`` (pruned partition predicate)."""
    cond = F.lit(True)
    for k, v in values.items():
        cond = cond & (F.col(k) == F.lit(v))
    return cond


def half_open(col: str, lo, hi) -> Column:
    """FLT-2: ``lo <= col < hi``."""
    return (F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi))


def in_set(col: str, values: Sequence) -> Column:
    """FLT-3: ``col IN (...)``."""
    return F.col(col).isin(*values)


def has_prefix(col: str, prefixes: Sequence[str]) -> Column:
    """FLT-3: ``col LIKE 'p%' OR ...`` (startswith, pushed down as a string filter)."""
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | F.col(col).startswith(p)
    return cond


def matches(col: str, pattern: str, negate: bool = False) -> Column:
    """FLT-4: ``col RLIKE pattern`` or its negation (a null never matches)."""
    m = F.coalesce(F.col(col).rlike(pattern), F.lit(False))
    return ~m if negate else m


def not_blank(col: str) -> Column:
    """FLT-5: not null and not empty."""
    return F.col(col).isNotNull() & (F.length(F.col(col).cast("string")) > 0)


def nonzero(col: str) -> Column:
    """FLT-6: drop zero measures (after an unpivot)."""
    return F.col(col) != 0


def having(col: str, op: str, value) -> Column:
    """FLT-7: post-aggregate threshold (``cnt > 2``, ratio bounds) as a column test."""
    c, v = F.col(col), F.lit(value)
    return {">": c > v, ">=": c >= v, "<": c < v, "<=": c <= v, "=": c == v, "!=": c != v}[op]


def not_sentinel_group(col: str, sentinel: str = "-1") -> Column:
    """FLT-8: keep grouping-set rows whose column is null (aggregated away) or a real
    value, dropping the sentinel group."""
    return F.col(col).isNull() | (F.col(col) != sentinel)
