"""Join shapes (survey JN-1..23).

Broadcast policy: a side is hinted with ``broadcast()`` when its size is bounded by a
fixed domain (provinces, cities, network types, code tables), or after a measured
check (:func:`fits_broadcast`) shows it is below
``spark.sql.autoBroadcastJoinThreshold``.  Dimensions that grow with the data
(subscribers, stations, devices) fail the check at scale and are joined with a
shuffled hash join: the records pass by unsorted and a task holds its part of the
dimension alone; AQE's skew-join handling splits hot keys at run time.  Deciding
before planning matters: when Spark plans a sort-merge join and AQE only later
finds the small side, the fact side has already been shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


_WIDTH = {"bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "int": 4, "date": 4,
          "float": 4, "smallint": 2, "tinyint": 1, "boolean": 1, "string": 24}
# Measured decisions of recent dimension plans.  The key is the canonical plan in full with
# the byte size of the files it reads, so a dimension that has grown is measured again.
_SIZE_CHECKED: dict[tuple[int, tuple[str, ...], int], bool] = {}
SIZE_CHECKS_KEPT = 256
# Records that the sorts and hash maps of one task hold (some tens of MB each).
ROWS_PER_TASK = 250_000


def _bytes(conf_value: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)b?\s*", conf_value.lower())
    if not m:
        return -1
    return int(m.group(1)) * 1024 ** " kmgt".index(m.group(2) or " ")


def broadcast_limit(spark) -> int:
    """The broadcast budget in bytes: ``spark.sql.autoBroadcastJoinThreshold``."""
    return _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b"))


def fits_broadcast(dim: DataFrame, limit_bytes: int | None = None) -> bool:
    """Measured size check for a dimension against the broadcast budget.

    One bounded pass over ``dim.limit(max_rows + 1)`` counts the rows and sums the
    byte length of its text columns; ``max_rows`` is the budget divided by the
    row's fixed-width part, so the pass reads at most that many rows however large
    the dimension is.  The dimension fits when its rows and its estimated bytes
    (fixed-width part × rows + measured text bytes) are within the budget.  Plan
    statistics are not used: for a dimension derived by joins they multiply the
    inputs' sizes and would never allow it.  The decision is remembered for the same plan
    over the same input files; a plan that reads no file is measured every time."""
    limit = broadcast_limit(dim.sparkSession) if limit_bytes is None else limit_bytes
    if limit <= 0:
        return False
    key = (dim.semanticHash(), tuple(sorted(dim.inputFiles())), limit)
    if key[1] and key in _SIZE_CHECKED:
        return _SIZE_CHECKED[key]
    text = [c for c, t in dim.dtypes if t == "string"]
    fixed = 16 + sum(_WIDTH.get(t, 32) for c, t in dim.dtypes if c not in text) + 8 * len(text)
    max_rows = max(1, limit // fixed)
    text_bytes = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in text), F.lit(0))
    r = dim.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(text_bytes).alias("t")).first()
    n, t = int(r["n"]), int(r["t"] or 0)
    ok = n <= max_rows and n * fixed + t <= limit
    if len(_SIZE_CHECKED) >= SIZE_CHECKS_KEPT:
        _SIZE_CHECKED.clear()
    _SIZE_CHECKED[key] = ok
    return ok


def sized(dim: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """JN-1/JN-6: the dimension with a broadcast hint when its measured size is under
    the budget, otherwise hinted as the hashed side of a shuffled join (a sort-merge join
    would hold the records of a task in a sort, which grow faster than the dimension)."""
    return F.broadcast(dim) if fits_broadcast(dim, limit_bytes) else dim.hint("shuffle_hash")


def tasks_for(spark, rows: int) -> int | None:
    """How many tasks share ``rows`` records, ROWS_PER_TASK each; None when that is no more
    than the session's cores, among which Spark deals them anyway."""
    tasks = -(-rows // ROWS_PER_TASK)
    return tasks if tasks > spark.sparkContext.defaultParallelism else None


def spread(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` to so many tasks (None: left as it is).  Left to itself,
    Spark merges shuffle partitions until a task has its share of the cores or 64 MB of
    compressed rows, millions of them, and sorts and hash maps grow with that."""
    return df if tasks is None else df.repartition(tasks, *keys)


def reduce_unless_broadcast(facts: DataFrame, keys: Sequence, sums: Sequence[str],
                            dims: Sequence[DataFrame]) -> DataFrame:
    """Aggregate-before-join, when it pays.

    If every dimension the facts will be joined with fits the broadcast budget, the
    joins run map-side and the facts are returned as they are (one shuffle, in the
    final aggregate).  Otherwise at least one join shuffles the facts, so they are
    first reduced to one row per ``keys`` (sums of ``sums``, combined map-side), which
    divides the shuffled volume by the records-per-key factor.  The caller's final
    aggregate must sum the ``sums`` columns, which is correct in both cases."""
    if all(fits_broadcast(d) for d in dims):
        return facts.select(*keys, *sums)
    return facts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def dimension_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """JN-1/JN-4/JN-6: enrich a fact with a dimension on one or more key columns; the
    dimension is broadcast only after :func:`fits_broadcast` measured it under the
    budget."""
    return fact.join(sized(dim), on, how)


def left_with_default(fact: DataFrame, dim: DataFrame, on,
                      defaults: Mapping[str, object]) -> DataFrame:
    """JN-3: left join keeping unmatched facts; missing dimension values get sentinels."""
    joined = dimension_join(fact, dim, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def enrich_chain(fact: DataFrame, steps: Sequence[tuple]) -> DataFrame:
    """JN-2/JN-5: apply several (dim, on, how, defaults) enrichments in order."""
    out = fact
    for step in steps:
        dim, on, how = step[0], step[1], step[2]
        defaults = step[3] if len(step) > 3 else {}
        out = dimension_join(out, dim, on, how)
        if defaults:
            out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    return out


def full_merge(new: DataFrame, old: DataFrame, keys: Sequence[str],
               value_cols: Sequence[str], prefer: str = "row") -> DataFrame:
    """JN-8/JN-9: full outer merge of two keyed tables.

    ``prefer="row"``: when the key is present in ``new`` every value comes from
    ``new`` even if null (the increment wins column-wise, AN-26); otherwise from
    ``old``.  ``prefer="value"``: per column ``coalesce(new, old)``."""
    keys = _keys(keys)
    n = new.select(*keys, *value_cols, F.lit(True).alias("__in_new"))
    o = old.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in value_cols])
    j = n.join(o, keys, "full")
    present = F.col("__in_new").isNotNull()
    if prefer == "row":
        vals = [F.when(present, F.col(c)).otherwise(F.col(f"__old_{c}")).alias(c) for c in value_cols]
    else:
        vals = [F.coalesce(F.col(c), F.col(f"__old_{c}")).alias(c) for c in value_cols]
    return j.select(*keys, *vals)


def classify_sides(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   labels: tuple[str, str, str], out: str = "side") -> DataFrame:
    """JN-10/JN-23: full outer join on keys; label rows present only left, only
    right, or in both."""
    keys = _keys(keys)
    lk = left.select(*keys).distinct().withColumn("__l", F.lit(1))
    rk = right.select(*keys).distinct().withColumn("__r", F.lit(1))
    j = lk.join(rk, keys, "full")
    label = (F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), F.lit(labels[2]))
             .when(F.col("__l").isNotNull(), F.lit(labels[0]))
             .otherwise(F.lit(labels[1])))
    return j.select(*keys, label.alias(out))


def semi(df: DataFrame, other: DataFrame, on, condition: Column | None = None) -> DataFrame:
    """JN-11/JN-12: rows of ``df`` with a match in ``other`` (optionally with an extra
    non-equi predicate in the join condition)."""
    if condition is None:
        return df.join(other, on, "left_semi")
    keys = _keys(on)
    cond = [df[k] == other[k] for k in keys] + [condition]
    return df.join(other, cond, "left_semi")


def anti(df: DataFrame, other: DataFrame, on, condition: Column | None = None) -> DataFrame:
    """JN-13: rows of ``df`` without a match (``NOT EXISTS``)."""
    if condition is None:
        return df.join(other, on, "left_anti")
    keys = _keys(on)
    cond = [df[k] == other[k] for k in keys] + [condition]
    return df.join(other, cond, "left_anti")


def join_when_member(fact: DataFrame, mapping: DataFrame, eq_on: str, list_col: str,
                     item_col: str, how: str = "left") -> DataFrame:
    """JN-14: equi join on ``eq_on`` that only matches when the mapped item is in the
    fact's comma list (``array_contains`` in the join condition; the equality part
    is what Spark hashes)."""
    cond = (fact[eq_on] == mapping[eq_on]) & F.array_contains(F.split(fact[list_col], ","), mapping[item_col])
    return fact.join(mapping.drop(*[c for c in mapping.columns if c in fact.columns and c != eq_on]),
                     cond, how).drop(mapping[eq_on])


def role_join(log: DataFrame, dim: DataFrame, log_key: str, dim_key: str,
              prefix: str, cols: Sequence[str], how: str = "left") -> DataFrame:
    """JN-15: enrich one role of a log (caller or callee) with an aliased dimension."""
    d = dim.select(F.col(dim_key).alias(f"{prefix}{dim_key}"),
                   *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    return log.join(d, log[log_key] == d[f"{prefix}{dim_key}"], how).drop(f"{prefix}{dim_key}")


def prefix_key(col: str, length: int) -> Column:
    """JN-16: derived join key (station prefix, number section, TAC)."""
    return F.substring(F.col(col).cast("string"), 1, length)


def join_back_to_aggregate(df: DataFrame, keys: Sequence[str], agg: Sequence[Column],
                           having: Column) -> DataFrame:
    """JN-17: aggregate per key, keep qualifying keys, and return their detail rows
    joined with the aggregate."""
    keys = _keys(keys)
    qualifying = df.groupBy(*keys).agg(*agg).where(having)
    return df.join(qualifying, keys, "inner")


def densify(scaffold: DataFrame, axis_col: str, axis_values: Sequence, facts: DataFrame,
            keys: Sequence[str], fill: Mapping[str, object]) -> DataFrame:
    """JN-18: every scaffold row × every value of a fixed axis (exploded from a
    literal list, not a cross join), left joined with the facts, gaps filled."""
    dense = scaffold.withColumn(axis_col, F.explode(F.array(*[F.lit(v) for v in axis_values])))
    out = dense.join(facts, _keys(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def changed_rows(today: DataFrame, yesterday: DataFrame, keys: Sequence[str],
                 fingerprint_cols: Sequence[str], fp: str = "fp") -> DataFrame:
    """JN-19: rows of ``today`` whose (key, fingerprint) did not exist yesterday."""
    from ..functions.columns import row_fingerprint
    t = today.withColumn(fp, row_fingerprint(fingerprint_cols))
    y = yesterday.select(*_keys(keys), row_fingerprint(fingerprint_cols).alias(fp))
    return t.join(y, [*_keys(keys), fp], "left_anti")


def zero_filled(left: DataFrame, right: DataFrame, keys: Sequence[str],
                cols: Sequence[str]) -> DataFrame:
    """JN-20: left join an aggregate to another aggregate, zero for the misses."""
    j = left.join(right, _keys(keys), "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in cols})


def membership_flag(df: DataFrame, members: DataFrame, df_key: Column | str, member_key: str,
                    out: str = "is_member") -> DataFrame:
    """JN-22: 1/0 flag for rows whose key appears in ``members`` (left join on the
    distinct member keys, so the fact row count is unchanged)."""
    m = members.select(F.col(member_key).alias("__mk")).distinct().withColumn("__hit", F.lit(1))
    key = F.col(df_key) if isinstance(df_key, str) else df_key
    j = df.join(m, key == F.col("__mk"), "left")
    return j.withColumn(out, F.when(F.col("__hit").isNull(), 0).otherwise(1)).drop("__mk", "__hit")
