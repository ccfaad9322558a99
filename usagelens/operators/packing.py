"""Records in few bytes for a shuffle.

Spark shuffles a row with eight bytes and more per column, and its compression shortens that
by about half.  Here whole numbers, dates and texts of few values are written as numbers of
just the bits that their measured range needs (zero stands for null), side by side in as few
64-bit words as they take, and read back after the shuffle.  No value is lost: a column whose
range is too wide, or that has too many texts, goes along as it is.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 62         # used bits of a word: it stays positive
TEXTS_KEPT = 4096      # texts of a column that the driver and a literal hold
WHOLE = ("tinyint", "smallint", "int", "bigint", "date")


@dataclass(frozen=True)
class Code:
    """``kind`` of the column and its smallest value, or its ``texts``; ``bits`` of its codes."""
    kind: str
    bits: int
    low: int = 0
    texts: tuple[str, ...] = ()


def texts_code(values: Iterable[str | None]) -> Code | None:
    """The code of a text column with no other values than these (None: too many of them)."""
    texts = tuple(sorted({v for v in values if v is not None}))
    return Code("string", len(texts).bit_length(), texts=texts) if len(texts) <= TEXTS_KEPT else None


def codes_of(df: DataFrame, columns: Sequence[str]) -> dict[str, Code]:
    """Codes for those of ``columns`` that can be packed, measured over all rows of ``df``: one
    pass for the ranges of numbers, one per column of few texts.  ``df`` should be cheap to
    read (a table, or a stored step)."""
    kinds = dict(df.dtypes)
    whole = [c for c in columns if kinds[c] in WHOLE]
    text = [c for c in columns if kinds[c] == "string"]
    number = {c: (F.unix_date(c) if kinds[c] == "date" else F.col(c)) for c in whole}
    seen = df.agg(F.count(F.lit(1)), *[F.min(v).alias(f"low_{c}") for c, v in number.items()],
                  *[F.max(v).alias(f"high_{c}") for c, v in number.items()],
                  *[F.approx_count_distinct(c).alias(f"texts_{c}") for c in text]).first()
    out: dict[str, Code] = {}
    for c in whole:
        low, high = (0, 0) if seen[f"low_{c}"] is None else (seen[f"low_{c}"], seen[f"high_{c}"])
        if (bits := (high - low + 1).bit_length()) <= WORD_BITS:
            out[c] = Code(kinds[c], bits, low)
    for c in text:
        if seen[f"texts_{c}"] <= 2 * TEXTS_KEPT:
            code = texts_code(r[0] for r in df.select(c).distinct().limit(TEXTS_KEPT + 2).collect())
            out |= {c: code} if code else {}
    return out


def _words(codes: Mapping[str, Code]) -> dict[str, tuple[int, int]]:
    """Word and first bit of each column; wide columns first, each into the first word with room."""
    used: list[int] = []
    place = {}
    for c in sorted(codes, key=lambda c: -codes[c].bits):
        n = next((i for i, b in enumerate(used) if b + codes[c].bits <= WORD_BITS), len(used))
        used += [0] * (n + 1 - len(used))
        place[c] = (n, used[n])
        used[n] += codes[c].bits
    return place


def _number(df: DataFrame, column: str, code: Code) -> tuple[DataFrame, Column]:
    """The column's code as a whole number; texts are looked up in a small broadcast table."""
    if code.kind == "string":
        name = f"__code_{column}"
        if not code.texts:
            return df, F.lit(0).cast("bigint")
        table = df.sparkSession.createDataFrame([(t, i) for i, t in enumerate(code.texts, 1)],
                                                f"`__text_{column}` string, `{name}` bigint")
        df = df.join(F.broadcast(table), F.col(column) == F.col(f"__text_{column}"), "left")
        return df, F.coalesce(F.col(name), F.lit(0).cast("bigint"))
    value = F.unix_date(column) if code.kind == "date" else F.col(column)
    return df, F.coalesce(value.cast("bigint") - F.lit(code.low).cast("bigint") + 1, F.lit(0).cast("bigint"))


def _value(number: Column, code: Code) -> Column:
    if code.kind == "string":
        return F.get(F.array(*[F.lit(t) for t in code.texts]), (number - 1).cast("int")) if code.texts else F.lit(None).cast("string")
    value = F.when(number > 0, number + F.lit(code.low - 1).cast("bigint"))
    return F.date_from_unix_date(value.cast("int")) if code.kind == "date" else value.cast(code.kind)


def spread_packed(df: DataFrame, tasks: int | None, keys: Sequence[str], codes: Mapping[str, Code]) -> DataFrame:
    """:func:`joins.spread` with the columns of ``codes`` packed on the way; the keys and all
    other columns go along as they are (and are left out where nobody reads them)."""
    if tasks is None:
        return df
    codes = {c: k for c, k in codes.items() if c in df.columns and c not in keys}
    place = _words(codes)
    rows, numbers = df, {}
    for c, code in codes.items():
        rows, numbers[c] = _number(rows, c, code)
    words: dict[int, Column] = {}
    for c, (n, bit) in place.items():
        part = F.shiftleft(numbers[c], bit)
        words[n] = words[n].bitwiseOR(part) if n in words else part
    dealt = rows.select(*[c for c in df.columns if c not in codes],
                        *[w.alias(f"__word_{n}") for n, w in words.items()]).repartition(tasks, *keys)
    mask = lambda c: F.lit((1 << codes[c].bits) - 1).cast("bigint")
    part = lambda c: F.shiftrightunsigned(f"__word_{place[c][0]}", place[c][1]).bitwiseAND(mask(c))
    return dealt.select(*[_value(part(c), codes[c]).alias(c) if c in codes else F.col(c) for c in df.columns])
