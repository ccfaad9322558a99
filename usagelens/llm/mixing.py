"""Mixing sources to target weights by repeating documents.

The words of every source are summed, targets are filled by weight up to a cap, and a
source's rate is its target over its size.  Every document is taken floor(rate) times and
once more if its coin, a hash of the document itself, falls below the fraction of the rate:
an independent Bernoulli copy that any rerun decides alike, with no state and no shuffle of
texts.  Only the table of sources is joined to the documents; it is written first, so Spark
broadcasts it where its measured size allows and otherwise joins by shuffle, splitting a hot
source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import materialize, prepare
from usagelens.operators.windows import positions_within

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)      # by rank of the source, repeating
SHARE = 1.5              # words of the mix, in sizes of the corpus
CAP = 2                  # words of a source in the mix, in sizes of the source
SEED = "mix"
COIN_STEPS = 1 << 32     # the coin is a multiple of 1 / COIN_STEPS


def coin(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Number in [0, 1) by seed, id and text (null id or text: empty)."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")),
                       F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / COIN_STEPS


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc, source, size, coin): ``doc`` holds the columns as they came."""
    text = F.col("doc.text").cast("string")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).select(
        "doc", F.col("doc.source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        coin(F.col("doc.doc_id"), text, seed).alias("coin"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   cap: int = CAP) -> DataFrame:
    """(source, source_size, target, rate) of ``sizes`` (source, size).

    Sources in order of code points, null last, take the weights in turn.  What a source
    could take beyond its cap is shared again by weight among the others until none is above;
    every round is one aggregate over the table of sources.
    """
    ranked = positions_within(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("missing", F.col("source").isNull().cast("int")),
        [], [("missing", True), ("source", True)], "place", "places")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    table = materialize(ranked.select("source", "source_size", weight.alias("weight"),
                                      (cap * F.col("source_size")).alias("most")), "mix-sources")
    total, free_weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    whole = share * (total or 0)
    free, full = whole, None
    while True:
        offered = F.lit(float(free)) * F.col("weight") / F.lit(free_weight or 1)
        is_full = offered > F.col("most")
        held, weight_left, now_full = table.agg(
            F.sum(F.when(is_full, F.col("most"))), F.sum(F.when(~is_full, F.col("weight"))),
            F.count(F.when(is_full, 1))).first()
        if not now_full or now_full == full:
            break
        free, free_weight, full = whole - (held or 0), weight_left, now_full
    target = F.least(F.col("most").cast("double"), offered)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return materialize(table.select("source", "source_size", target.alias("target"))
                       .withColumn("rate", rate), "mix-targets")


def with_copies(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``rows`` (source, size, coin, ...) with source_size, target and the number of copies."""
    sources = targets.withColumnRenamed("source", "name")
    whole = F.floor("rate")
    copies = whole + (F.col("coin") < F.col("rate") - whole).cast("long")
    return (rows.join(sources, F.col("source").eqNullSafe(F.col("name"))).drop("name")
            .withColumn("copies", copies.cast("long")).drop("rate"))


def mixing_plan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken.

    ``docs``: doc_id, text, source; other columns are ignored, whatever their names.  ``size``
    counts the words (null text: 0), ``target`` is the source's, ``taken`` the words that the
    mix takes from the document.  A null source is a source of its own, after all others; an
    empty source or one without words has target 0 and is not taken.  Rows that repeat id and
    text share their coin; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = materialize(measured(docs.select("doc_id", "text", "source")).select(
        F.col("doc.doc_id").alias("doc_id"), "source", "size", "coin"), "mix-sizes")
    planned = with_copies(rows, source_targets(rows.select("source", "size")))
    return planned.select("doc_id", "size", "source_size", "target", "copies",
                          (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as :func:`mixing_plan` takes it, with
    the columns of ``docs``."""
    prepare(docs.sparkSession)
    rows = measured(docs)
    planned = with_copies(rows, source_targets(rows.select("source", "size")))
    return planned.select(F.explode(F.array_repeat("doc", F.col("copies").cast("int"))).alias("doc")
                          ).select("doc.*")
