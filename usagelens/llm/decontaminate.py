"""Benchmark decontamination: size-partitioned MinHash containment search, native.

Items are short, documents long, so the similarity that counts is containment: the share
of an item's five-word shingles that stand in the document.  Items are partitioned by
their number of shingles (powers of two); every partition keeps MinHash sketches of its
own length: the k smallest shingle hashes, with k taken from the partition's upper size
u so that k > u - ceil(threshold * u).  By the pigeonhole principle a document that
contains the threshold share of an item holds at least one hash of its sketch, so the
search loses nothing, however long the document is.  Candidates are then verified on the
shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import materialize

SHINGLE = 5
SPACES = r"[\x20\x09-\x0D]+"
# Sketch rows (hash, item) that may be broadcast: about 100 bytes each in a hash table.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    """Lower-cased words between spaces and 09-0D."""
    return F.filter(F.split(F.lower(text), SPACES, -1), lambda w: w != "")


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it.

    (A column expression used inside a lambda would be computed again for every element.)
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    """Distinct hashes of all n-word shingles; the whole sequence where it is shorter."""
    def of(w):
        inner = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))),
                            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
        return F.when(F.size(w) >= n, F.array_distinct(inner)).when(
            F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
            F.array().cast("array<bigint>"))
    return bound(words, of)


def shingle_texts(words: Column, n: int = SHINGLE) -> Column:
    """Distinct shingles as text, words joined by one space."""
    def of(w):
        inner = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))),
                            lambda i: F.array_join(F.slice(w, i + 1, F.lit(n)), " "))
        return F.when(F.size(w) >= n, F.array_distinct(inner)).when(
            F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(
            F.array().cast("array<string>"))
    return bound(words, of)


def item_sketches(items: DataFrame, percent: int) -> DataFrame:
    """item_id, n, shingles and the partition's sketch of every item with a word."""
    sized = (items.select("item_id", words_of(F.col("text")).alias("words"))
             .select("item_id", shingle_texts(F.col("words")).alias("shingles"),
                     shingle_hashes(F.col("words")).alias("hashes"))
             .withColumn("n", F.size("shingles")).where("n > 0"))
    upper = F.pow(F.lit(2), F.floor(F.log2(F.col("n"))) + 1).cast("int") - 1
    keep = upper - F.ceil(upper * percent / F.lit(100)).cast("int") + 1
    return sized.select("item_id", "n", "shingles",
                        F.slice(F.array_sort("hashes"), F.lit(1), keep).alias("sketch"))


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """Pairs doc_id, item_id, matched, n_shingles with 100 * matched >= percent * n_shingles.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored.  Null and
    empty texts have no shingle and match nothing; a text of fewer than five words is one
    shingle (its whole sequence).  Rows that repeat a doc_id count as texts of one
    document (the best match is reported), rows that repeat an item_id likewise; null ids
    are ids of their own.  Empty tables give no pairs.
    """
    sketches = item_sketches(items, percent)
    tagged = sketches.withColumn("item_row", F.xxhash64("item_id", F.array_join("shingles", "\n")))
    lookup = tagged.select("item_row", F.explode("sketch").alias("h")).distinct()
    if lookup.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        lookup = F.broadcast(lookup)
    found = materialize(
        docs.select("doc_id", F.explode(shingle_hashes(words_of(F.col("text")))).alias("h"))
        .join(lookup, "h").select(F.col("doc_id").alias("hit_id"), "item_row").distinct(),
        "containment-candidates")
    # Documents are reduced to the hit ones by their ids alone; only those meet the shingles.
    ids = materialize(found.select("hit_id").distinct(), "containment-documents")
    hit_docs = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi")
    known = materialize(tagged.select("item_row", "item_id", "n", "shingles")
                        .dropDuplicates(["item_row"]), "containment-items")
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower("text"), SPACES, " "), F.lit(" "))
    standing = bound(spaced, lambda t: F.size(F.filter("shingles", lambda s: F.contains(
        t, F.concat(F.lit(" "), s, F.lit(" "))))))
    checked = (hit_docs.join(found, F.col("doc_id").eqNullSafe(F.col("hit_id"))).join(known, "item_row")
               .select("doc_id", "item_id", "n", standing.alias("matched"))
               .where(F.col("matched") * 100 >= F.col("n") * percent))
    best = F.max(F.struct((F.col("matched") / F.col("n")).alias("share"), "matched", "n"))
    return (checked.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", F.col("b.matched").cast("long").alias("matched"),
                    F.col("b.n").cast("long").alias("n_shingles")))


def drop_contaminated(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that contain an item (all columns kept)."""
    hit = materialize(contained_items(docs, items, percent)
                      .select(F.col("doc_id").alias("hit")).distinct(), "contaminated")
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit"]), "left_anti")
