"""Ranked lexical search: item bundles pass through successive owners of terms.

Documents are tokenised once.  Every run of documents a task reads is a shard; its postings
of the items' terms are kept sorted by term.  The terms are owned by STAGES stages, the rare
ones by the first.  A bundle is an item's sparse accumulators (document, score so far) in one
shard.  Stage by stage the bundles meet the stage's postings of their shard in a cogroup,
gain integer contributions and move on; the last stage gives every shard's best documents.

No accumulator is lost that could matter.  After every stage the k-th best partial score of
an item over all shards is a lower bound of its final k-th best.  Together with the largest
contribution each remaining term can make to any document, it shows which accumulators cannot
reach the result any more: only those are dropped, and where the remaining terms together are
too weak to lift a document, the stage opens no new accumulators.  Ties are kept.

Items are taken in blocks whose vocabulary fits a broadcast (BLOCK_BYTES of text at most, or
one longer item); every block runs over all documents.  A very common term is no hot key: its
postings lie with the shards.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import materialize, numbered, prepare, run_starts

TOP = 10
STAGES = 4                   # owners; a term goes by its share of the documents, see stage_of
SHARD_BYTES = 4_000_000      # text of a shard
BLOCK_BYTES = 16_000_000     # item text whose terms are broadcast together
BLEND = 90                   # percent of the length normalisation by mean length
SATURATION = 1_000_000_000   # contribution of a term: SATURATION * tf div (1000 * tf + 8 * m)

# ASCII characters that are not letters or digits part terms; A-Z become lower case.
FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32
             for b in range(256))

POSTINGS = ("shard long, docs long, terms long, rows binary, lengths binary, "
            "term binary, doc binary, tf binary")
SHARD = "shard long, rows binary, norms binary, term binary, doc binary, tf binary"
BUNDLES = "shard long, item int, rows binary, scores binary, best binary"


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order; bytes from 80 on belong to terms as they are."""
    return (text or "").encode().translate(FOLD).split()


def post(vocabulary: dict[bytes, int]):
    """Task that turns documents (row, text) into POSTINGS of the vocabulary, shard by shard."""
    def run(parts):
        task = TaskContext.get().partitionId()
        shards = 0
        rows, lengths, term, doc, tf = [], [], [], [], []
        held = 0

        def shard():
            t, d = np.array(term, np.int32), np.array(doc, np.int32)
            order = np.lexsort((d, t))
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + shards], pa.int64()),
                 pa.array([sum(n > 0 for n in lengths)], pa.int64()),
                 pa.array([sum(lengths)], pa.int64()),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (
                     np.array(rows, np.int64), np.array(lengths, np.int64),
                     t[order], d[order], np.array(tf, np.int64)[order]))],
                names=[c.split()[0] for c in POSTINGS.split(", ")])

        for batch in parts:
            for row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = terms_of(text)
                found = [(vocabulary[w], n) for w, n in Counter(words).items() if w in vocabulary]
                term += [t for t, _ in found]
                tf += [n for _, n in found]
                doc += [len(rows)] * len(found)
                rows.append(row)
                lengths.append(len(words))
                held += len(text or "") + 64
                if held >= SHARD_BYTES:
                    yield shard()
                    shards += 1
                    rows, lengths, term, doc, tf = [], [], [], [], []
                    held = 0
        if rows:
            yield shard()
    return run


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with the given numbers of terms."""
    longest = int(lengths.max(initial=0))
    if BLEND * longest * n_docs < 1 << 63:
        return 100 - BLEND + BLEND * lengths * n_docs // n_terms
    return np.array([100 - BLEND + BLEND * int(x) * n_docs // n_terms for x in lengths], np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Contributions of occurrences before the term's weight."""
    return SATURATION * tf // (1000 * tf + 8 * m)


def columns(row: dict, **kinds) -> list[np.ndarray]:
    return [np.frombuffer(row[k], kind) for k, kind in kinds.items()]


def term_statistics(size: int, n_docs: int, n_terms: int):
    """Task that gives (term, df, peak) of its shards: documents with the term, largest impact."""
    def run(parts):
        df, peak = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in parts:
            for r in batch.to_pylist():
                lengths, term, doc, tf = columns(r, lengths=np.int64, term=np.int32, doc=np.int32,
                                                 tf=np.int64)
                df += np.bincount(term, minlength=size)
                np.maximum.at(peak, term, impacts(tf, norms(lengths, n_docs, n_terms)[doc]))
        i = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(df[i]), pa.array(peak[i])],
                                         names=["term", "df", "peak"])
    return run


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def stage_of(df: int, n_docs: int) -> int:
    """Owner of a term: the first stage has those in less than 8 ** (1 - STAGES) of the
    documents, each later one terms up to eight times as frequent."""
    return max(0, STAGES - 1 - int(math.log(max(1.0, n_docs / df), 8)))


class Routes:
    """What the stages know of a block's items: terms, weights and bounds (all bounded by the
    block's vocabulary).

    ``at[stage]`` lists (item, terms of the stage); ``rest[item][stage]`` is the most that the
    terms of this and the later stages can add to any document.
    """

    def __init__(self, items: list[list[int]], found: dict[int, tuple[int, int]], n_docs: int):
        self.weight = {t: weight(df, n_docs) for t, (df, _) in found.items()}
        self.owner = {t: stage_of(df, n_docs) for t, (df, _) in found.items()}
        self.at: list[dict[int, list[int]]] = [{} for _ in range(STAGES)]
        self.rest = [[0] * (STAGES + 1) for _ in items]
        for i, terms in enumerate(items):
            for t in terms:
                if self.weight.get(t, 0) > 0:
                    self.at[self.owner[t]].setdefault(i, []).append(t)
                    for k in range(self.owner[t] + 1):
                        self.rest[i][k] += self.weight[t] * found[t][1]


def owned(routes_of, stage: int, n_docs: int, n_terms: int):
    """Task that takes from POSTINGS the terms that a stage owns: SHARD rows."""
    def run(parts):
        routes = routes_of.value
        mine = np.array([t for t, k in routes.owner.items() if k == stage], np.int32)
        for batch in parts:
            for r in batch.to_pylist():
                lengths, term, doc, tf = columns(r, lengths=np.int64, term=np.int32, doc=np.int32,
                                                 tf=np.int64)
                own = np.isin(term, mine)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]], pa.int64()), pa.array([r["rows"]], pa.binary()),
                     *(pa.array([x.tobytes()], pa.binary()) for x in (
                         norms(lengths, n_docs, n_terms), term[own], doc[own], tf[own]))],
                    names=[c.split()[0] for c in SHARD.split(", ")])
    return run


def best_of(rows: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Places of the TOP highest scores, equal ones by row."""
    if len(scores) > 8 * TOP:
        kth = np.partition(scores, len(scores) - TOP)[len(scores) - TOP]
        near = np.flatnonzero(scores >= kth)
        return near[np.lexsort((rows[near], -scores[near]))[:TOP]]
    return np.lexsort((rows, -scores))[:TOP]


def pass_stage(routes_of, stage: int, floors: dict[int, int]):
    """Cogroup function of a stage: bundles of a shard and the shard's postings."""
    last = stage == STAGES - 1

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        routes = routes_of.value
        held = {b["item"]: columns(b, rows=np.int64, scores=np.int64) for b in bundles.to_pylist()}
        starts, ends, terms = [], [], []
        for r in postings.to_pylist():
            shard = r["shard"]
            rows, m, term, doc, tf = columns(r, rows=np.int64, norms=np.int64, term=np.int32,
                                             doc=np.int32, tf=np.int64)
            impact = impacts(tf, m[doc])
            starts = run_starts(term)
            ends, terms = np.append(starts, len(term))[1:], term[starts].tolist()
        if not postings.num_rows:
            shard = bundles.column("shard")[0].as_py()
        span = {t: (a, b) for t, a, b in zip(terms, starts, ends, strict=True)}
        out = {name: [] for name in ("item", "rows", "scores", "best")}
        asked = routes.at[stage]
        for item in sorted(held.keys() | asked.keys()):
            floor = floors.get(item, 1)
            own, score = held.get(item, (np.zeros(0, np.int64),) * 2)
            spans = [(t, *span[t]) for t in asked.get(item, ()) if t in span]
            if spans:
                gained = np.concatenate([rows[doc[a:b]] for _, a, b in spans])
                added = np.concatenate([impact[a:b] * routes.weight[t] for t, a, b in spans])
                if routes.rest[item][stage] < floor:      # too weak to lift a new document
                    old = np.isin(gained, own)
                    gained, added = gained[old], added[old]
                own, place = np.unique(np.concatenate((own, gained)), return_inverse=True)
                total = np.zeros(len(own), np.int64)
                np.add.at(total, place, np.concatenate((score, added)))
                score = total
            top = best_of(own, score)
            if len(top) == TOP:
                floor = max(floor, int(score[top[-1]]))
            keep = top[score[top] > 0] if last else np.flatnonzero(
                score + routes.rest[item][stage + 1] >= floor)
            if len(keep):
                out["item"].append(item)
                out["rows"].append(own[keep].tobytes())
                out["scores"].append(score[keep].tobytes())
                out["best"].append(score[top].tobytes())
        return pa.table({"shard": pa.array([shard] * len(out["item"]), pa.int64()),
                         "item": pa.array(out["item"], pa.int32()),
                         **{k: pa.array(out[k], pa.binary()) for k in ("rows", "scores", "best")}})
    return run


def unpacked(*names: str):
    """Task that lists packed longs: (item, and one column per name)."""
    def run(parts):
        for batch in parts:
            for r in batch.to_pylist():
                values = columns(r, **{n: np.int64 for n in names})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values[0]), r["item"], np.int32)), *map(pa.array, values)],
                    names=["item", *names])
    return run


def leading(scored: DataFrame, *ties: str) -> DataFrame:
    """The TOP rows (item, score, ...) of every item with ``place``."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), *ties)
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOP)


def search_block(rows: DataFrame, items: list[list[bytes]]) -> DataFrame:
    """(item, rank, row, score) of a block of items given by their distinct terms."""
    spark = rows.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*items)))}
    routed = [[vocabulary[t] for t in terms] for terms in items]
    none = spark.createDataFrame([], "item int, rank int, row long, score long")
    if not vocabulary:
        return none
    postings = materialize(rows.select("row", "text").mapInArrow(post(vocabulary), POSTINGS),
                           "search-postings")
    n_docs, n_terms = postings.agg(F.sum("docs"), F.sum("terms")).first()
    if not n_docs:
        return none
    statistics = postings.select("lengths", "term", "doc", "tf").mapInArrow(
        term_statistics(len(vocabulary), n_docs, n_terms), "term int, df long, peak long")
    found = {r.term: (r.df, r.peak) for r in statistics.groupBy("term").agg(
        F.sum("df").alias("df"), F.max("peak").alias("peak")).collect()}
    routes = spark.sparkContext.broadcast(Routes(routed, found, n_docs))
    bundles, floors = spark.createDataFrame([], BUNDLES), {}
    for stage in range(STAGES):
        shards = postings.mapInArrow(owned(routes, stage, n_docs, n_terms), SHARD)
        bundles = materialize(
            bundles.groupBy("shard").cogroup(shards.groupBy("shard"))
            .applyInArrow(pass_stage(routes, stage, floors), BUNDLES), "search-bundles")
        if stage < STAGES - 1:
            best = leading(bundles.select("item", "best").mapInArrow(unpacked("best"), "item int, best long")
                           .withColumnRenamed("best", "score"))
            floors = {r["item"]: r["score"] for r in best.where(F.col("place") == TOP).collect()}
    scored = bundles.select("item", "rows", "scores").mapInArrow(
        unpacked("rows", "scores"), "item int, row long, score long")
    return leading(scored, "row").select("item", F.col("place").cast("int").alias("rank"), "row", "score")


def ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The TOP documents of every item by score: item_id, rank, doc_id, score.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored.  Terms are
    runs of ASCII letters and digits and of all characters beyond ASCII, only A-Z lower-cased;
    null and empty texts have none.  Scores are integers; a document needs more than 0, equal
    scores go by doc_id (null ids first, rows that repeat an id are documents of their own).
    Rows that repeat an item_id are items of their own.  Empty tables give an empty result.
    """
    spark = prepare(docs.sparkSession)
    rows = numbered(docs.select("doc_id", "text"))
    asked = materialize(numbered(items.select(F.col("item_id").alias("doc_id"), "text")), "search-items")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(1 + total // BLOCK_BYTES)
    results = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        listed = mine.select("row", "doc_id", "text").toLocalIterator()
        held = [(r["row"], r["doc_id"], sorted(set(terms_of(r["text"])))) for r in listed]
        got = search_block(rows, [terms for _, _, terms in held])
        names = spark.createDataFrame([(i, h[1]) for i, h in enumerate(held)], "item int, item_id long")
        got = got.join(names, "item").select("item_id", "rank", "row", "score")
        results = got if results is None else results.unionByName(got)
    ids = rows.select("row", "doc_id")
    return results.join(ids, "row").select("item_id", "rank", "doc_id", "score")
