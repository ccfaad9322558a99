"""N-gram Jaccard self-join of documents, as classes of linked documents.

Multiple-global-order filtering: if two sets have a Jaccard similarity of at least t, then
under any one order of all tokens the first n - ceil(t * n) + 1 tokens of both (their
prefixes) share a token.  Candidates must pass under several orders at once, and only
those are verified.  Every order puts tokens that only one document has first, then rare
before frequent (by class of document frequency); ties are broken by differently mixed
hashes, which is what makes the orders different.

The document frequencies are exact: tasks deal packed (token, row) arrays by token, and
tokens that two documents share travel back to their documents.  A document whose shared
tokens cannot reach the threshold drops out there, before any candidate is formed.
Prefix lists tie documents into clusters; a cluster's sets meet in one place, where links
inside an already linked class need no more tests.  Clusters above a size limit are cut
into blocks that are compared pair by pair; documents close to the cluster's most central
one are linked through it and their blocks are not compared with each other.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import batches, materialize, mix64, numbered, prepare, run_starts, set_aside
from usagelens.llm.components import components

SHINGLE = 5
PERCENT = 80
ORDERS = 3
RUN_BYTES = 1_000_000
FLUSH_TOKENS = 600_000
BUCKET_BYTES = 2_000_000      # text per bucket: tokens and documents are packed by bucket
BLOCK_DOCS = 2_048            # largest cluster, and largest block, compared in one place
BLOCK_TOKENS = 400_000

_U = np.uint64
_K = _U(0x9E3779B97F4A7C15)
_SEEDS = (0, 0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47)

POSTS = "bucket int, kind int, token binary, cls binary, row binary, n binary, fp binary"
SETS = "row long, n long, fp binary, shared long, tokens binary, cls binary"


class WordHashes(dict):
    """64-bit hash of a word; bounded cache of a worker."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, token) of the distinct shingles of lower-cased texts, sorted by both."""
    hashes = word_hashes()
    words = [t.split() for t in texts]            # bytes split at 09-0D and 20 alone
    sizes = np.array([len(w) for w in words], np.int64)
    h = np.array([hashes[w] for ws in words for w in ws], np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    if not len(h):
        return owner, h
    rolled = h[:max(len(h) - SHINGLE + 1, 0)].copy()
    for k in range(1, SHINGLE):
        rolled = rolled * _K + h[k:len(h) - SHINGLE + 1 + k]
    whole = owner[:len(rolled)] == owner[SHINGLE - 1:] if len(rolled) else np.zeros(0, bool)
    token, who = mix64(rolled[whole]), owner[:len(rolled)][whole]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        starts = np.cumsum(sizes) - sizes
        own = []
        for i in short:
            x = int(sizes[i])
            for v in h[starts[i]:starts[i] + sizes[i]].tolist():
                x = x * int(_K) + v
            own.append(x % (1 << 64))
        token = np.concatenate((token, mix64(np.array(own, np.uint64) ^ _U(_SEEDS[1]))))
        who = np.concatenate((who, short))
    order = np.lexsort((token, who))
    token, who = token[order], who[order]
    new = np.concatenate(([True], (token[1:] != token[:-1]) | (who[1:] != who[:-1])))
    return who[new], token[new]


def fingerprints(who: np.ndarray, token: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 128-bit fingerprint of every text's set (equal sets, equal fingerprints)."""
    size = np.bincount(who, minlength=n)
    out = np.zeros((n, 2), np.uint64)
    for k in (0, 1):
        np.add.at(out[:, k], who, mix64(token ^ _U(_SEEDS[k + 1])))
    return size, out


def packed(kind: int, buckets: np.ndarray, **fields: np.ndarray):
    """One dict per bucket with the bytes of every field."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.append(run_starts(buckets[order]), len(order))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        i = order[lo:hi]
        yield {"bucket": int(buckets[i[0]]), "kind": kind,
               **{k: v[i].tobytes() for k, v in fields.items()}}


def to_batches(rows, size: int = 64):
    names = [f.split()[0] for f in POSTS.split(", ")]
    for run in batches(list(rows), lambda r: 1, size):
        yield pa.RecordBatch.from_arrays(
            [pa.array([r.get(n) for r in run], pa.int32() if i < 2 else pa.binary())
             for i, n in enumerate(names)], names=names)


def field(rows: list[dict], name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), kind)


def frequency_class(df: np.ndarray) -> np.ndarray:
    """Document frequency on a logarithmic scale of 0..255 (0: one document)."""
    return np.minimum(np.round(8 * np.log2(df)), 255).astype(np.uint8)


def settle(buckets: int, parts):
    """Documents' sizes pass through; tokens of two or more rows go back to their rows.

    What all token buckets of the task have found is packed together, so the number of packed
    rows follows from the tokens and not from how the buckets were dealt.
    """
    posted: dict[int, list] = {}
    for batch in parts:
        rows = batch.to_pylist()
        yield from to_batches(r for r in rows if r["kind"])
        for r in rows:
            if not r["kind"]:
                posted.setdefault(r["bucket"], []).append((r["token"], r["row"]))
    found, size = [], 0
    while posted:
        found.append(shared_tokens(posted.popitem()[1]))
        size += len(found[-1][0])
        if size >= FLUSH_TOKENS or not posted:
            token, cls, row = (np.concatenate(x) for x in zip(*found, strict=True))
            found, size = [], 0
            for i in np.array_split(np.arange(len(token)), max(1, len(token) // FLUSH_TOKENS)):
                by_row = i[np.argsort(row[i], kind="stable")]
                yield from to_batches(packed(2, home(row[by_row], buckets), token=token[by_row],
                                             cls=cls[by_row], row=row[by_row]))


def shared_tokens(posted: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, frequency class, row) of one bucket's tokens that two or more rows hold."""
    token = np.frombuffer(b"".join(p[0] for p in posted), np.uint64)
    row = np.frombuffer(b"".join(p[1] for p in posted), np.int64)
    posted.clear()
    order = np.argsort(token)
    token, row = token[order], row[order]
    starts = run_starts(token)
    df = np.diff(np.append(starts, len(token)))
    many = np.repeat(df > 1, df)
    return token[many], np.repeat(frequency_class(df), df)[many], row[many]


def home(row: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in which a row's tokens meet again."""
    return (mix64(row.astype(np.int64).view(np.uint64)) % _U(buckets)).astype(np.int64)


def assemble(parts):
    """One row per document: size, fingerprint, number of shared tokens, and those tokens
    (by class, then token) where they can still reach the threshold."""
    by_bucket: dict[int, tuple[list, list]] = {}
    for batch in parts:
        for r in batch.to_pylist():
            by_bucket.setdefault(r["bucket"], ([], []))[r["kind"] - 1].append(r)
    while by_bucket:
        yield from assemble_bucket(*by_bucket.popitem()[1])


def assemble_bucket(info: list[dict], posts: list[dict]):
    """The documents of one home bucket."""
    row, n = field(info, "row", np.int64), field(info, "n", np.int64)
    fp = field(info, "fp", np.uint8).reshape(-1, 16)
    who, token = field(posts, "row", np.int64), field(posts, "token", np.uint64)
    cls = field(posts, "cls", np.uint8)
    posts.clear()
    order = np.lexsort((token, cls, who))
    who, token, cls = who[order], token[order], cls[order]
    lo, hi = np.searchsorted(who, row), np.searchsorted(who, row, side="right")
    alive = (hi - lo >= need(n)) & (n > 0)
    for i in np.array_split(np.arange(len(row)), max(1, len(row) // 500)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[i]), pa.array(n[i]), pa.array([fp[k].tobytes() for k in i], pa.binary()),
             pa.array(hi[i] - lo[i]),
             pa.array([token[lo[k]:hi[k]].tobytes() if alive[k] else None for k in i], pa.binary()),
             pa.array([cls[lo[k]:hi[k]].tobytes() if alive[k] else None for k in i], pa.binary())],
            names=["row", "n", "fp", "shared", "tokens", "cls"])


def need(n):
    """Tokens two sets of size n at least have to share: ceil(n * PERCENT / 100)."""
    return -(-n * PERCENT // 100)


def prefix(n: int, token: np.ndarray, cls: np.ndarray, order: int) -> np.ndarray:
    """Shared tokens in a set's prefix under one of the orders.

    The n - len(token) tokens of its own come first in every order and match nothing.
    """
    length = n - need(n) + 1 - (n - len(token))
    if length <= 0:
        return token[:0]
    if order == 0:
        return token[:length]
    return token[np.lexsort((mix64(token ^ _U(_SEEDS[order])), cls))[:length]]


def prefix_rows(parts):
    """(token, row) of the prefixes under the first order."""
    for batch in parts:
        tokens, rows = [], []
        for row, n, t, c in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            p = prefix(n, np.frombuffer(t, np.uint64), np.frombuffer(c, np.uint8), 0)
            tokens.append(p.view(np.int64))
            rows.append(np.full(len(p), row, np.int64))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)),
                                              pa.array(np.concatenate(rows))],
                                             names=["token", "row"])


class Sets:
    """Sets of a cluster (or of two blocks) and the links found among them."""

    def __init__(self, members: list[tuple]):
        # Central documents (frequent tokens) first: most others link to them at once.
        members = sorted(members, key=lambda m: (-float(np.frombuffer(m[3], np.uint8).mean()), m[0]))
        self.row = [m[0] for m in members]
        self.n = np.array([m[1] for m in members], np.int64)
        self.side = np.array([m[4] for m in members], np.int64)
        self.tokens, self.prefixes = [], []
        for _, n, t, c, _ in members:
            t, c = np.frombuffer(t, np.uint64), np.frombuffer(c, np.uint8)
            self.tokens.append(frozenset(t.tolist()))
            self.prefixes.append([prefix(n, t, c, k).tolist() for k in range(ORDERS)])
        self.others = [[frozenset(p) for p in ps[1:]] for ps in self.prefixes]
        self.label = np.arange(len(members))
        self.parts = {i: [i] for i in range(len(members))}

    def similar(self, i: int, j: int) -> bool:
        """All filters, then the exact test."""
        a, b = int(self.n[i]), int(self.n[j])
        if 100 * min(a, b) < PERCENT * max(a, b):
            return False
        if any(x.isdisjoint(y) for x, y in zip(self.others[i], self.others[j], strict=True)):
            return False
        both = len(self.tokens[i] & self.tokens[j])
        return 100 * both >= PERCENT * (a + b - both)

    def unite(self, i: int, j: int) -> None:
        a, b = int(self.label[i]), int(self.label[j])
        if len(self.parts[a]) < len(self.parts[b]):
            a, b = b, a
        moved = self.parts.pop(b)
        self.label[moved] = a
        self.parts[a] += moved

    def links(self):
        """Spanning links (row, row) of all pairs that are similar and may be compared."""
        lists: dict[int, list[int]] = {}
        for j in range(len(self.row)):
            found = [lists[t] for t in self.prefixes[j][0] if t in lists]
            if found:
                near = np.unique(np.concatenate([np.array(f) for f in found]))
                # Side 1 holds documents linked already: they are not compared among themselves.
                if self.side[j]:
                    near = near[self.side[near] == 0]
                for i in near.tolist():
                    if self.label[i] != self.label[j] and self.similar(i, j):
                        self.unite(i, j)
                        yield self.row[i], self.row[j]
            for t in self.prefixes[j][0]:
                lists.setdefault(t, []).append(j)


def grouped(parts):
    """Rows of one ``grp`` after another (input sorted by it): lists of tuples."""
    current, members = None, []
    for batch in parts:
        for grp, *member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if grp != current and members:
                yield members
                members = []
            current = grp
            members.append(tuple(member))
    if members:
        yield members


def compare_groups(parts):
    """Links inside every group."""
    for members in grouped(parts):
        pairs = list(Sets(members).links())
        if pairs:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()),
                 pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])


def hub_distance(parts):
    """Band of every member by its similarity to its cluster's hub: 0 linked with it, 1 may
    link with documents of band 0, 2 cannot (Jaccard distance is a metric)."""
    for batch in parts:
        band = []
        for n, t, m, h in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
            both = len(np.intersect1d(np.frombuffer(t, np.uint64), np.frombuffer(h, np.uint64),
                                      assume_unique=True))
            union = n + m - both
            band.append(0 if 100 * both >= PERCENT * union
                        else 1 if 100 * both >= (2 * PERCENT - 100) * union else 2)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(band, pa.int32())],
                                         names=["row", "band"])


def bucket_count(rows: DataFrame, parts: int) -> int:
    """Buckets for tokens and for documents: by the bytes of all texts, at most a few a task.

    A small corpus has few buckets however many partitions there are, so a packed row holds
    many entries; a large one has a few per task, each of which fits a task's memory.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(min(4 * parts, 1 + total // BUCKET_BYTES))


def packed_posts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """POSTS of ``rows`` (row, text) by token, and those that go back to the documents."""
    spark = rows.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = bucket_count(rows, parts)

    def post(batches_in):
        tokens, owners, infos, seen, size = [], [], [], set(), 0

        def flush():
            token, row = np.concatenate(tokens), np.concatenate(owners)
            yield from packed(0, (token % _U(buckets)).astype(np.int64), token=token, row=row)
            row, n, fp = (np.concatenate(x) for x in zip(*infos, strict=True))
            yield from packed(1, home(row, buckets), row=row, n=n, fp=fp)

        for batch in batches_in:
            pairs = [(r, t.encode().lower()) for r, t in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            for run in batches(pairs, lambda p: len(p[1]) + 64, RUN_BYTES):
                row = np.array([r for r, _ in run], np.int64)
                who, token = shingle_sets([t for _, t in run])
                n, fp = fingerprints(who, token, len(run))
                infos.append((row, n.astype(np.int64), fp))
                # Copies of a set inside the task are posted once, by the row met first.
                first = np.zeros(len(run), bool)
                for i in np.argsort(row, kind="stable").tolist():
                    k = (int(n[i]), fp[i].tobytes())
                    if k not in seen:
                        seen.add(k)
                        first[i] = True
                keep = first[who]
                tokens.append(token[keep])
                owners.append(row[who[keep]])
                size += int(keep.sum())
                if size >= FLUSH_TOKENS:
                    yield from to_batches(flush())
                    tokens, owners, infos, seen, size = [], [], [], set(), 0
        if infos:
            yield from to_batches(flush())
        word_hashes().clear()      # learned again in no time; other operators need the memory

    posted = rows.select("row", "text").mapInArrow(post, POSTS)
    return posted, posted.repartition(parts, "bucket").mapInArrow(partial(settle, buckets), POSTS)


def shingle_documents(rows: DataFrame) -> DataFrame:
    """SETS of every document of ``rows`` (row, text): steps up to the shared tokens."""
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shared = packed_posts(rows)[1].repartition(parts, "bucket")
    return materialize(shared.mapInArrow(assemble, SETS), "shingle-sets")


def cluster_groups(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups to compare (grp, row, n, tokens, cls, side) and links found with hubs (a, b)."""
    lists = sets.select("row", "n", "tokens", "cls").mapInArrow(prefix_rows, "token long, row long")
    lists = materialize(lists, "prefix-lists")
    heads = (lists.groupBy("token").agg(F.min("row").alias("b"), F.count(F.lit(1)).alias("m"))
             .where("m > 1").drop("m"))
    edges = lists.join(heads, "token").select(F.col("row").alias("a"), "b").distinct()
    clustered = materialize(sets.join(components(edges).withColumnRenamed("node", "row"), "row"),
                            "clusters")
    sizes = clustered.groupBy("component").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("shared").alias("total"))
    large = sizes.where((F.col("docs") > BLOCK_DOCS) | (F.col("total") > BLOCK_TOKENS))
    small = sizes.join(large.select("component"), "component", "left_anti")
    columns = ["row", "n", "tokens", "cls"]
    groups = clustered.join(small.select("component"), "component").select(
        F.col("component").cast("string").alias("grp"), *columns, F.lit(0).alias("side"))
    if large.isEmpty():
        return groups, edges.limit(0)
    big = clustered.join(large, "component")
    weight = F.aggregate(F.transform(F.split(F.hex("cls"), "(?<=\\G..)"),
                                     lambda x: F.conv(x, 16, 10).cast("double")),
                         F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))) / F.col("n")
    hub_rows = big.groupBy("component").agg(F.max_by("row", F.struct(weight, -F.col("row"))).alias("hub"))
    hubs = (hub_rows.join(big.select(F.col("row").alias("hub"), F.col("n").alias("hub_n"),
                                     F.col("tokens").alias("hub_tokens")), "hub"))
    bands = big.join(hubs, "component").select("row", "n", "tokens", "hub_n", "hub_tokens").mapInArrow(
        hub_distance, "row long, band int")
    big = materialize(big.join(bands, "row").join(hub_rows, "component"), "large-clusters")
    per_block = F.least(F.lit(BLOCK_DOCS // 2), F.greatest(F.lit(1), F.floor(
        F.lit(BLOCK_TOKENS // 2) * F.col("docs") / F.col("total"))))
    blocks = F.ceil(F.col("docs") / per_block)
    near = F.col("band") == 0
    placed = big.withColumn("block", F.pmod(F.xxhash64("row"), blocks)).withColumn(
        "name", F.concat(F.when(near, "S").otherwise("Q"), F.col("block").cast("string")))
    names = placed.groupBy("component").agg(F.collect_set("name").alias("names"))
    # A document of band 0 meets the blocks of the others; those meet each other, and
    # documents of band 1 the blocks of band 0.  No block of band 0 meets another one.
    partners = F.filter("names", lambda x: F.when(near, x.startswith("Q")).otherwise(
        x.startswith("Q") | (F.col("band") == 1)))
    pairs = (placed.join(names, "component")
             .withColumn("with", F.explode(partners))
             .withColumn("grp", F.concat_ws("/", F.col("component").cast("string"),
                                            F.least("name", "with"), F.greatest("name", "with")))
             .select("grp", *columns, near.cast("int").alias("side")))
    return groups.unionByName(pairs), big.where(near).select(F.col("row").alias("a"),
                                                             F.col("hub").alias("b"))


def linked_documents(docs: DataFrame) -> DataFrame:
    """``docs`` numbered by ``row``, with n_shingles and ``component`` (smallest row in reach)."""
    spark = prepare(docs.sparkSession)
    rows = numbered(docs)
    sets = shingle_documents(rows)
    # A table of its own: Spark then splits a large group of copies in the join below.
    # The smallest row names the copies; its tokens may have been posted by another of them.
    holder = F.min(F.when(F.col("tokens").isNotNull(), F.col("row")))
    same = materialize(sets.where("n > 0").groupBy("n", "fp").agg(
        F.min("row").alias("rep"), holder.alias("holder")), "set-representatives")
    own = sets.select("row", "n", "fp").join(same, ["n", "fp"], "left").select(
        "row", "n", F.coalesce("rep", "row").alias("rep"), "holder")
    own = materialize(own, "set-copies")
    alive = materialize(sets.where("tokens is not null").join(
        own.where("row = holder").select("row", "rep"), "row").select(
        F.col("rep").alias("row"), "n", "fp", "shared", "tokens", "cls"), "candidate-sets")
    groups, hub_links = cluster_groups(alive)
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = (groups.repartition(parts, "grp").sortWithinPartitions("grp")
             .mapInArrow(compare_groups, "a long, b long"))
    links = materialize(found.unionByName(hub_links), "links")
    label = components(links).withColumnRenamed("node", "rep")
    got = own.join(label, "rep", "left").select(
        "row", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component"))
    return rows.join(got, "row")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    ``docs``: doc_id, text; other columns are ignored.  Two documents link if their sets of
    five-word shingles (A-Z in lower case; the whole sequence where it is shorter) have a
    Jaccard similarity of at least PERCENT / 100; ``component_id`` is the smallest doc_id
    reachable by links.  Null and empty texts have no shingle and link with nothing.  Rows
    that repeat a doc_id are documents of their own (null ids are the smallest); an empty
    table gives an empty result.
    """
    got = materialize(linked_documents(docs.select("doc_id", "text"))
                      .select("row", "doc_id", "n_shingles", "component"), "classes")
    heads = got.where("row = component").select(F.col("row").alias("component"),
                                                F.col("doc_id").alias("component_id"))
    return got.join(heads, "component").select("doc_id", "n_shingles", "component_id")


def keep_one_per_class(docs: DataFrame) -> DataFrame:
    """The document of smallest doc_id of every class, with the columns of ``docs`` (of any
    names; a null text comes back empty)."""
    narrow, back = set_aside(docs)
    return back(linked_documents(narrow).where("row = component"))
