"""Audit of how document filters interact, with exact duplicates found in radix text tries.

Every document gets a mask of the filters it fails.  Four of them look at the document alone.
The fifth, "identical to the text of a smaller doc_id", needs all texts: they are
range-partitioned by prefixes and inserted whole into compressed tries that hold the smallest
id at every terminal; a traversal of the entries then flags all rows above that id.

* Prefixes are adaptive.  Texts are dealt by their first LEVELS[0] bytes; where the distinct
  texts of a prefix weigh more than a slot should hold, the next, longer prefix (by its hash)
  is appended, at last the whole text.  Cuts between slots come from a weighted sample of
  these keys, so a passage at the head of a third of all texts is spread over many slots.
  Sample and slots decide only which task inserts a text, never a flag.
* A task settles copies among its own rows in a trie first.  Only the row of smallest id of
  every text travels with its text; rows above it are flagged already and travel without.
* Masks are reduced before they meet anything: by id before labels are joined, by part and
  mask before the orders of the filters are enumerated.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import batches, materialize, prepare

FILTERS = "ABCDE"
MIN_WORDS = 200              # A: fewer words
MIN_DISTINCT = 50            # B: percent of distinct words
MAX_CAPITALS = 2             # C: percent of capital letters
SYMBOLS = b"#$%&*|"          # D: any of these
CAPITALS = bytes(range(65, 91))
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}

LEVELS = (32, 512, 8192)     # bytes of the prefixes; beyond the last the whole text counts
SLOT_BYTES = 2_000_000       # least text that is worth a slot of its own
SLOTS_PER_TASK = 4
SAMPLES_PER_SLOT = 16
LOCAL_BYTES = 24_000_000     # text in the trie of a map task
BATCH_BYTES = 4_000_000

HEADS = "head binary, h1 long, h2 long, h3 long, size long"
ROWS = "slot int, doc_id long, part string, mask int, n long, text binary"


class RadixTrie:
    """Compressed trie over byte strings.  A node is [label, children by first byte, id];
    the id is the smallest one inserted with the text that ends there."""

    def __init__(self):
        self.root = [b"", {}, None]

    def insert(self, text: bytes, key: int) -> list:
        """The terminal node of ``text``, which holds ``key`` if that is smaller."""
        node, at = self.root, 0
        while at < len(text):
            children = node[1]
            child = children.get(text[at])
            if child is None:
                child = children[text[at]] = [text[at:], {}, None]
                at = len(text)
            elif text.startswith(child[0], at):
                at += len(child[0])
            else:
                k = common_length(child[0], text, at)
                upper = [child[0][:k], {child[0][k]: child}, None]
                child[0] = child[0][k:]
                children[text[at]] = upper
                child, at = upper, at + k
            node = child
        if node[2] is None or key < node[2]:
            node[2] = key
        return node


def common_length(label: bytes, text: bytes, at: int) -> int:
    """Bytes that ``label`` and ``text`` from ``at`` on have in common."""
    same, differ = 0, len(label) + 1
    while differ - same > 1:
        k = (same + differ) // 2
        if text.startswith(label[same:k], at + same):
            same = k
        else:
            differ = k
    return same


def own_mask(text: str, raw: bytes) -> int:
    """Mask of the filters that look at one document."""
    words = raw.split()                       # bytes split at 09-0D and 20 alone
    return ((len(words) < MIN_WORDS) * BIT["A"]
            | (100 * len(set(words)) < MIN_DISTINCT * len(words)) * BIT["B"]
            | (100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MAX_CAPITALS * len(text)) * BIT["C"]
            | (len(raw.translate(None, SYMBOLS)) < len(raw)) * BIT["D"])


def prefix_hashes(raw: bytes) -> tuple[bytes, int, int, int]:
    """First bytes of a text, and hashes of its longer prefixes and of all of it."""
    return (raw[:LEVELS[0]], *(xxhash.xxh3_64_intdigest(raw[:k]) - (1 << 63)
                               for k in (*LEVELS[1:], len(raw))))


def weigh(parts):
    """HEADS of the texts."""
    for batch in parts:
        raws = [(t or "").encode() for t in batch.column(0).to_pylist()]
        heads = [prefix_hashes(r) for r in raws]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in heads], pa.binary()),
             *(pa.array([h[i] for h in heads], pa.int64()) for i in (1, 2, 3)),
             pa.array([len(r) for r in raws], pa.int64())],
            names=["head", "h1", "h2", "h3", "size"])


def slot_key(head: bytes, h1: int, h2: int, h3: int, heavy: set) -> bytes:
    """Prefix of a text as long as its weight asks for, as sortable bytes."""
    key = (head,)
    for h in (h1, h2, h3):
        if key not in heavy:
            break
        key = (*key, h)
    return head + b"".join((h + (1 << 63)).to_bytes(8, "big") for h in key[1:])


def slot_plan(texts: DataFrame) -> tuple[set, list[bytes]]:
    """Prefixes that are too heavy for a slot, and the cuts between the slots' keys.

    Both are bounded by the number of slots, a few per task.
    """
    tasks = max(2, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    heads = materialize(texts.mapInArrow(weigh, HEADS).groupBy("head", "h1", "h2", "h3")
                        .agg(F.max("size").alias("size")), "audit-heads")
    total = heads.agg(F.sum("size")).first()[0] or 0
    limit = max(SLOT_BYTES, total // (SLOTS_PER_TASK * tasks))
    heavy: set = set()
    for level in (["head"], ["head", "h1"], ["head", "h1", "h2"]):
        found = heads.groupBy(*level).agg(F.sum("size").alias("s")).where(F.col("s") > limit).drop("s")
        heavy |= {(bytes(r[0]), *r[1:]) for r in found.collect()}
    step = max(1, limit // SAMPLES_PER_SLOT)
    lucky = (F.pmod(F.col("h3"), F.lit(step)) < F.col("size"))
    sample = sorted((slot_key(bytes(r[0]), *r[1:4], heavy), max(r[4], step))
                    for r in heads.where(lucky).collect())
    cuts, held = [], 0
    for key, weight in sample:
        if held >= limit and (not cuts or key > cuts[-1]):
            cuts.append(key)
            held = 0
        held += weight
    return heavy, cuts


def to_batches(rows: list[tuple]):
    """ROWS as Arrow batches of bounded size."""
    kinds = (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary())
    for run in batches(rows, lambda r: 64 + len(r[5] or b""), BATCH_BYTES):
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in run], kind) for i, kind in enumerate(kinds)],
            names=[c.split()[0] for c in ROWS.split(", ")])


def settle_rows(entries: list[tuple], keep_texts: bool):
    """ROWS of the entries (node, slot, doc_id, part, mask, n, text) of a full trie.

    A row above its terminal's id is a duplicate.  With ``keep_texts`` the others keep their
    text, for the trie that all rows of that text meet in; a row without id meets nobody.
    """
    left: dict[tuple, int] = {}
    nodes: dict[int, tuple] = {}
    for node, slot, doc_id, part, mask, n, text in entries:
        if doc_id is None or doc_id > node[2]:
            copy = doc_id is not None
            yield (slot, doc_id, part, mask | copy * BIT["E"], n, None)
        else:
            at = (id(node), part, mask)
            left[at] = left.get(at, 0) + n
            nodes[id(node)] = (slot, doc_id, text)
    for (node, part, mask), n in left.items():
        slot, doc_id, text = nodes[node]
        yield (slot, doc_id, part, mask, n, text if keep_texts else None)


def judge(heavy: set, cuts: list[bytes]):
    """Task that masks documents (doc_id, part, text) and settles its own copies."""
    def run(parts):
        trie, entries, held = RadixTrie(), [], 0
        for batch in parts:
            for doc_id, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                raw = text.encode()
                slot = bisect_right(cuts, slot_key(*prefix_hashes(raw), heavy))
                node = trie.insert(raw, doc_id) if doc_id is not None else None
                entries.append((node, slot, doc_id, part, own_mask(text, raw), 1, raw))
                held += len(raw) + 64
                if held >= LOCAL_BYTES:
                    yield from to_batches(settle_rows(entries, True))
                    trie, entries, held = RadixTrie(), [], 0
        yield from to_batches(settle_rows(entries, True))
    return run


def flag(parts):
    """Every slot's texts in one trie; rows that were settled before pass through."""
    current, trie, entries = None, RadixTrie(), []
    for batch in parts:
        passed = []
        for slot, doc_id, part, mask, n, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text is None:
                passed.append((slot, doc_id, part, mask, n, None))
                continue
            if slot != current:
                yield from to_batches(settle_rows(entries, False))
                current, trie, entries = slot, RadixTrie(), []
            entries.append((trie.insert(text, doc_id), slot, doc_id, part, mask, n, None))
        yield from to_batches(passed)
    yield from to_batches(settle_rows(entries, False))


def filter_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): the filters that documents fail, n rows alike in all three.

    ``docs``: doc_id, text, source; other columns are ignored.  Bit i of ``mask`` stands for
    letter i of FILTERS, ``part`` is the source (null: empty).  A null text is empty.  A row is
    a duplicate if a row of smaller id has the same text; rows of equal id are not duplicates
    of each other, and a null id is neither smaller nor greater than any.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string").alias("text"))
    tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    judged = rows.mapInArrow(judge(*slot_plan(rows.select("text"))), ROWS)
    flagged = judged.repartition(tasks, "slot").sortWithinPartitions("slot").mapInArrow(flag, ROWS)
    return flagged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


def steps():
    """(order, step, mask of the filters before, the step's own bit) of all orders."""
    for order in permutations(FILTERS):
        before = 0
        for k, letter in enumerate(order):
            yield "".join(order), k + 1, before, BIT[letter]
            before |= BIT[letter]


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the step's counts.

    ``labels``: doc_id, quality, toxic; a document is good or toxic if any of its rows says 1.
    Documents, nulls and repeated rows as in :func:`filter_masks`; an empty table has no part
    and gives an empty result.  ``shapley`` is what the step's filter removes, summed over all
    orders: a document that fails k filters is removed first by each of them in 1 / k of them.
    """
    spark = prepare(docs.sparkSession)
    marks = (labels.where("doc_id is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    count = lambda c: F.sum(F.when(F.coalesce(F.col(c), F.lit(0)) == 1, F.col("n")).otherwise(F.lit(0)))
    masks = (filter_masks(docs).join(marks, "doc_id", "left").groupBy("part", "mask")
             .agg(F.sum("n").alias("n"), count("good").alias("good"), count("toxic").alias("toxic")))
    # 80 pairs of a step's filter and those before it, for at most 32 masks a part.
    pairs = sorted({(before, bit) for _, _, before, bit in steps()})
    ways = len(list(permutations(FILTERS)))
    each = masks.withColumn("pair", F.explode(F.array(*[
        F.struct(F.lit(b).alias("before"), F.lit(f).alias("own")) for b, f in pairs]))).select(
        "part", "mask", "n", "good", "toxic", "pair.before", "pair.own")
    mask, before, own = F.col("mask"), F.col("before"), F.col("own")
    fails, passed = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) == 0
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(F.lit(0)))
    share = F.lit(ways) / F.greatest(F.bit_count("mask"), F.lit(1))
    counts = each.groupBy("part", "before", "own").agg(
        total("n", passed & ~fails).alias("kept"), total("n", passed & fails).alias("removed"),
        total("n", ~passed & fails).alias("redundant"), total("n", mask == own).alias("unique_fails"),
        total("good", passed & fails).alias("good_lost"),
        total("toxic", passed & fails).alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * share.cast("long")).otherwise(F.lit(0))).alias("shapley"))
    listed = spark.createDataFrame(list(steps()), "filter_order string, step int, before int, own int")
    # The 600 steps are the same at every size.
    return counts.join(F.broadcast(listed), ["before", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley")
