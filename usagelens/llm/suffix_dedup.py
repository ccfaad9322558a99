"""Removal of repeated byte strings with partitioned enhanced suffix arrays.

A byte is removed if it lies in a WINDOW-byte string that also starts earlier (smaller
row, or same row, earlier start).  Every window has one anchor: its GRAM-byte string of
smallest hash, the leftmost of equals.  The anchor depends on the window's bytes alone,
so equal windows have equal anchors at equal distances, and windows can be compared
anchor by anchor on different machines.  Neighbouring windows with one anchor form an
entry; the bytes they span are its context.

1. Every task anchors its texts and posts (anchor hash, context digest) once per distinct
   context; identical contexts inside the task are settled there.  Long texts are anchored
   in pieces that begin where an entry begins, so no entry is cut.
2. Per anchor hash, contexts with equal digests are settled: all but the earliest go.
   Where different contexts meet at an anchor, their bytes are asked for.
3. For those a suffix array of the anchors' right-hand bytes and one of their left-hand
   bytes are scanned: a stack over the common-prefix lengths gives the interval tree; in
   every interval the left-hand side is tested for diversity in the same way, so each pair
   of right and left interval is a maximal repeat with all its occurrences, and all but
   the earliest occurrence are removed.

Hot anchors (more than LOCAL_CONTEXTS different contexts in a task, or GROUP_CONTEXTS in
all) would gather without bound at step 3.  Their entries are split into single windows,
dealt out by window hash: equal windows still meet, different ones no longer do.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from usagelens.llm.common import batches, materialize, mix64, numbered, prepare, run_starts, set_aside

WINDOW = 100
GRAM = 32
SPAN = WINDOW - GRAM                # an anchor starts 0..SPAN bytes into its window
RUN_BYTES = 1_500_000
FLUSH_ENTRIES = 600_000
LOCAL_CONTEXTS = 128
GROUP_CONTEXTS = 50_000           # at 168 bytes each
POSITION_BITS = 24                  # positions inside a run of texts
MARK = 255                          # entry length that stands for "this anchor is hot"

_U = np.uint64
_R = _U(0x9E3779B97F4A7C15 | 1)
_R_INV = _U(pow(int(_R), -1, 1 << 64))
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))

POSTS = ("bucket int, kind int, key binary, digest binary, row binary, start binary, "
         "length binary, ahead binary, left binary, right binary")
VERDICTS = "row long, first long, last long, anchor long, verdict int"
REMOVE, SHIP, SPLIT = 1, 2, 3
STATISTICS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def power(base: np.uint64, n: int) -> np.uint64:
    return _U(pow(int(base), n, 1 << 64))


def anchors(buf: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Entries of a run of texts: text index, first and last window start, anchor, its hash
    and the digest of the context.  Positions are positions in ``buf``."""
    if len(buf) > 1 << POSITION_BITS:
        raise ValueError(f"a run of {len(buf)} bytes has positions beyond {POSITION_BITS} bits")
    v = _BYTE[buf]
    h, k = v, 1
    while k < GRAM:
        h = h[:-k] * power(_R, k) + h[k:]
        k *= 2
    h = mix64(h)
    key = (h >> _U(POSITION_BITS) << _U(POSITION_BITS)) | np.arange(len(h), dtype=np.uint64)
    least, k = key, 1
    while 2 * k <= SPAN + 1:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    rest = SPAN + 1 - k
    least = np.minimum(least[:len(least) - rest], least[rest:])
    at = (least & _U((1 << POSITION_BITS) - 1)).astype(np.int64)
    counts = end - begin - WINDOW + 1
    starts = np.arange(int(counts.sum())) + np.repeat(begin - np.cumsum(counts) + counts, counts)
    owner = np.repeat(np.arange(len(begin)), counts)
    anchor = at[starts]
    head = run_starts(anchor)
    tail = np.append(head[1:], len(anchor)) - 1
    first, last, anchor = starts[head], starts[tail], anchor[head]
    n = len(buf)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(v * np.cumprod(np.full(n, _R)))))
    undo = np.cumprod(np.full(n, _R_INV))
    digest = (prefix[last + WINDOW] - prefix[first]) * undo[first]
    shape = ((anchor - first) * 256 + (last - first)).astype(np.uint64)
    return owner[head], first, last, anchor, h[anchor], mix64(digest + shape * _U(0xA24BAED4963EE407))


class Entries:
    """Entries of one task, settled among themselves and posted by anchor hash."""

    FIELDS = ("key", "digest", "row", "first", "last", "anchor")

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.parts: list[tuple] = []
        self.size = 0

    def fill(self, pairs: list[tuple[int, bytes]], limit: int):
        """Adds (row, text) pairs in runs of about ``limit`` bytes, longer texts in pieces of
        that size; yields after each, for the caller to flush."""
        short = [p for p in pairs if len(p[1]) <= limit]
        for run in batches(short, lambda p: len(p[1]), limit):
            self.add(np.array([r for r, _ in run], np.int64), [t for _, t in run])
            yield
        for row, text in pairs:
            at, more = 0, len(text) > limit
            while more:
                more = at + limit < len(text)
                at = self.add(np.array([row], np.int64), [text[at:at + limit]], at, more)
                yield

    def add(self, rows: np.ndarray, texts: list[bytes], at: int = 0, more: bool = False) -> int:
        """Anchors of texts of at least WINDOW bytes, or of one piece that begins at ``at``.

        With ``more`` to come the last entry may go on behind the piece: it is left to the
        next one, which has to begin at the position returned.
        """
        lengths = np.array([len(t) for t in texts])
        end = np.cumsum(lengths)
        buf = np.frombuffer(b"".join(texts), np.uint8)
        owner, first, last, anchor, key, digest = anchors(buf, end - lengths, end)
        base = (end - lengths)[owner] - at
        n = len(key) - more
        self.parts.append(tuple(x[:n] for x in (key, digest, rows[owner], first - base,
                                                last - base, anchor - base)))
        self.size += n
        return at + int(first[-1])

    def flush(self):
        """Posts (one row per bucket) and the task's own verdicts."""
        if not self.size:
            return
        e = dict(zip(self.FIELDS, map(np.concatenate, zip(*self.parts, strict=True)), strict=True))
        self.parts, self.size = [], 0
        order = np.lexsort((e["first"], e["row"], e["digest"], e["key"]))
        e = {k: x[order] for k, x in e.items()}
        new_key = np.concatenate(([True], e["key"][1:] != e["key"][:-1]))
        earliest = new_key | np.concatenate(([True], e["digest"][1:] != e["digest"][:-1]))
        group = np.cumsum(new_key) - 1
        contexts = np.bincount(group, weights=earliest)
        hot = contexts[group] > LOCAL_CONTEXTS
        yield from local_rows(e, ~earliest, REMOVE, self.buckets)
        yield from local_rows(e, earliest & hot, SPLIT, self.buckets)
        mark = hot & new_key
        e["length"] = np.where(mark, MARK, e["last"] - e["first"]).astype(np.uint8)
        e["ahead"] = (e["anchor"] - e["last"]).astype(np.uint8)
        yield from posts({k: x[(earliest & ~hot) | mark] for k, x in e.items()}, self.buckets)


def posts(e: dict[str, np.ndarray], buckets: int, kind: int = 0):
    """One row of packed arrays per bucket of the key."""
    bucket = (e["key"] % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.append(run_starts(bucket[order]), len(order))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        i = order[lo:hi]
        yield {"bucket": int(bucket[i[0]]), "kind": kind, "key": e["key"][i].tobytes(),
               "digest": e["digest"][i].tobytes() if "digest" in e else None,
               "row": e["row"][i].astype(np.int64).tobytes(),
               "start": e["first"][i].astype(np.uint32).tobytes(),
               "length": e["length"][i].tobytes(), "ahead": e["ahead"][i].tobytes(),
               "left": e["left"][i].tobytes() if "left" in e else None,
               "right": e["right"][i].tobytes() if "right" in e else None}


def local_rows(e: dict[str, np.ndarray], chosen: np.ndarray, verdict: int, buckets: int):
    """Verdicts a task reaches alone; touching removals of a text are joined."""
    i = np.flatnonzero(chosen)
    if not len(i):
        return
    i = i[np.lexsort((e["first"][i], e["row"][i]))]
    row, first, last, anchor = (e[k][i] for k in ("row", "first", "last", "anchor"))
    if verdict == REMOVE:
        reach = last + 1
        apart = np.concatenate(([True], (row[1:] != row[:-1]) | (first[1:] > reach[:-1])))
        head = np.flatnonzero(apart)
        row, first, anchor = row[head], first[head], anchor[head]
        last = np.maximum.reduceat(last, head)
    yield {"bucket": int(row[0]) % buckets, "kind": verdict, "key": None, "digest": None,
           "row": row.astype(np.int64).tobytes(), "start": first.astype(np.uint32).tobytes(),
           "length": last.astype(np.uint32).tobytes(), "ahead": anchor.astype(np.uint32).tobytes(),
           "left": None, "right": None}


def post_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "kind": pa.int32()}
    names = [f.split()[0] for f in POSTS.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kinds.get(n, pa.binary())) for n in names], names=names)


def in_batches(rows, size: int = 64):
    """Posts as Arrow batches of a few rows each."""
    run: list[dict] = []
    for r in rows:
        run.append(r)
        if len(run) >= size:
            yield post_batch(run)
            run = []
    if run:
        yield post_batch(run)


def joined(rows: list[dict], field: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[field] for r in rows), kind)


def verdict_batch(row, first, last, anchor, verdict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x, np.int64)) for x in (row, first, last, anchor)]
        + [pa.array(np.broadcast_to(verdict, len(row)).astype(np.int32))],
        names=["row", "first", "last", "anchor", "verdict"])


def settle(batches_in):
    """Step 2 over the posts of a partition; a task's own verdicts pass through."""
    posted: dict[int, list[dict]] = {}
    for batch in batches_in:
        for r in batch.to_pylist():
            if r["kind"]:
                yield verdict_batch(joined([r], "row", np.int64), joined([r], "start", np.uint32),
                                    joined([r], "length", np.uint32),
                                    joined([r], "ahead", np.uint32), r["kind"])
            else:
                posted.setdefault(r["bucket"], []).append(
                    {k: r[k] for k in ("key", "digest", "row", "start", "length", "ahead")})
    while posted:
        yield from settle_bucket(posted.popitem()[1])


def settle_bucket(posted: list[dict]):
    """Verdicts on the posts of one bucket (all posts of a key are in one bucket)."""
    key, digest = joined(posted, "key", np.uint64), joined(posted, "digest", np.uint64)
    row, first = joined(posted, "row", np.int64), joined(posted, "start", np.uint32)
    length, ahead = joined(posted, "length", np.uint8), joined(posted, "ahead", np.uint8)
    posted.clear()
    order = np.lexsort((first, row, digest, length == MARK, key))
    key, digest, row, first, length, ahead = (
        x[order] for x in (key, digest, row, first, length, ahead))
    marks = length == MARK
    new_key = np.concatenate(([True], key[1:] != key[:-1]))
    earliest = (new_key | np.concatenate(([True], digest[1:] != digest[:-1]))) & ~marks
    group = np.cumsum(new_key) - 1
    contexts = np.bincount(group, weights=earliest)[group]
    hot = (np.bincount(group, weights=marks)[group] > 0) | (contexts > GROUP_CONTEXTS)
    verdict = np.where(marks, 0, np.where(~earliest, REMOVE, np.where(
        hot, SPLIT, np.where(contexts > 1, SHIP, 0))))
    for i in np.array_split(np.flatnonzero(verdict), max(1, len(verdict) // 200_000)):
        if len(i):
            last = first[i].astype(np.int64) + length[i]
            yield verdict_batch(row[i], first[i], last, last + ahead[i], verdict[i])


def gather(buf: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Rows buf[at : at + width]; positions outside the buffer give FF, never a UTF-8 byte."""
    index = at[:, None] + np.arange(width)
    inside = (index >= 0) & (index < len(buf))
    return np.where(inside, buf[np.clip(index, 0, max(len(buf) - 1, 0))], 255).astype(np.uint8)


def hash_rows(m: np.ndarray) -> np.ndarray:
    """Hash of every row of bytes, as the anchor hash of anchors()."""
    h = np.zeros(len(m), np.uint64)
    for column in m.T:
        h = h * _R + _BYTE[column]
    return mix64(h)


def shipped(row: int, text: bytes, items) -> tuple[dict | None, dict | None]:
    """The contexts and the single windows asked for from one text."""
    buf = np.frombuffer(text, np.uint8)
    first, last, anchor, verdict = (np.array([x[k] for x in items], np.int64)
                                    for k in ("first", "last", "anchor", "verdict"))
    key = hash_rows(gather(buf, anchor, GRAM))
    ship, split = verdict == SHIP, verdict == SPLIT
    contexts = windows = None
    if ship.any():
        a = anchor[ship]
        contexts = {"key": key[ship], "row": np.full(len(a), row), "first": a,
                    "length": (last - first)[ship].astype(np.uint8),
                    "ahead": (anchor - last)[ship].astype(np.uint8),
                    "left": gather(buf, a - SPAN, SPAN)[:, ::-1], "right": gather(buf, a, WINDOW)}
    if split.any():
        n = (last - first)[split] + 1
        start = np.repeat(first[split] + n - np.cumsum(n), n) + np.arange(int(n.sum()))
        whole = hash_rows(gather(buf, start, WINDOW))
        windows = {"key": whole, "digest": mix64(whole ^ np.repeat(key[split], n)),
                   "row": np.full(len(start), row), "first": start, "last": start, "anchor": start}
    return contexts, windows


def stack_scan(depths: list[int], least: int):
    """Intervals (depth, i, j) of the interval tree over common-prefix lengths: elements
    i..j share ``depth``, no more, and depth >= ``least``.  depths[k]: elements k-1 and k."""
    stack: list[tuple[int, int]] = []
    for k in range(1, len(depths) + 1):
        depth = depths[k] if k < len(depths) else -1
        left = k - 1
        while stack and stack[-1][0] > depth:
            d, left = stack.pop()
            yield d, left, k - 1
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, left))


def suffix_array(key: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings inside each key, and common-prefix lengths with the one before
    (-1 where the key changes)."""
    width = strings.shape[1]
    whole = np.concatenate((key.astype(">u8").view(np.uint8).reshape(-1, 8), strings), axis=1)
    order = np.argsort(np.ascontiguousarray(whole).view(f"S{width + 8}").ravel(), kind="stable")
    s, k = strings[order], key[order]
    differ = s[1:] != s[:-1]
    depth = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    depth[k[1:] != k[:-1]] = -1
    return order, np.concatenate(([-1], depth))


def repeats(key, row, anchor, length, ahead, left, right):
    """Step 3: (row, first, last) window starts to remove among entries that share anchors.

    Entries must come in order of (row, anchor): the smaller index is the earlier one.
    """
    right_order, right_depth = suffix_array(key, right)
    left_order, left_depth = suffix_array(key, left)
    left_rank = np.empty(len(key), np.int64)
    left_rank[left_order] = np.arange(len(key))
    low, high = ahead.astype(np.int64), ahead.astype(np.int64) + length
    # Bit o of a member: the window starting o bytes before its anchor goes.  Intervals nest,
    # so a window may be met many times; it is reported once.
    gone = [0] * len(key)

    def remove(member: int, shortest: int, longest: int) -> None:
        a, b = max(shortest, int(low[member])), min(longest, int(high[member]))
        if a <= b:
            gone[member] |= ((1 << (b - a + 1)) - 1) << a

    cuts = np.append(run_starts(key[right_order]), len(key))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if hi - lo < 2:
            continue
        members = right_order[lo:hi]
        for r, i, j in stack_scan(right_depth[lo:hi].tolist(), GRAM):
            inside = sorted(left_rank[members[i:j + 1]].tolist())
            between = [-1] + [int(left_depth[x + 1:y + 1].min())
                              for x, y in zip(inside[:-1], inside[1:], strict=True)]
            for depth, p, q in stack_scan(between, WINDOW - r):
                group = left_order[inside[p:q + 1]]
                keeper = group.min()
                for member in group.tolist():
                    if member != keeper:
                        remove(member, WINDOW - r, depth)
    out: list[tuple[int, int, int]] = []
    for member, bits in enumerate(gone):
        while bits:
            a = (bits & -bits).bit_length() - 1
            run = bits >> a
            n = (~run & (run + 1)).bit_length() - 1          # ones from bit a on
            out.append((int(row[member]), int(anchor[member]) - a - n + 1, int(anchor[member]) - a))
            bits = (run >> n) << (a + n)
    return out


def compare(batches_in):
    """Step 3 over a partition: contexts through suffix arrays, single windows by equality."""
    contexts: list[dict] = []
    windows: list[dict] = []
    for batch in batches_in:
        for r in batch.to_pylist():
            if r["kind"] == REMOVE:
                yield verdict_batch(joined([r], "row", np.int64), joined([r], "start", np.uint32),
                                    joined([r], "length", np.uint32),
                                    joined([r], "ahead", np.uint32), REMOVE)
            else:
                (windows if r["left"] is None else contexts).append(r)
    if contexts:
        key, row = joined(contexts, "key", np.uint64), joined(contexts, "row", np.int64)
        anchor, length = joined(contexts, "start", np.uint32), joined(contexts, "length", np.uint8)
        ahead = joined(contexts, "ahead", np.uint8)
        left = joined(contexts, "left", np.uint8).reshape(-1, SPAN)
        right = joined(contexts, "right", np.uint8).reshape(-1, WINDOW)
        contexts.clear()
        age = np.lexsort((anchor, row))
        got = repeats(*(x[age] for x in (key, row, anchor.astype(np.int64), length, ahead, left,
                                         right)))
        if got:
            spans = np.array(got, np.int64).T
            yield verdict_batch(spans[0], spans[1], spans[2], spans[2], REMOVE)
    if windows:
        key, digest = joined(windows, "key", np.uint64), joined(windows, "digest", np.uint64)
        row, start = joined(windows, "row", np.int64), joined(windows, "start", np.uint32)
        order = np.lexsort((start, row, digest, key))
        key, digest, row, start = (x[order] for x in (key, digest, row, start))
        again = np.concatenate(([False], (key[1:] == key[:-1]) & (digest[1:] == digest[:-1])))
        yield verdict_batch(row[again], start[again], start[again], start[again], REMOVE)


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(row, first, last): windows starting at first..last of a row that occur earlier.

    ``texts``: row (distinct longs, the order of the texts) and text (not null).
    """
    spark = prepare(texts.sparkSession)
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = 4 * parts

    def post(batches_in):
        entries = Entries(buckets)
        for batch in batches_in:
            pairs = [(r, t.encode()) for r, t in zip(batch.column(0).to_pylist(),
                                                     batch.column(1).to_pylist(), strict=True)]
            long_enough = [p for p in pairs if len(p[1]) >= WINDOW]
            for _ in entries.fill(long_enough, RUN_BYTES):
                if entries.size >= FLUSH_ENTRIES:
                    yield from in_batches(entries.flush())
        yield from in_batches(entries.flush())

    def ship(batches_in):
        asked = Entries(buckets)
        run: list[dict] = []
        for batch in batches_in:
            for row, text, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                contexts, windows = shipped(row, text.encode(), items)
                if contexts:
                    run.append(contexts)
                if windows:
                    asked.parts.append(tuple(windows[k] for k in Entries.FIELDS))
                    asked.size += len(windows["key"])
                if sum(len(c["key"]) for c in run) >= FLUSH_ENTRIES // 8:
                    yield from in_batches(posts(merged(run), buckets, SHIP), 16)
                    run = []
                if asked.size >= FLUSH_ENTRIES:
                    yield from in_batches(single_windows(asked))
        if run:
            yield from in_batches(posts(merged(run), buckets, SHIP), 16)
        yield from in_batches(single_windows(asked))

    posted = texts.select("row", "text").mapInArrow(post, POSTS)
    verdicts = materialize(
        posted.repartition(parts, "bucket").mapInArrow(settle, VERDICTS), "repeat-verdicts")
    asked = (verdicts.where(F.col("verdict") != REMOVE).groupBy("row")
             .agg(F.collect_list(F.struct("first", "last", "anchor", "verdict")).alias("items")))
    sent = (texts.select("row", "text").join(asked.hint("shuffle_hash"), "row")
            .select("row", "text", "items").mapInArrow(ship, POSTS))
    compared = sent.repartition(parts, "bucket").mapInArrow(compare, VERDICTS)
    return (verdicts.where(F.col("verdict") == REMOVE).unionByName(compared)
            .select("row", "first", "last"))


def merged(parts: list[dict]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def single_windows(asked: Entries):
    """Window posts; windows that a task holds twice are settled in it."""
    if not asked.size:
        return
    e = dict(zip(Entries.FIELDS, map(np.concatenate, zip(*asked.parts, strict=True)), strict=True))
    asked.parts, asked.size = [], 0
    order = np.lexsort((e["first"], e["row"], e["digest"], e["key"]))
    e = {k: x[order] for k, x in e.items()}
    again = np.concatenate(([False], (e["key"][1:] == e["key"][:-1])
                            & (e["digest"][1:] == e["digest"][:-1])))
    yield from local_rows(e, again, REMOVE, asked.buckets)
    e["length"] = e["ahead"] = np.zeros(len(again), np.uint8)
    yield from posts({k: x[~again] for k, x in e.items()}, asked.buckets, SPLIT)


def cut(text: bytes, spans) -> tuple[bytes, int]:
    """What is left of a text without its repeated windows, and the number of removed runs."""
    covered = np.zeros(len(text) + 1, np.int64)
    np.add.at(covered, [s["first"] for s in spans], 1)
    np.add.at(covered, [s["last"] + WINDOW for s in spans], -1)
    gone = np.cumsum(covered[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), runs


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: its columns with the text cut, n_bytes, n_removed, n_spans, kept_sha256.

    ``docs``: doc_id, text and any other columns; those that bear one of the four names added
    here are replaced.  Texts are UTF-8 bytes (null: empty, nothing to remove); matches never
    cross documents.  The cut ``text`` drops a character of which only a part is left;
    ``kept_sha256`` is taken over the remaining bytes themselves.  Rows that repeat an id
    count as documents of their own, ordered by text.  An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    narrow, back = set_aside(docs.drop(*STATISTICS))
    rows = numbered(narrow)
    kinds = StructType([StructField("doc_id", narrow.schema["doc_id"].dataType), StructField("text", StringType()),
                        StructField("rest", narrow.schema["rest"].dataType),
                        *(StructField(c, LongType()) for c in STATISTICS[:3]),
                        StructField(STATISTICS[3], StringType())])

    def trim(batches_in):
        for batch in batches_in:
            doc_id, texts, rest, spans = batch.columns
            kept, numbers = [], []
            for text, own in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
                raw = text.encode()
                left, runs = cut(raw, own) if own else (raw, 0)
                kept.append(left.decode("utf-8", "ignore") if runs else text)
                numbers.append((len(raw), len(raw) - len(left), runs,
                                hashlib.sha256(left).hexdigest()))
            stats = list(zip(*numbers, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(kept, pa.string()), rest, *(pa.array(x, pa.int64()) for x in stats[:3]),
                 pa.array(stats[3], pa.string())], names=["doc_id", "text", "rest", *STATISTICS])

    spans = (repeated_spans(rows).groupBy("row")
             .agg(F.collect_list(F.struct("first", "last")).alias("spans")))
    trimmed = (rows.join(spans.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "rest", "spans")
               .mapInArrow(trim, kinds))
    return back(trimmed, *STATISTICS)
