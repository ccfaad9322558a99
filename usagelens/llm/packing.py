"""Packing tokenised documents into fixed-length sequences: bounded-space best fit.

Every task tokenises its documents, cuts those over the sequence length, and places the
pieces online: a fixed number of open bins is kept in a bitset keyed by free space; a
piece goes to the fullest open bin that holds it, and when no bin holds it and all are
open, the fullest one closes.  Bins still open at the end of a task are only partly
filled, so a second round packs these leftovers (at most ``open_bins`` per task) as
wholes into shared sequences.  Sequences never need a global pass over the pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import materialize, prepare
from usagelens.llm.tokens import id_cache

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "bin long, at long, leftover boolean")


class BestFit:
    """Bounded-space online best fit over integer sizes."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free_bits = 0                      # bit f set: some open bin has f free
        self.by_free: dict[int, list[int]] = {}
        self.open = self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """Bin and offset for a piece of ``size`` (0 < size <= capacity)."""
        fitting = self.free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(free)
        else:
            if self.open >= self.open_bins:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            bin_id, free = self.made, self.capacity
            self.made += 1
        if free > size:
            self._put(bin_id, free - size)
        return bin_id, self.capacity - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_id = bins.pop()
        self.open -= 1
        if not bins:
            self.free_bits ^= 1 << free
        return bin_id

    def _put(self, bin_id: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(bin_id)
        self.open += 1
        self.free_bits |= 1 << free

    def open_ids(self) -> set[int]:
        return {b for bins in self.by_free.values() for b in bins}


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, open_bins: int = 512,
         end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its library ids followed by ``end_id``; only documents over
    ``capacity`` are cut, into full pieces and one rest.  A null text packs as an empty
    one (just ``end_id``), so every row takes part; repeated rows are packed once each;
    an empty table gives an empty result; other columns are ignored.  Offsets inside a
    sequence run gapless from 0.
    """
    spark = prepare(docs.sparkSession)
    tail = np.array([end_id], "<u4").tobytes()

    def tokenise_and_place(batches):
        cache, fit = id_cache(vocabulary), BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        rows: dict[str, list] = {k: [] for k in ("doc", "piece", "start", "length", "crc",
                                                 "bin", "at")}

        def flush(done):
            table = [pa.array(rows["doc"], pa.int64()), pa.array(rows["piece"], pa.int32())]
            table += [pa.array(rows[k], pa.int64()) for k in ("start", "length", "crc", "bin", "at")]
            table.append(pa.array([b in done for b in rows["bin"]], pa.bool_()))
            for v in rows.values():
                v.clear()
            return pa.RecordBatch.from_arrays(
                table, names=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "at",
                              "leftover"])

        for batch in batches:
            for doc, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                ids = np.frombuffer(cache.ids(text_ or ""), "<u2").astype("<u4").tobytes() + tail
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    size = min(capacity, total - start)
                    bin_id, at = fit.place(size)
                    for k, v in zip(rows, (doc, piece, start, size,
                                           zlib.crc32(ids[4 * start:4 * (start + size)]),
                                           base + bin_id, at), strict=True):
                        rows[k].append(v)
        open_bins_left = {base + b for b in fit.open_ids()}
        yield flush(open_bins_left)

    def place_leftovers(batches):
        fit = BestFit(capacity, open_bins)
        base = (1 << 62) + (TaskContext.get().partitionId() << 40)
        bins, sizes = [], []
        for batch in batches:
            bins += batch.column(0).to_pylist()
            sizes += batch.column(1).to_pylist()
        out = [(b, *fit.place(s)) for s, b in sorted(zip(sizes, bins, strict=True), reverse=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in out], pa.int64()),
             pa.array([base + q for _, q, _ in out], pa.int64()),
             pa.array([at for _, _, at in out], pa.int64())], names=["bin", "into", "shift"])

    pieces = materialize(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                    F.col(text).cast("string").alias("text"))
        .mapInArrow(tokenise_and_place, PIECES), "packed-pieces")
    left = (pieces.where("leftover").groupBy("bin").agg(F.sum("length").alias("fill"))
            .where(F.col("fill") < capacity))
    moved = materialize(
        left.repartition(F.col("bin")).mapInArrow(place_leftovers, "bin long, into long, shift long"),
        "packed-leftovers")
    return (pieces.join(moved, "bin", "left")
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    F.coalesce("into", "bin").alias("sequence_id"),
                    (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset")))
