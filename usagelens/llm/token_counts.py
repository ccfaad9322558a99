"""Token counts of whole texts: map-side two-tier lookup, no pre-token shuffle.

Tier one is a compact table of the corpus's frequent pieces with their token counts,
broadcast to every worker; tier two is a bounded per-worker cache that encodes misses
with the library.  Only (piece, count) heads of at most ``HEAD`` rows per task travel to
choose the frequent pieces; which pieces are chosen changes speed, never a count.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import prepare
from usagelens.llm.tokens import length_cache, pieces

HEAD = 4_000            # pieces a task reports
FREQUENT = 20_000       # pieces in the broadcast table
MAX_PIECE = 64          # longer pieces are never in the table (bounds its bytes)
LOCAL = 300_000         # distinct pieces a task counts before it drops its rare ones


def piece_heads(batches):
    """Per task: its most frequent pieces (rare ones are dropped above LOCAL distinct)."""
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                seen.update(pieces(text))
        if len(seen) > LOCAL:
            seen = Counter(dict(seen.most_common(LOCAL // 3)))
    top = [(p, n) for p, n in seen.most_common(HEAD) if len(p) <= MAX_PIECE]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
        names=["piece", "n"])


def frequent_pieces(docs: DataFrame, text: str = "text", size: int = FREQUENT) -> list[str]:
    """The corpus's most frequent pieces, at most ``size`` of them (bounded by parameter)."""
    heads = docs.select(F.col(text).cast("string")).mapInArrow(piece_heads, "piece string, n long")
    rows = (heads.groupBy("piece").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "piece").limit(size).collect())
    return [r.piece for r in rows]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the ``tokenizers`` library for ``vocabulary`` (no special tokens
    added, special strings inside texts taken as the library takes them).  A null text
    counts as empty (0 bytes, 0 tokens); repeated rows give repeated rows; an empty table
    gives an empty result; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    pieces = frequent_pieces(docs, text)
    lengths = [length_cache(vocabulary)[p] for p in pieces]
    table = spark.sparkContext.broadcast(
        ("\n".join(pieces).encode(), np.array(lengths, "<u2").tobytes()))

    def count(batches):
        cache = length_cache(vocabulary)
        names, sizes = table.value
        cache.keep(dict(zip(names.decode().split("\n") if names else [],
                            np.frombuffer(sizes, "<u2").tolist(), strict=True)))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = np.array([cache.count(t) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                        F.col(text).cast("string").alias("text"))
            .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
