"""Quality rules: surface counts and n-gram perplexity bands.

The language model is an interpolated modified Kneser-Ney model over characters: every
letter of every script stands for itself, only ASCII digits, the symbols that the rules
count and other ASCII punctuation are one class each.  Nothing bounds it: Spark counts the
n-grams of the whole corpus (each task adds up its own first) and builds the orders one upon
the other with joins on n-grams, so the model grows with the text and its script.

Every n-gram that is scored has been counted, so a score is one lookup.  The model is split
by count into two tiers of sorted hash arrays (n-gram hash, log probability): the most
frequent n-grams, at most HOT of them, are broadcast and searched by bisection in the task
that reads the texts; all others stay partitioned by hash, and the documents that hold them
ask with their own pre-aggregated (hash, count) in one join.  The size of the first tier
changes where an n-gram is looked up, never a score.

Per language, perplexities outside a lower and an upper band reject a document: far below is
boilerplate, far above is noise.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usagelens.llm.common import batches, materialize, mix64, prepare

ORDER = 4
HOT = 1_000_000           # n-grams in the broadcast tier (12 bytes each)
LOCAL = 2_000_000         # n-grams a task adds up before it hands them on
BATCH_CHARS = 2_000_000
# Band: quartiles of log perplexity per language, widened by this many (floored) ranges.
BAND_RANGES = 3.0         # the outer fences of a box plot
LEAST_RANGE = 0.03
STEP = 0.001              # log perplexities are counted in steps of this size

WORD = re.compile("[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
START = "\n"             # stands before a text; spaces in it are all " "

_K = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def fold_table() -> np.ndarray:
    """Character that stands for every code point: one for all white space, one each for
    ASCII digits, SYMBOLS and other ASCII punctuation, else the code point itself."""
    t = np.arange(0x110000, dtype=np.uint32)
    for c in range(33, 127):
        if not chr(c).isalpha():
            t[c] = ord("0" if chr(c).isdigit() else "#" if chr(c) in SYMBOLS else ".")
    t[[32, *range(9, 14)]] = 32
    return t


def folded(text: str) -> np.ndarray:
    """Characters of the lower-cased text, runs of spaces as one and none at the start,
    ORDER - 1 START in front."""
    c = fold_table()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    keep = c != 32
    keep[1:] |= c[:-1] != 32
    return np.concatenate((np.full(ORDER - 1, ord(START), np.uint32), c[keep]))


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of all texts one after another: their hashes, where they start among the
    characters (returned too), and the number of each text's."""
    parts = [folded(t) for t in texts]
    sizes = np.array([len(p) - ORDER + 1 for p in parts], np.int64)
    flat = np.concatenate(parts)
    valid = np.ones(len(flat), bool)
    for k in range(1, ORDER):          # n-grams that would run into the next text
        valid[np.cumsum(sizes + ORDER - 1) - k] = False
    at = np.flatnonzero(valid)
    return gram_hash(flat, at), at, flat, sizes


def gram_hash(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hash of the ORDER characters from every place on."""
    h = np.zeros(len(at), np.uint64)
    for k in range(ORDER):
        h = h * _K + flat[at + k].astype(np.uint64) + np.uint64(1)
    return mix64(h)


def count_ngrams(parts):
    """(gram, n) of a task's texts, each n-gram once unless there are more than LOCAL."""
    total: Counter = Counter()

    def flush():
        grams = list(total)
        for lo in range(0, len(grams), 200_000):
            cut = grams[lo:lo + 200_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cut, pa.string()), pa.array([total[g] for g in cut], pa.int64())],
                names=["gram", "n"])
        total.clear()

    known: dict[int, str] = {}             # text of the hashes seen
    for batch in parts:
        for run in batches([t for t in batch.column(0).to_pylist() if t],
                           lambda t: len(t) + 16, BATCH_CHARS):
            h, at, flat, _ = ngrams(run)
            unlike, n = np.unique(h, return_counts=True)
            unlike = unlike.tolist()
            new = np.array([x for x in unlike if x not in known], np.uint64)
            if len(new):
                place = np.minimum(np.searchsorted(new, h), len(new) - 1)
                met = np.flatnonzero(new[place] == h)
                first = np.zeros(len(new), np.int64)
                first[place[met]] = at[met]        # any place of the n-gram serves
                text = np.stack([flat[first + k] for k in range(ORDER)], 1).astype("<u4").tobytes(
                    ).decode("utf-32-le", "surrogatepass")
                known.update((x, text[i * ORDER:(i + 1) * ORDER]) for i, x in enumerate(new.tolist()))
            for x, k in zip(unlike, n.tolist(), strict=True):
                total[known[x]] += k
            if len(known) >= LOCAL:
                yield from flush()
                known.clear()
    yield from flush()


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more, from the numbers of
    n-grams with counts 1 to 4."""
    if not (n1 and n2 and n3):
        return [0.0, 0.5, 0.75, 0.9]   # too small a corpus for the estimate
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [0.0, *(min(max(x, 0.0), top) for x, top in zip(d, (0.999, 1.999, 2.999), strict=True))]


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n, p) of every n-gram of ``counts`` (gram, n): its interpolated probability.

    The highest order uses the counts themselves, each lower one the number of different
    characters seen in front of the shorter n-gram.  p = (c - D(c)) / total(context) +
    gamma(context) * p(shorter n-gram); below single characters all are alike.
    """
    level = {order: counts.withColumnRenamed("n", "c")}
    for k in range(order - 1, 0, -1):
        shorter = F.expr(f"substring(gram, 2, {k})").alias("gram")
        level[k] = materialize(level[k + 1].groupBy(shorter).agg(F.count(F.lit(1)).alias("c")), f"kn-counts-{k}")
    known = level[1].count()
    p = None
    for k in range(1, order + 1):
        seen = level[k].where("c <= 4").groupBy("c").count().collect()
        d = discounts(*({r["c"]: r["count"] for r in seen}.get(i, 0) for i in (1, 2, 3, 4)))
        cut = F.element_at(F.array(*[F.lit(x) for x in d]), (F.least("c", F.lit(3)) + 1).cast("int"))
        rows = level[k].select("gram", "c", cut.alias("cut"), F.expr(f"left(gram, {k - 1})").alias("context"),
                               F.expr(f"substring(gram, 2, {k - 1})").alias("shorter"))
        context = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("cut").alias("mass"))
        rows = rows.join(context, "context")
        if p is None:
            rows = rows.withColumn("lower", F.lit(1.0 / (known + 1)))
        else:
            rows = rows.join(p.select(F.col("gram").alias("shorter"), F.col("p").alias("lower")), "shorter")
        p = materialize(rows.select("gram", "c", (
            (F.col("c") - F.col("cut")) / F.col("total") + F.col("mass") / F.col("total") * F.col("lower"))
            .alias("p")), f"kn-order-{k}")
    return p.withColumnRenamed("c", "n")


def hash_grams(parts):
    """(hash, logp, n) of model rows (gram, p, n)."""
    for batch in parts:
        flat = np.frombuffer("".join(batch.column(0).to_pylist()).encode("utf-32-le", "surrogatepass"),
                             "<u4")
        h = gram_hash(flat, np.arange(0, len(flat), ORDER)) if len(flat) else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(np.log(batch.column(1).to_numpy()).astype(np.float32)),
             batch.column(2)], names=["hash", "logp", "n"])


def tiers(model: DataFrame) -> tuple[tuple[bytes, bytes], DataFrame]:
    """The frequent n-grams as sorted arrays (hash, logp), and the others as a table.

    Frequent is a count from the least power of two on that leaves at most HOT of them.
    """
    hashed = materialize(model.select("gram", "p", "n").mapInArrow(
        hash_grams, "hash long, logp float, n long"), "kn-hashed")
    binned = hashed.groupBy(F.floor(F.log2("n")).alias("bin")).count().collect()
    least, held = 64, 0
    for bin_, n in sorted(((r["bin"], r["count"]) for r in binned), reverse=True):
        held += n
        if held > HOT:
            break
        least = bin_
    frequent = F.floor(F.log2("n")) >= least
    hot = hashed.where(frequent).select("hash", "logp").toArrow()
    h = hot.column(0).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    arrays = h[order].tobytes(), hot.column(1).to_numpy().astype(np.float32)[order].tobytes()
    return arrays, hashed.where(~frequent).select("hash", "logp")


class HashArrays:
    """The frequent n-grams of a task: sorted hashes, their log probabilities, and where each
    run of hashes with the same leading bits begins (hashes are spread evenly)."""

    def __init__(self, hashes: np.ndarray, logp: np.ndarray):
        self.hashes, self.logp = hashes, logp
        bits = max(1, int(len(hashes)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        edges = np.arange((1 << bits) + 1, dtype=np.uint64)
        self.begin = np.searchsorted(hashes >> self.shift, edges).astype(np.int32)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of every wanted hash (0 where it is not there), and whether it is."""
        logp, there = np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        lead = (wanted >> self.shift).astype(np.int64)
        at, end = self.begin[lead], self.begin[lead + 1]
        open_ = np.flatnonzero(at < end)
        at, end = at[open_], end[open_]
        while len(open_):                    # as many turns as the longest run has hashes
            hit = self.hashes[at] == wanted[open_]
            logp[open_[hit]] = self.logp[at[hit]]
            there[open_[hit]] = True
            left = ~hit & (at + 1 < end)
            open_, at, end = open_[left], at[left] + 1, end[left]
        return logp, there


def look_up(texts: list[str], frequent: HashArrays):
    """Of every text: the sum of its frequent n-grams' log probabilities, the number of its
    n-grams, and (hash, count) of the others."""
    h, _, _, sizes = ngrams(texts)
    logp, there = frequent.find(h)
    ends = np.cumsum(sizes)
    sums, rest = [], []
    for lo, hi in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        sums.append(float(logp[lo:hi].sum()))
        own = h[lo:hi][~there[lo:hi]]
        if len(own):
            own, n = np.unique(own.view(np.int64), return_counts=True)
        rest.append([{"hash": x, "n": k} for x, k in zip(own.tolist(), n.tolist(), strict=True)] if len(own) else [])
    return sums, sizes, rest


def repeat_words(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more (first ones included)."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[str, int] = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], np.int64)
    if len(ids) < 1 << 21:
        windows = (w[:-2] << 42) | (w[1:-1] << 21) | w[2:]
        _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        _, inverse, count = np.unique(np.stack((w[:-2], w[1:-1], w[2:])), axis=1,
                                      return_inverse=True, return_counts=True)
    again = count[inverse.ravel()] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def surface_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = WORD.findall(text)
    lines: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line in lines:
            duplicates += 1
        elif WORD.search(line):
            lines.add(line)
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), duplicates,
            repeat_words(words))


def bands(scored: DataFrame) -> DataFrame:
    """lang_key, low, high: log-perplexity bands from the quartiles of each language."""
    steps = (scored.where("not base_failed")
             .groupBy("lang_key", F.floor(F.col("log_ppl") / STEP).alias("step")).count())
    order = Window.partitionBy("lang_key").orderBy("step")
    ranked = (steps.withColumn("upto", F.sum("count").over(order))
              .withColumn("total", F.sum("count").over(Window.partitionBy("lang_key"))))

    def quartile(share):
        return F.min(F.when(F.col("upto") >= F.col("total") * share, F.col("step"))) * STEP

    q = ranked.groupBy("lang_key").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    width = F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_RANGE)) * BAND_RANGES
    return q.select("lang_key", (F.col("q1") - width).alias("low"),
                    (F.col("q3") + width).alias("high"))


def train(docs: DataFrame) -> DataFrame:
    """The model of every text of ``docs``: (gram, n, p)."""
    counted = (docs.select(F.col("text").cast("string")).mapInArrow(count_ngrams, "gram string, n long")
               .groupBy("gram").agg(F.sum("n").alias("n")))
    return kneser_ney(materialize(counted, "kn-counts"))


COLUMNS = ["row", "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "hot_sum", "n_grams", "rest"]
SCORED = ("row long, doc_id long, lang string, n_words long, word_chars long, n_symbols long, "
          "n_dup_lines long, n_repeat_words long, base_failed boolean, hot_sum double, n_grams long, "
          "rest array<struct<hash: long, n: long>>")


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lang, log_ppl, low, high.

    ``docs``: doc_id, text, lang; other columns are ignored.  A null text has no word
    (all counts 0, base_failed); null languages share a band of their own.  A document is
    kept if its base rules hold and its log perplexity (mean negative log probability of its
    characters, 0 where there is none) lies within its language's band.  Repeated rows give
    repeated rows; an empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    arrays, rare = tiers(train(docs))
    frequent = spark.sparkContext.broadcast(arrays)

    def score(parts):
        hot = HashArrays(*(np.frombuffer(b, k) for b, k in zip(frequent.value, (np.uint64, np.float32), strict=True)))
        base, seen = TaskContext.get().partitionId() << 33, 0
        rest_kind = pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int64())]))
        for batch in parts:
            texts, lo = [t or "" for t in batch.column(1).to_pylist()], 0
            for run in batches(texts, lambda t: len(t) + 16, BATCH_CHARS):
                counts = np.array([surface_counts(t) for t in run], np.int64)
                cut = batch.slice(lo, len(run))
                failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
                sums, sizes, rest = look_up(run, hot)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(base + seen + lo, base + seen + lo + len(run))), cut.column(0),
                     cut.column(2), *map(pa.array, counts.T), pa.array(failed), pa.array(sums, pa.float64()),
                     pa.array(sizes), pa.array(rest, rest_kind)],
                    names=COLUMNS)
                lo += len(run)
            seen += len(texts)

    scored = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text"),
                    F.col("lang").cast("string").alias("lang")).mapInArrow(score, SCORED), "quality-lookups")
    asked = scored.select("row", F.inline("rest")).join(rare, "hash")
    answered = asked.groupBy("row").agg(F.sum(F.col("n") * F.col("logp").cast("double")).alias("rest_sum"))
    total = F.col("hot_sum") + F.coalesce("rest_sum", F.lit(0.0))
    scored = materialize(
        scored.drop("rest").join(answered, "row", "left")
        .withColumn("log_ppl", F.when(F.col("n_grams") > 0, -total / F.col("n_grams")).otherwise(F.lit(0.0)))
        .withColumn("lang_key", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")))
        .drop("row", "hot_sum", "rest_sum", "n_grams"), "quality-scores")
    inside = F.col("log_ppl").between(F.col("low"), F.col("high"))
    return (scored.join(F.broadcast(bands(scored)), "lang_key", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
                    "lang", "log_ppl", "low", "high"))
