"""Quality classifier: Naive Bayes support vectors (NB-SVM).

Features are indicators of n-grams: hashed character four-grams (case kept) and bigrams
of word shapes (case, symbols, equality with a word just before).  Each indicator is
scaled by the log ratio of its smoothed counts in the two classes, counted by Spark over
every labelled training row; a linear hinge-loss model is then fitted to a bounded sample
of rows by dual coordinate descent, and its margins are calibrated to probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import batches, prepare

CHAR_BITS = 15
CHARS = 1 << CHAR_BITS
SHAPES = 60
FEATURES = CHARS + SHAPES * SHAPES
BATCH_CHARS = 500_000
# Bounded sample for the hinge-loss fit: at most this many rows of each class.
SAMPLE_ROWS = 2_500
REGULAR = 1.0
EPOCHS = 12

_TABLES: dict[str, np.ndarray] = {}


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Character class (0-63) and kind (0 space, 1 lower, 2 upper, 3 symbol, 4 shout, 5 other)."""
    if "class" not in _TABLES:
        cls = np.full(0x110000, 57, np.uint8)
        cls[128:] = 58 + np.arange(128, 0x110000) % 5
        cls[97:123], cls[65:91] = np.arange(1, 27), np.arange(27, 53)
        cls[48:58] = 53
        cls[[ord(c) for c in ".,;:"]] = 54
        cls[[ord(c) for c in "!?"]] = 55
        cls[[ord(c) for c in "#*$%&|<>"]] = 56
        cls[[32, 9, 11, 12, 13]] = 0
        cls[10] = 63
        kind = np.full(0x110000, 5, np.uint8)
        low = [c for c in range(0x250) if chr(c).islower()]
        kind[low], kind[[c for c in range(0x250) if chr(c).isupper()]] = 1, 2
        kind[[ord(c) for c in "#*$%&|<>"]], kind[[ord(c) for c in "!?"]] = 3, 4
        kind[[32, *range(9, 14)]] = 0
        _TABLES["class"], _TABLES["kind"] = cls, kind
        _TABLES["power"] = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))
    return _TABLES["class"], _TABLES["kind"]


def raw_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) of every n-gram occurrence."""
    cls, kind = tables()
    pad = "   "
    codes = np.frombuffer((pad.join(["", *texts]) + pad).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) + 3 for t in texts])
    owner = np.concatenate((owner, np.full(3, len(texts) - 1)))
    c = cls[codes].astype(np.uint32)
    grams = (c[:-3] << 18) | (c[1:-2] << 12) | (c[2:-1] << 6) | c[3:]
    char = (grams * np.uint32(2654435761)) >> np.uint32(32 - CHAR_BITS)
    k = kind[codes]
    word = k != 0
    edge = np.flatnonzero(np.diff(word.astype(np.int8)))
    start, end = edge[::2] + 1, edge[1::2] + 1
    if not len(start):
        return owner[:-3], char.astype(np.int64)
    begin = np.zeros(len(codes), np.int64)
    begin[start] = np.diff(start, prepend=0)
    position = np.minimum(np.arange(len(codes)) - np.cumsum(begin), 4095)
    value = np.where(word, (codes.astype(np.uint64) + np.uint64(1))
                     * _TABLES["power"][np.maximum(position, 0)], np.uint64(0))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value)))
    h, who = total[end] - total[start], owner[start]

    def has(kind_id):
        s = np.concatenate(([0], np.cumsum(k == kind_id)))
        return s[end] - s[start]

    lower, upper, symbol, shout = has(1), has(2), has(3), has(4)
    case = np.select([(lower > 0) & (upper == 0), (lower > 0) & (k[start] == 2) & (upper == 1),
                      (upper > 1) & (lower == 0), (lower > 0) & (upper > 0)], [0, 1, 2, 3], 4)
    sign = np.select([symbol > 0, shout > 1, k[end - 1] == 5], [1, 2, 3], 0)
    same = np.zeros(len(h), np.int64)
    for back in (3, 2, 1):
        if len(h) > back:
            equal = (h[back:] == h[:-back]) & (who[back:] == who[:-back])
            same[back:][equal] = 1 if back == 1 else 2
    shape = (case * 4 + sign) * 3 + same
    pair = np.flatnonzero(who[1:] == who[:-1])
    bigram = CHARS + shape[pair] * SHAPES + shape[pair + 1]
    return (np.concatenate((owner[:-3], who[pair])),
            np.concatenate((char.astype(np.int64), bigram)))


def indicators(texts: list[str]) -> np.ndarray:
    """Boolean matrix texts x FEATURES."""
    m = np.zeros((len(texts), FEATURES), bool)
    if texts:
        who, feature = raw_features(texts)
        m[who, feature] = True
    return m


def text_runs(texts: list[str | None]):
    """Texts (null: empty) in runs whose indicator matrix stays small."""
    return batches([t or "" for t in texts], lambda t: len(t) + 4000, BATCH_CHARS)


def class_counts(parts):
    """Per task: texts of each class that hold a feature."""
    n = np.zeros((2, FEATURES), np.int64)
    for batch in parts:
        labels = np.array(batch.column(1).to_pylist(), np.int64)
        lo = 0
        for run in text_runs(batch.column(0).to_pylist()):
            m, y = indicators(run), labels[lo:lo + len(run)]
            for label in (0, 1):
                n[label] += m[y == label].sum(axis=0)
            lo += len(run)
    seen = np.flatnonzero(n.sum(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(n[0, seen]), pa.array(n[1, seen])], names=["f", "n0", "n1"])


def sample_features(parts):
    """Label and feature list of every sampled row."""
    for batch in parts:
        labels = batch.column(1).to_pylist()
        lo = 0
        for run in text_runs(batch.column(0).to_pylist()):
            lists = [np.flatnonzero(row).tolist() for row in indicators(run)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[lo:lo + len(run)], pa.int32()),
                 pa.array(lists, pa.list_(pa.int32()))], names=["y", "features"])
            lo += len(run)


def log_ratio(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log-count ratio of the classes with add-one smoothing."""
    p, q = n1 + 1.0, n0 + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray,
                            c: float = REGULAR, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bias last) of the L2-regularised hinge loss over rows scaled to length one.

    Row i holds the features ``rows[i]`` with values ``ratio``; y is -1 or 1.  Each step
    solves the dual for one row exactly; classes are weighted to equal mass.
    """
    w = np.zeros(len(ratio) + 1)
    alpha = np.zeros(len(rows))
    values = [unit(ratio[r]) for r in rows]
    square = np.array([float(v @ v) + 1.0 for v in values])
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9)) * c
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), weight[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                w[-1] += step
                alpha[i] = new
    return w


def unit(v: np.ndarray) -> np.ndarray:
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def margins(rows, ratio, w) -> np.ndarray:
    return np.array([w[r] @ unit(ratio[r]) + w[-1] for r in rows])


def calibrate(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic fit of the label on the margin."""
    a, b = 1.0, 0.0
    target = y > 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = weight * (p - target)
        s = weight * p * (1 - p) + 1e-9
        grad = np.array([g @ margin + 1e-3 * (a - 1.0), g.sum()])
        hess = np.array([[s @ margin ** 2 + 1e-3, s @ margin], [s @ margin, s.sum()]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
    return float(max(a, 1e-3)), float(b)


class Model:
    """Scaled weights, their squared scales and the calibration."""

    def __init__(self, ratio: np.ndarray, w: np.ndarray, a: float, b: float):
        self.weight, self.square = w[:-1] * ratio, ratio ** 2
        self.bias, self.a, self.b = float(w[-1]), a, b

    def score(self, texts: list[str]) -> np.ndarray:
        who, feature = np.nonzero(indicators(texts))
        square = np.bincount(who, self.square[feature], len(texts))
        margin = np.bincount(who, self.weight[feature], len(texts))
        margin = margin / np.sqrt(np.maximum(square, 1e-24)) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.a * margin + self.b, -30, 30)))


def fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, prior: float) -> Model:
    """Fit on all sampled rows; calibrate on margins of rows left out of a half fit each."""
    fold = np.arange(len(rows)) % 2
    left_out = np.zeros(len(rows))
    for k in (0, 1):
        own, other = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        w = dual_coordinate_descent([rows[i] for i in other], y[other], ratio)
        left_out[own] = margins([rows[i] for i in own], ratio, w)
    share = max((y > 0).mean(), 1e-9), max((y < 0).mean(), 1e-9)
    a, b = calibrate(left_out, y, np.where(y > 0, prior / share[0], (1 - prior) / share[1]))
    return Model(ratio, dual_coordinate_descent(rows, y, ratio), a, b)


def train(docs: DataFrame, labels: DataFrame) -> Model | float:
    """Model of ``labels`` (doc_id, label 0/1) over ``docs``; the prior if a class is missing.

    All labelled rows enter the log-count ratios; the hinge loss is fitted to the
    SAMPLE_ROWS rows of smallest id hash per class.
    """
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = labels.where("doc_id is not null and label in (0, 1)").select(
        "doc_id", F.col("label").cast("int").alias("label"))
    counted = (text.join(known.hint("shuffle_hash"), "doc_id").select("text", "label")
               .mapInArrow(class_counts, "f long, n0 long, n1 long")
               .groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))).toPandas()
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(sizes.values())
    if len(sizes) < 2 or not len(counted):
        return sizes.get(1, 0) / total if total else 0.5
    chosen = None
    for label in (0, 1):
        part = (known.where(F.col("label") == label)
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS))
        chosen = part if chosen is None else chosen.unionByName(part)
    sampled = (text.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
               .select("text", "label")
               .mapInArrow(sample_features, "y int, features array<int>")).toPandas()
    rows = [np.asarray(r, np.int64) for r in sampled["features"]]
    y = np.where(sampled["y"].to_numpy() > 0, 1.0, -1.0)
    n = np.zeros((2, FEATURES))
    n[:, counted["f"].to_numpy()] = counted[["n0", "n1"]].to_numpy().T
    return fit(rows, y, log_ratio(n[0], n[1]), sizes[1] / total)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, score (chance of label 1), predicted.

    ``docs``: doc_id, text; ``labels``: doc_id, label; nothing else is read, and scores
    depend on the text alone.  Null texts score as empty ones.  Labels that are null or
    neither 0 nor 1 are not learned from; with only one class (or none) every score is the
    share of label 1 (0.5 without labels).  Repeated rows give repeated rows.
    """
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(train(docs, labels))

    def score(parts):
        m = model.value
        for batch in parts:
            got = [np.full(len(run), m) if isinstance(m, float) else m.score(run)
                   for run in text_runs(batch.column(1).to_pylist())]
            s = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(score, "doc_id long, score double, predicted int"))
