"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text is built; a text is parsed greedily into
the longest phrases that occur in the labelled text (a letter it lacks is a phrase of its
own).  Few phrases mean that the text is well described by the language: the language
with the fewest phrases per letter, normalised by log2 of its reference length (the cost
of pointing at a phrase), wins.

Reading an automaton from its root, a failed step restarts at the root with the same
letter, so the greedy parse is itself a deterministic automaton: a dense table gives next
state and "a phrase begins here" for (state, letter).  Every language has all letters of
its reference as its own alphabet; transitions by letters beyond the DENSE_LETTERS most
frequent ones stand in a sorted array instead of the table.  Blocks of many texts step
through the tables together, one vectorised step per letter.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.llm.common import batches, prepare

SAMPLE_TEXTS = 48         # labelled texts per language, picked by hash (bounded sample)
REFERENCE_CHARS = 24_000  # normalised letters of them that make a language's reference
BLOCK = 1024              # phrases do not cross blocks of this many normalised letters
BATCH_CHARS = 3_000_000
DENSE_LETTERS = 250       # letters of a language with a column in its parse table
PREDICTED = "__predicted_language"

_LETTER: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """True for every code point that is a letter (built once per worker)."""
    if "is" not in _LETTER:
        _LETTER["is"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER["is"]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def normalised(text: str) -> np.ndarray:
    """Lower-cased letters with one space for every run of other characters, none outside."""
    codes = code_points(text.lower())
    codes = np.where(letter_table()[codes], codes, 32)
    space = codes == 32
    keep = ~space
    if len(codes):
        keep[1:] |= ~space[:-1]
    out = codes[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def suffix_automaton(letters: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence (state 0 is the root)."""
    edges, link, length, last = [{}], [-1], [0], 0
    for c in letters:
        state = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in edges[p]:
            edges[p][c] = state
            p = link[p]
        if p != -1:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return edges


class Reference:
    """Parse table of one language (``letters``: classes 1..n_classes - 1 of its reference)."""

    def __init__(self, letters: np.ndarray, n_classes: int):
        seen = np.bincount(letters, minlength=n_classes)
        alphabet = np.argsort(-seen, kind="stable")[:np.count_nonzero(seen)]
        # The language's own letters from 1 on, most frequent first; 0: a letter it lacks.
        self.own = np.zeros(n_classes, np.int32)
        self.own[alphabet] = np.arange(1, len(alphabet) + 1)
        edges = suffix_automaton(self.own[letters].tolist())
        self.bits = float(np.log2(max(len(letters), 2)))
        self.width = width = min(len(alphabet), DENSE_LETTERS) + 1
        self.rare = len(alphabet) + 1 - width
        # Entry: 2 * (row start of the next state) + phrase begins.
        root = np.ones(len(alphabet) + 1, np.int32)   # letter it lacks: a phrase, back to the root
        for c, t in edges[0].items():
            root[c] = 2 * t * width + 1
        table = np.tile(root[:width], (len(edges), 1))
        rare = {}
        for s, out in enumerate(edges[1:], 1):
            for c, t in out.items():
                if c < width:
                    table[s, c] = 2 * t * width
                else:
                    rare[s * width * self.rare + c - width] = 2 * t * width
        self.table = table.ravel()
        self.rare_root = root[width:]
        self.rare_keys = np.array(sorted(rare), np.int64)
        self.rare_entries = np.array([rare[k] for k in self.rare_keys.tolist()], np.int64)

    def rare_values(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Entries for letters without a column in the table."""
        value = self.rare_root[letter - self.width].astype(np.int64)
        if len(self.rare_keys):
            wanted = state * self.rare + letter - self.width
            at = np.minimum(np.searchsorted(self.rare_keys, wanted), len(self.rare_keys) - 1)
            value = np.where(self.rare_keys[at] == wanted, self.rare_entries[at], value)
        return value

    def phrases(self, steps: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases per lane; ``steps[i, :active[i]]`` are the lanes' i-th letters."""
        steps = self.own[steps]
        state = np.zeros(steps.shape[1], np.int64)
        count = np.zeros(steps.shape[1], np.int32)
        for i, n in enumerate(active):
            letter = steps[i, :n]
            if self.rare:
                value = self.table[state[:n] + np.minimum(letter, self.width - 1)].astype(np.int64)
                far = np.flatnonzero(letter >= self.width)
                value[far] = self.rare_values(state[far], letter[far])
            else:
                value = self.table[state[:n] + letter]
            count[:n] += value & 1
            state[:n] = value >> 1
        return count


class Model:
    """References of all learned languages."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        letters = {lang: normalised(text)[:REFERENCE_CHARS] for lang, text in samples}
        codes = np.unique(np.concatenate([*letters.values(), [32]])).astype(np.int64)
        self.classes = np.zeros(0x110000, np.int32)      # 0: in no reference
        self.classes[codes] = np.arange(1, len(codes) + 1)
        self.langs = [lang for lang, _ in samples]
        self.references = [Reference(self.classes[letters[x]], len(codes) + 1)
                           for x in self.langs]

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Normalised phrases (texts x languages) and number of normalised letters."""
        coded = [self.classes[normalised(t)] for t in texts]
        lengths = np.array([len(c) for c in coded], np.int64)
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        sizes = np.full(len(owner), BLOCK, np.int64)
        full = blocks > 0
        sizes[np.cumsum(blocks)[full] - 1] = lengths[full] - (blocks[full] - 1) * BLOCK
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
        order = np.argsort(-sizes, kind="stable")
        flat = np.concatenate(coded) if coded else np.zeros(0, np.int32)
        height = int(sizes.max()) if len(sizes) else 0
        steps = np.zeros((height, len(order)), np.int32)
        for lane, b in enumerate(order):
            steps[:sizes[b], lane] = flat[starts[b]:starts[b] + sizes[b]]
        active = np.searchsorted(-sizes[order], -np.arange(height), side="left")
        cost = np.zeros((len(texts), len(self.references)))
        for k, ref in enumerate(self.references):
            cost[:, k] = ref.bits * np.bincount(
                owner[order], ref.phrases(steps, active), minlength=len(texts))
        return cost, lengths

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        alpha = letter_table()
        for run in batches(texts, lambda t: len(t or "") + 64, BATCH_CHARS):
            cost, lengths = self.costs([t or "" for t in run])
            for t, row, n in zip(run, cost, lengths, strict=True):
                if not n or not self.langs or not alpha[code_points(t)].any():
                    out.append(("und", 0.0))
                    continue
                rate = row / n
                best = int(np.argmin(rate))
                share = np.exp2(-(rate - rate[best]) * min(n, 200))
                out.append((self.langs[best], float(1 / share.sum())))
        return out


@lru_cache(maxsize=2)
def model(samples: tuple[tuple[str, str], ...]) -> Model:
    """The worker's model for a set of samples (kept between tasks)."""
    return Model(samples)


def even_reference(texts: list[str]) -> str:
    """REFERENCE_CHARS normalised letters, as evenly from all texts as their lengths allow."""
    parts = ["".join(map(chr, normalised(t).tolist())) for t in texts]
    left = REFERENCE_CHARS + 1
    for k, i in enumerate(sorted(range(len(parts)), key=lambda i: len(parts[i]))):
        parts[i] = parts[i][:max(left // (len(parts) - k) - 1, 0)]       # and a space
        left -= len(parts[i]) + 1
    return " ".join(parts)


def labelled_samples(labelled: DataFrame) -> tuple[tuple[str, str], ...]:
    """Reference text per language from a bounded sample of the labelled rows.

    Every language takes at most SAMPLE_TEXTS texts, the one of smallest hash out of each
    of as many hash buckets, so copies of one text count once and no source dominates.
    """
    h = F.xxhash64("text")
    picked = (labelled.where("lang is not null and text is not null")
              .groupBy("lang", F.pmod(h, F.lit(SAMPLE_TEXTS)).alias("bucket"))
              .agg(F.min(h).alias("h")))
    cut = F.substring("text", 1, REFERENCE_CHARS)
    rows = (labelled.withColumn("h", h).join(F.broadcast(picked), ["lang", "h"])
            .groupBy("lang", "h").agg(F.min(cut).alias("text")).collect())
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        texts.setdefault(r.lang, []).append((r.h, r.text))
    out = []
    for lang in sorted(texts):
        joined = even_reference([t for _, t in sorted(texts[lang])])
        if len(normalised(joined)):
            out.append((lang, joined))
    return tuple(out)


def identify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang_pred, score.

    ``labelled``: text, lang (null texts or languages are not learned from).  ``docs``:
    doc_id, text; nothing else of it is read.  A text that is null, empty or without a
    letter is ``und`` with score 0, as is every text when no language could be learned.
    Ties go to the language first in code order.  Repeated rows give repeated rows.
    """
    prepare(docs.sparkSession)
    return _predicted(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                  F.col("text").cast("string").alias("text")),
                      labelled).toDF("doc_id", "text", "lang_pred", "score").drop("text")


def keep_identified(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The documents in which a language is found, all columns unchanged."""
    prepare(docs.sparkSession)
    return _predicted(docs, labelled).where(f"{PREDICTED} != 'und'").select(*docs.columns)


def _predicted(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` with prediction and score appended (one narrow pass)."""
    samples = docs.sparkSession.sparkContext.broadcast(labelled_samples(labelled))
    text_at = docs.columns.index("text")
    fields = [*docs.schema.fields, T.StructField(PREDICTED, T.StringType()),
              T.StructField(PREDICTED + "_score", T.DoubleType())]

    def predict(parts):
        m = model(samples.value) if samples.value else None
        for batch in parts:
            texts = batch.column(text_at).to_pylist()
            got = m.predict(texts) if m else [("und", 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())],
                names=[f.name for f in fields])

    return docs.mapInArrow(predict, T.StructType(fields))
