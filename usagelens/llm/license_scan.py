"""License scans: exact phrases and an exact set-similarity join with license templates.

A text block is a window over the words of a whole text, as long as the template; line
breaks, comment marks and punctuation are no words, so a notice wrapped over many lines is
one block.  A block matches if it holds at least ``percent`` of the template's distinct
words.  Words are ordered by their frequency in the whole corpus, rare first.  Only windows
around a template's first n - need + 1 words can match (prefix filter); of these, stretches
of overlapping windows are looked at together: a stretch needs ``need`` template words at
all (length filter), and the positions of the shared words in both ordered sets bound what
can still be shared (positional filter).  In what passes a window slides and counts, so every
matching block is found.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import prepare

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PERCENT = 80

# Phrases whose words, standing consecutively, give a base label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences of public license notices and the label a matching block gets.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
            "this software and associated documentation files the software to deal in the "
            "software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "unless required by applicable law or agreed to in writing software "
                 "distributed under the license is distributed on an as is basis without "
                 "warranties or conditions of any kind either express or implied"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under "
            "the terms of the gnu general public license as published by the free software "
            "foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under "
             "the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial "
                 "4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case."""
    return WORD.findall((text or "").encode().lower())


class Templates:
    """Templates as sets of word ranks, indexed by their prefixes."""

    def __init__(self, templates, frequency: dict[bytes, int], percent: int):
        sets = [(label, set(words_of(t))) for label, t in templates]
        vocabulary = sorted(set().union(*(s for _, s in sets)) if sets else (),
                            key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.labels = [label for label, _ in sets]
        self.sets = [sorted(self.rank[w] for w in s) for _, s in sets]
        self.words = [s for _, s in sets]
        self.lengths = [len(words_of(t)) for _, t in templates]
        self.need = [-(-len(s) * percent // 100) for s in self.sets]
        self.index: dict[int, list[int]] = {}
        for t, ranks in enumerate(self.sets):
            for r in ranks[:len(ranks) - self.need[t] + 1]:
                self.index.setdefault(r, []).append(t)
        self.hooks = frozenset(w for w, r in self.rank.items() if r in self.index)

    def reachable(self, t: int, block: set[bytes]) -> bool:
        """Whether a set of words passes the length and the positional filter of a template."""
        ranks = sorted(self.rank[w] for w in block if w in self.rank)
        if len(ranks) < self.need[t]:
            return False
        place = {r: i for i, r in enumerate(self.sets[t])}
        shared = 0
        for j, r in enumerate(ranks):
            i = place.get(r)
            if i is not None:
                shared += 1
                if shared + min(len(place) - i - 1, len(ranks) - j - 1) < self.need[t]:
                    return False
        return shared >= self.need[t]

    def notices(self, words: list[bytes]) -> list[dict]:
        """The fullest window of every stretch of windows that hold a template."""
        if self.hooks.isdisjoint(words):
            return []
        near: dict[int, list[int]] = {}
        for p, w in enumerate(words):
            if w in self.hooks:
                for t in self.index[self.rank[w]]:
                    near.setdefault(t, []).append(p)
        found = []
        for t, places in near.items():
            reach = self.lengths[t] - 1
            lo, hi = places[0] - reach, places[0] + reach
            for p in places[1:]:
                if p - reach > hi:
                    found += self.stretches(t, words, lo, hi)
                    lo = p - reach
                hi = p + reach
            found += self.stretches(t, words, lo, hi)
        return found

    def stretches(self, t: int, words: list[bytes], lo: int, hi: int):
        """Notices of one template whose windows lie in words[lo..hi]."""
        lo, hi, length, wanted = max(lo, 0), min(hi, len(words) - 1), self.lengths[t], self.words[t]
        if not self.reachable(t, set(words[lo:hi + 1])):
            return
        held: Counter = Counter()
        best, at = 0, 0
        for i in range(lo, hi + 1):
            if words[i] in wanted:
                held[words[i]] += 1
            gone = i - length
            if gone >= lo and words[gone] in wanted:
                held[words[gone]] -= 1
                if not held[words[gone]]:
                    del held[words[gone]]
            if len(held) >= self.need[t]:
                if len(held) > best:
                    best, at = len(held), max(gone + 1, lo)
            elif best:
                yield {"first_word": at, "label": self.labels[t], "containment": best / len(wanted)}
                best = 0
        if best:
            yield {"first_word": at, "label": self.labels[t], "containment": best / len(wanted)}


def base_places(words: list[bytes], phrases: dict[str, str]) -> tuple[list[int], set[str]]:
    """Word positions at which a phrase starts, and the labels found."""
    line = b" " + b" ".join(words) + b" "
    places, labels = [], set()
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = line.find(wanted)
        while at >= 0:
            places.append(line.count(b" ", 0, at))
            labels.add(label)
            at = line.find(wanted, at + 1)
    return places, labels


def word_frequencies(docs: DataFrame, words: list[bytes], text: str = "text") -> dict[bytes, int]:
    """Occurrences of the given words over all documents (as many rows come back as words)."""
    wanted = frozenset(words)

    def count(parts):
        seen: Counter = Counter()
        for batch in parts:
            for t in batch.column(0).to_pylist():
                own = Counter(words_of(t))
                for w in wanted & own.keys():
                    seen[w] += own[w]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in seen], pa.string()),
             pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = (docs.select(F.col(text).cast("string")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    return {r.word.encode(): r.n for r in rows}


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates=TEMPLATES,
                 percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, notices (first_word, label, containment of the fullest window of every
    stretch of matching ones).

    ``docs``: doc_id, text; other columns are ignored.  A null text is an empty one: no
    words, no labels, score 0.  ``score`` is 1 where a phrase stands, else the largest
    containment of a window, else 0.  Repeated rows give repeated rows; an empty table gives
    an empty result; without templates only the phrases count.
    """
    prepare(docs.sparkSession)
    phrases = PHRASES if phrases is None else phrases
    vocabulary = sorted({w for _, t in templates for w in words_of(t)})
    index = Templates(templates, word_frequencies(docs, vocabulary), percent)

    def scan(text: str | None):
        words = words_of(text)
        places, labels = base_places(words, phrases)
        notices = sorted(index.notices(words), key=lambda b: (b["first_word"], b["label"],
                                                              -b["containment"]))
        score = 1.0 if places else max((b["containment"] for b in notices), default=0.0)
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(labels)), ",".join(sorted(labels | {b["label"] for b in notices})),
                score, notices)

    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
        [("first_word", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
             "notices"]

    def scan_batches(parts):
        for batch in parts:
            rows = [scan(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", *names])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(scan_batches, "doc_id long, n_words long, n_base long, first_word long, "
                                      "last_word long, base_labels string, labels string, "
                                      "score double, notices array<struct<first_word: long, "
                                      "label: string, containment: double>>"))
