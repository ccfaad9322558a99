"""Corpus pipeline: the training-data operators applied to ``documents`` in stages.

Every stage works on all rows its predecessor kept; all but the last return the columns of
``documents``.  Between stages the rows are written as Parquet to the scratch folder and
read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm.common import DOCUMENT_COLUMNS, materialize, prepare, read_table
from usagelens.llm.decontaminate import drop_contaminated
from usagelens.llm.jaccard_join import keep_one_per_class
from usagelens.llm.language_id import keep_identified
from usagelens.llm.packing import pack
from usagelens.llm.queries import SEQUENCE_TOKENS, vocabulary
from usagelens.llm.suffix_dedup import remove_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; the languages are learned from labelled ones."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    return keep_identified(docs, docs.select("text", "lang"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of every class of near duplicates."""
    return keep_one_per_class(docs.select(*DOCUMENT_COLUMNS))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur earlier; documents of which nothing is left go."""
    cut = remove_repeats(docs.select(*DOCUMENT_COLUMNS))
    left = cut.where("n_removed = 0 or n_removed < n_bytes")
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    prepare(spark)
    return drop_contaminated(docs.select(*DOCUMENT_COLUMNS), read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, packed into sequences of at most 2048 tokens."""
    return pack(docs, vocabulary(), SEQUENCE_TOKENS)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# Language ID is learned and packing uses a tokenizer: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to ``documents``; each stage's rows are written and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
