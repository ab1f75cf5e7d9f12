"""From raw documents to encoded training text, in five stages.

Each stage takes the documents the one before kept. Low quality goes; of
documents of five-word shingle similarity 0.8 or more, linked directly or through
others, the one of smallest id stays, one without an id (null) only if no other
has one; strings of 100 bytes that an earlier
document holds go, in whole characters; documents that hold an item of the
benchmark go; the rest is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regraft.llm.bpe import bpe_documents
from regraft.llm.common import stage, table, without_rows
from regraft.llm.decontaminate import decontaminated
from regraft.llm.ngram_join import jaccard_rows
from regraft.llm.quality import accepted
from regraft.llm.queries import VOCABULARIES
from regraft.llm.suffix_dedup import without_repeats

REPEAT_BYTES = 100


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = jaccard_rows(docs, 5, 80).where("NOT doc_id <=> component_id")
    return without_rows(docs, rows.selectExpr("key_id AS doc_id", "key_mark AS mark"))


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs, REPEAT_BYTES)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_documents(docs, f"{VOCABULARIES}/word_bpe_49k.json")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeat_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", encode_stage),
]

#: SQL can express neither the classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
