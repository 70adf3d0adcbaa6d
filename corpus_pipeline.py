"""The corpus pipeline: five stages, each a table that the next one reads.

Language identification drops what it rejects, exact and near duplicates keep one document of
each group, secrets are replaced by a mark in the texts, and what is left is packed into
sequences. All stages but the last return the columns of documents. Texts that differ in
nothing, NULLs and empty tables are handled as the operators state.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.llm import exact_dedup, language_id, minhash, secret_scan  # noqa: E402
from plumbline.llm.common import durable, forget, table  # noqa: E402
from plumbline.llm.queries import packed_pieces  # noqa: E402

#: Words that the packing stage holds in a worker, which other stages use after it: time for memory.
REMEMBERED = 60_000


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin; learnt from the labelled ones."""
    learnt = language_id.fit(docs, ~language_id.held_out(F.col("doc_id")))
    return language_id.predict(docs, learnt).where("not rejected").select("_row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on shingles of five words."""
    return minhash.keep_first(docs, words=5, percent=80)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packed_pieces(docs, REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: No SQL expresses compression, MinHash or the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written, reread by the next stage, then deleted."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        before = docs
    return docs
