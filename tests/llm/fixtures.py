"""Small tables with every awkward case, and what a plain program makes of them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

# Names that operators use themselves, as further columns of the table.
CLASHING = [
    "kept", "size", "score", "bucket", "key", "spans", "n_shingles", "row", "cls", "digest", "text_hash", "shard",
    "_blob", "_salt", "_spans", "_gone", "_hash", "_key", "_row", "_text", "_doc", "_bytes",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def words(rng: random.Random, count: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 9))) for _ in range(count))


def odd_rows(seed: int = 1) -> list[tuple]:
    """Documents with NULLs in any column, empty, long, repeated, equal, near and shared texts."""
    rng = random.Random(seed)
    base, passage = words(rng, 120), words(rng, 60)
    near = base.split()
    near[5] = "changed"
    texts = [
        (0, base), (1, base), (2, " ".join(near)), (3, None), (4, ""), (5, "   \n\t"), (6, "one"), (7, "ONE"),
        (8, "two words"), (9, words(rng, 30) + " " + passage + " " + words(rng, 30)),
        (10, words(rng, 25) + " " + passage + " " + words(rng, 45)), (11, words(rng, 40_000)),
        (12, "ab" * 400), (13, "x" * 5000), (14, words(rng, 10) + ' password = "hunter2hunter2" AKIA' + "A1B2" * 5),
        (15, "日本語 😀 Σ ΑΣ ÀÉ " + "deadbeef" * 4), (16, base), (16, base), (17, words(rng, 8)),
        (17, words(rng, 9)), (None, base), (None, words(rng, 12)), (None, None), (18, passage), (19, "1234 !! 5678"),
    ]
    rows = []
    for place, (key, text) in enumerate(texts):
        lang = [None, "en", "fr"][place % 3]
        rows.append((key, text, lang, None if place % 4 == 0 else "src", None if place % 5 == 0 else 1, *["?"] * len(CLASHING)))
    return rows


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(spark: SparkSession, texts: list[tuple]) -> DataFrame:
    """A table of key and text."""
    return spark.createDataFrame(texts, "doc_id long, text string")


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_rows()).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
