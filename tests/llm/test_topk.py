"""Top-k search against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, scale=256):
    held = {}
    for key, vector, _ in rows:
        if key is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            held[key] = np.floor(scale * np.array(vector, np.float64)).astype(np.int64)
    found = set()
    for query, q in held.items():
        if query % 50 == 0:
            scores = sorted((-int(q @ c), key) for key, c in held.items() if key != query and len(c) == len(q))
            found |= {(query, i + 1, key, -s) for i, (s, key) in enumerate(scores[:k])}
    return found


def search(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return {tuple(r) for r in topk.top_k(frame, F.col("key") % 50 == 0).collect()}


def vectors(count, size, spread, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(count, size)) * rng.lognormal(0, spread, count)[:, None]
    return [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(base)]


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_matches_all_products_in_many_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "SEED", 30)
    rows = vectors(900, 12, spread)
    assert search(spark, rows) == brute(rows)


def test_both_prunings_are_taken(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8))
    rows = [(i, (centres[i % 20] * (1 + i % 3) + rng.normal(size=8) * 0.05).tolist(), 0) for i in range(600)]
    for cosine in (0.0, 2.0):
        monkeypatch.setattr(topk, "HIGH_COSINE", cosine)
        assert search(spark, rows) == brute(rows)


def test_ties_copies_and_vectors_that_take_no_part(spark):
    rows = vectors(120, 6, 0.5, 3)
    rows += [(200 + i, rows[7][1], 0) for i in range(300)]
    rows += [(600, None, 0), (601, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (602, [float("nan")] * 6, None)]
    rows += [(603, [float("inf")] * 6, 0), (604, [0.0] * 6, 0), (650, [0.0] * 6, 0), (None, [1.0] * 6, 0)]
    rows += [(700, [], 0), (701, [], 0), (750, [2.0], 0), (751, [3000.0], 0)]
    rows += [rows[5], rows[50]]
    assert search(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**19) + 3 * i)], 0) for i in range(0, 120)]
    assert search(spark, rows) == brute(rows)


def test_fewer_candidates_than_k_and_none(spark):
    assert search(spark, vectors(3, 4, 0.1)) == brute(vectors(3, 4, 0.1))
    assert search(spark, []) == set()
    assert search(spark, [(50, [1.0], 0)]) == set()
