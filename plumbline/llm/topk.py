"""Exact top-k inner products by norm buckets with local cosine thresholds.

Vectors are grouped by length (norm) into buckets a fixed factor wide, and buckets are cut
into blocks of bounded size, so a bucket that holds all vectors is many blocks. Scores with
the longest vectors give each query a first threshold: its k-th best score so far. For a
bucket with longest vector L the threshold divided by |query| * L is the cosine that a
vector of that bucket must reach. A query skips buckets where it exceeds 1. In the others
the method is chosen per query and block:

* a high cosine: coordinate pruning. On the coordinates where the query is largest, only a
  range of the candidate's normalised coordinate can reach the cosine;
* otherwise length pruning. Candidates are ordered by length; those shorter than
  threshold / |query| cannot reach it.

What is left is verified by the full product. Pruning keeps a tolerance for rounding and
never drops a candidate that reaches the threshold, ties included, so results are exact.

Queries and candidates meet in blocks: (query block, candidate block) is a group of at most
QUERY_BLOCK + BLOCK rows. Equal vectors share their score, so of one vector only the k + 1
smallest ids are candidates (a query may be one of them); this bounds a vector repeated
without end and loses nothing.

Cases: vectors that are NULL or hold NULL, NaN or infinite components take no part, nor do
rows with a NULL key. Vectors of another dimension than the query's are no candidates.
Repeated rows (same key and vector) count once. A query with fewer candidates gets all of
them. Empty vectors score 0 with each other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import durable

#: Rows of a candidate block, of a query block, and vectors that give the first thresholds.
BLOCK, QUERY_BLOCK, SEED = 4096, 2048, 1024
#: Buckets per doubling of the squared norm; a squared norm is below 2^126.
PER_DOUBLING = 2
#: Cosine from which coordinate pruning is chosen, and the number of coordinates it looks at.
HIGH_COSINE, FOCUS = 0.6, 4
#: Components whose products stay exact in double arithmetic at any dimension below 2^13.
EXACT = 1 << 20


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """key, vec (floor(scale * x) of each component) and norm of the vectors that take part."""
    bad = F.exists(
        F.transform(vector_col, lambda x: x.cast("double")),
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
    )
    vec = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad)
    rows = rows.select(F.col(id_col).cast("long").alias("key"), vec.alias("vec"))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.withColumn("norm", F.sqrt(square))


def _matrix(vecs: pd.Series) -> np.ndarray:
    found = np.stack([np.asarray(v, dtype=np.int64) for v in vecs]) if len(vecs) else np.zeros((0, 0), np.int64)
    return found


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    small = max(np.abs(queries).max(initial=0), np.abs(candidates).max(initial=0)) < EXACT
    if small and queries.shape[-1] < 1 << 13:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def _best(scores: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then smaller key; all places tied with the k-th are weighed."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((keys[places], -scores[places]))][:k]


def _feasible(query: np.ndarray, unit: np.ndarray, cosine: float) -> np.ndarray:
    """Candidates whose coordinates, on the query's largest ones, can reach the cosine.

    With q, c the parts of the unit vectors on one coordinate, the cosine is at most
    q*c + sqrt(1-q^2) * sqrt(1-c^2); this is at least t only while the angle between
    (q, sqrt(1-q^2)) and (c, sqrt(1-c^2)) is at most acos(t).
    """
    alive = np.ones(len(unit), bool)
    reach = np.arccos(np.clip(cosine - 1e-9, -1.0, 1.0))
    for f in np.argsort(-np.abs(query))[:FOCUS]:
        angle = np.arccos(np.clip(query[f], -1.0, 1.0))
        low, high = np.cos(min(np.pi, angle + reach)) - 1e-9, np.cos(max(0.0, angle - reach)) + 1e-9
        alive &= (unit[:, f] >= low) & (unit[:, f] <= high)
    return alive


def _search(k: int):
    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        if len(candidates) and len(queries):
            candidates = candidates.sort_values("norm", ascending=False, kind="stable")
            keys, norms, c = candidates["key"].to_numpy(), candidates["norm"].to_numpy(), _matrix(candidates["vec"])
            unit = c / np.where(norms > 0, norms, 1.0)[:, None]
            longest = norms[0]
            q = _matrix(queries["vec"])
            for i, (query, norm, least) in enumerate(
                zip(queries["query"], queries["norm"], queries["least"], strict=True)
            ):
                places = None
                if not np.isnan(least) and norm > 0 and longest > 0:
                    cosine = least / (norm * longest)
                    if cosine > 1 + 1e-9:
                        continue
                    if cosine >= HIGH_COSINE:
                        places = np.flatnonzero(_feasible(q[i] / norm, unit, cosine))
                    elif least > 0:
                        # Lengths fall: the first too short one ends the list.
                        places = np.arange(np.searchsorted(-norms, -(least / norm) * (1 - 1e-9), side="right"))
                if places is None:
                    places = np.arange(len(keys))
                places = places[keys[places] != query]
                if len(places):
                    scores = _products(q[i : i + 1], c[places])[0]
                    top = _best(scores, keys[places], k)
                    found += [(query, int(keys[places[t]]), int(scores[t])) for t in top]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def _first_thresholds(seed: list, k: int):
    """Per query the k-th best score with other vectors among the seed, NULL if they are fewer."""
    keys = np.array([r["key"] for r in seed], dtype=np.int64)
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {len(r["vec"]) for r in seed}:
        places = [i for i, r in enumerate(seed) if len(r["vec"]) == size]
        by_size[size] = keys[places], np.array([seed[i]["vec"] for i in places], dtype=np.int64).reshape(len(places), size)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            least = []
            for key, vec in zip(batch["key"], batch["vec"], strict=True):
                held, vectors = by_size.get(len(vec), (keys[:0], np.zeros((0, len(vec)), np.int64)))
                scores = _products(np.asarray(vec, np.int64)[None, :], vectors[held != key])[0]
                least.append(float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None)
            yield batch.assign(least=pd.array(least, dtype="Float64"))

    return apply


def _block(rows: int, column: Column) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(rows)), F.lit(rows)).cast("int")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of each query, ties to the smaller key.

    `is_query` is a condition on the column `key`; candidates are all other rows.
    """
    rows = quantised(vectors, id_col, vector_col, scale)
    same = Window.partitionBy("vec").orderBy("key")
    candidates = rows.withColumn("_place", F.dense_rank().over(same)).where(F.col("_place") <= k + 1)
    bucket = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * 2 * PER_DOUBLING)).otherwise(-1).cast("int")
    candidates = durable(
        candidates.drop("_place")
        .dropDuplicates(["key", "vec"])
        .withColumns({"bucket": bucket, "size": F.size("vec")})
    )
    # At most 126 * PER_DOUBLING + 2 buckets per dimension, whatever the number of rows.
    known = candidates.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top")).collect()
    schema = "query_id long, rank int, vec_id long, score long"
    if not known:
        return vectors.sparkSession.createDataFrame([], schema)
    seed = candidates.orderBy(F.desc("norm"), "key").limit(SEED).collect()
    queries = rows.where(is_query).dropDuplicates(["key", "vec"])
    queries = durable(
        queries.mapInPandas(_first_thresholds(seed, k), "key long, vec array<bigint>, norm double, least double")
    )
    query_blocks = -(-queries.count() // QUERY_BLOCK) or 1

    # Buckets a query must visit, then the blocks of each; the list of buckets is a literal.
    blocks = {(r["size"], r["bucket"]): -(-r["n"] // BLOCK) for r in known}
    lists = F.array(
        *[
            F.struct(
                F.lit(r["size"]).alias("size"),
                F.lit(r["bucket"]).alias("bucket"),
                F.lit(blocks[r["size"], r["bucket"]]).alias("blocks"),
                F.lit(float(r["top"])).alias("top"),
            )
            for r in known
        ]
    )
    reach = F.col("norm") * F.col("b.top") * (1 + 1e-9)
    wanted = (
        queries.withColumn("qblock", _block(query_blocks, F.col("key")))
        .withColumn("b", F.explode(lists))
        .where((F.col("b.size") == F.size("vec")) & (F.col("least").isNull() | (reach >= F.col("least"))))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("b.blocks") - 1)))
        .select(
            F.col("key").alias("query"), "vec", "norm", "least", F.col("b.size").alias("size"),
            F.col("b.bucket").alias("bucket"), "block", "qblock",
        )
    )
    count = F.element_at(
        F.map_from_arrays(
            F.array(*[F.lit(f"{s}/{b}") for s, b in blocks]), F.array(*[F.lit(n) for n in blocks.values()])
        ),
        F.concat_ws("/", "size", "bucket"),
    )
    dealt = candidates.withColumn("block", F.pmod(F.xxhash64("key"), count).cast("int")).withColumn(
        "qblock", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )
    group = ["size", "bucket", "block", "qblock"]
    near = dealt.groupBy(*group).cogroup(wanted.groupBy(*group))
    found = near.applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
