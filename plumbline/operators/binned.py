"""Random forests of limited depth over binned features, all trees a level at a time.

Rows are binned once and packed into blocks. A round counts, in each block, the rows that every tree
draws into the bins of the nodes that are open at its level, tree after tree; the counts of a node
meet in one task, which cuts it. The trees are dealt into groups, and a task adds up the counts of its
group over its blocks before they leave it, so what is shuffled depends on trees, open nodes and bins, and
hardly on the rows. Draws follow from seed, tree and block, so the nodes of rows are found again instead of kept.

The cuts and settings are those of Spark's forest, and the result is its model.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.durable import durable, forget, remove, shared_folder
from plumbline.schema import quoted

#: Rows and bytes of bins that a block holds at most: a task holds a few blocks at a time, whatever the table has.
BLOCK_ROWS, BLOCK_BYTES = 1 << 17, 1 << 22
#: Files of blocks end a group of rows by its bytes; by default they look at them after 100 rows, which are 100 blocks.
BLOCK_FILES = {
    "parquet.block.size": 1 << 23, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 4,
    "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 4,
}
#: Bytes of the batches in which blocks reach Python, and Spark's default, which is replaced.
BATCH_SETTING, BATCH, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "8m", "67108864b"
#: Tasks of a round for each core: each counts for some of the trees.
TASKS_A_CORE = 3
#: Sets that the blocks are dealt into for each group of trees, and bytes of counts that a task adds up over its blocks.
SETS, HELD_BYTES = 4, 1 << 28
#: Points that describe the values of a feature in one part of the rows.
POINTS = 1024
#: Nodes whose counts travel together, and nodes that a task counts at a time.
CHUNK, SLICE = 256, 1 << 13
#: Rows that go down a tree at a time.
STEP = 1 << 15
#: Share of a node's squares below which a gain is rounding.
ROUNDING = 1e-13
COUNTS = "tree int, first int, part long, w binary, s binary, q binary, n binary"
CUT = "tree int, node int, feature int, bin int, gain double, w double, s double, q double, n long"


_Sums = dict[str, np.ndarray]


@dataclass(frozen=True)
class _Tree:
    """The cuts of a tree so far by node; those from `opened` on are not cut yet. The right child follows the left one."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    opened: int

    def walked(self, x: np.ndarray, rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the rows reach an open node, and its place among them."""
        cells, left = x.reshape(-1), self.left.astype(np.int64)
        start = self.feature.astype(np.int64) * x.shape[1]
        ends, places = [], []
        # As many rows at a time as stay in the processor's cache.
        for first in range(0, len(rows), STEP):
            row = rows[first : first + STEP]
            node, going = np.zeros(len(row), np.int64), np.arange(first, first + len(row))
            for _ in range(depth):
                at = start.take(node)
                stays = at >= 0
                if not stays.all():
                    node, at, row, going = node[stays], at[stays], row[stays], going[stays]
                at += row
                node = left.take(node) + (cells.take(at) > self.bin.take(node))
            reached = node >= self.opened
            ends.append(going[reached])
            places.append(node[reached] - self.opened)
        return np.concatenate([np.zeros(0, np.int64), *ends]), np.concatenate([np.zeros(0, np.int64), *places])


@dataclass(frozen=True)
class _Round:
    depth: int
    trees: list[_Tree]
    bins: tuple[int, ...]
    kind: type
    seed: int
    bootstrap: bool


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``feature, value, weight``: all values of a feature that has few, else as many of even ranks."""
    for batch in batches:
        for f, column in enumerate(_matrix(batch).T if batch.num_rows else ()):
            value, weight = np.unique(column, return_counts=True)
            if len(value) > POINTS:
                ranks = (np.arange(POINTS) + 0.5) * len(column) / POINTS
                value, weight = value[np.searchsorted(np.cumsum(weight), ranks)], np.full(POINTS, len(column) / POINTS)
            yield pa.record_batch(
                {"feature": pa.array([f], pa.int32()), "value": pa.array([value], pa.list_(pa.float64())),
                 "weight": pa.array([weight], pa.list_(pa.float64()))}
            )


def thresholds(value: np.ndarray, weight: np.ndarray, bins: int) -> np.ndarray:
    """Cuts halfway between neighbouring values: all of them where they are few, else near even shares of the rows."""
    value, at = np.unique(value, return_inverse=True)
    upto = np.cumsum(np.bincount(at, weight))
    place = np.arange(len(value) - 1)
    if len(value) > bins:
        wanted = upto[-1] * np.arange(1, bins) / bins
        above = np.searchsorted(upto, wanted)
        below = np.maximum(above - 1, 0)
        nearer = np.where(wanted - upto[below] < upto[above] - wanted, below, above)
        place = np.unique(nearer[nearer < len(value) - 1])
    return value[place] / 2 + value[place + 1] / 2


def _fitted_thresholds(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    def merged(key: tuple, found: pa.Table) -> pa.Table:
        value, weight = (found.column(n).combine_chunks().flatten().to_numpy() for n in ("value", "weight"))
        return pa.table({"feature": found.column("feature")[:1], "cuts": pa.array([thresholds(value, weight, bins)], pa.list_(pa.float64()))})

    described = rows.select("x").mapInArrow(_described, "feature int, value array<double>, weight array<double>")
    found = described.groupBy("feature").applyInArrow(merged, "feature int, cuts array<double>").collect()
    cuts = {r["feature"]: np.array(r["cuts"], np.float64) for r in found}
    return [cuts[f] for f in range(width)]


def _kind(cuts: list[np.ndarray]) -> type:
    return np.uint8 if max(map(len, cuts)) < 256 else np.uint16


def _packed(cuts: list[np.ndarray], mean: float, limit: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            x = np.concatenate([b for b, _ in held], axis=1)
            y = np.concatenate([t for _, t in held])
            return pa.record_batch({"x": pa.array([x.tobytes()], pa.binary()), "d": pa.array([(y - mean).tobytes()], pa.binary())})

        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, limit):
                piece = batch.slice(start, limit)
                if rows + piece.num_rows > limit:
                    yield block()
                    held, rows = [], 0
                values = _matrix(piece)
                binned = np.stack([np.searchsorted(c, v).astype(_kind(cuts)) for c, v in zip(cuts, values.T, strict=True)])
                held.append((binned, piece.column("y").to_numpy()))
                rows += piece.num_rows
        if rows:
            yield block()

    return pack


def _counter(shared, groups: int):
    """Counts of each tree's open nodes by feature and bin: weights, weighted deviations, squares, rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Round = shared.value
        sizes = [len(t.feature) - t.opened for t in now.trees]
        held: dict[tuple[int, int], tuple[int, _Sums]] = {}
        group_held = None
        for batch in batches:
            for part, group, x, d in zip(*[batch.column(n) for n in ("part", "group", "x", "d")]):
                part, group = part.as_py(), group.as_py()
                mine = [t for t in range(group, len(now.trees), groups) if sizes[t]]
                added = 16 * (sum(now.bins) + 1) * sum(sizes[t] for t in mine) <= HELD_BYTES
                if group != group_held or not added:
                    yield from _sent(held)
                    held, group_held = {}, group
                d = np.frombuffer(d.as_buffer(), np.float64)
                x = np.frombuffer(x.as_buffer(), now.kind).reshape(-1, len(d))
                for tree in mine:
                    for start, sums in _counted(now, tree, part, x, d):
                        if not added:
                            yield from _pieces(tree, start, part, sums)
                        elif (tree, start) in held:
                            for total, more in zip(held[tree, start][1].values(), sums.values()):
                                total += more
                        else:
                            held[tree, start] = part, sums
        yield from _sent(held)

    return count


def _sent(held: dict[tuple[int, int], tuple[int, _Sums]]) -> Iterator[pa.RecordBatch]:
    for (tree, start), (part, sums) in held.items():
        yield from _pieces(tree, start, part, sums)


def _pieces(tree: int, start: int, part: int, sums: _Sums) -> Iterator[pa.RecordBatch]:
    for first in range(0, len(sums["n"]), CHUNK):
        some = {k: pa.array([a[first : first + CHUNK].tobytes()], pa.binary()) for k, a in sums.items()}
        where = {"tree": pa.array([tree], pa.int32()), "first": pa.array([start + first], pa.int32())}
        yield pa.record_batch(where | {"part": pa.array([part], pa.int64())} | some)


def _counted(now: _Round, tree: int, part: int, x: np.ndarray, d: np.ndarray) -> Iterator[tuple[int, _Sums]]:
    n, known = len(d), now.trees[tree]
    if now.bootstrap:
        # So many draws, each of any row: the times a row is drawn are independent Poisson numbers.
        chance = np.random.default_rng([now.seed & (2**64 - 1), tree, part])
        times = np.bincount(chance.integers(0, n, chance.poisson(n)), minlength=n)
        rows = np.flatnonzero(times)
        w = times[rows].astype(np.float64)
    else:
        rows, w = np.arange(n), np.ones(n)
    going, place = known.walked(x, rows, now.depth)
    size = len(known.feature) - known.opened
    if size > SLICE:
        order = np.argsort(place, kind="stable")
        going, place = going[order], place[order]
    rows, w = rows[going], w[going]
    for start in range(0, size, SLICE):
        some, mine, held, weight = min(SLICE, size - start), place, rows, w
        if size > SLICE:
            inside = slice(*np.searchsorted(place, [start, start + some]))
            mine, held, weight = place[inside] - start, rows[inside], w[inside]
        away = weight * d[held]
        cells_w, cells_s = [], []
        for f, bins in enumerate(now.bins):
            at = mine * bins
            at += x[f].take(held)
            cells_w.append(np.bincount(at, weight, some * bins).reshape(some, bins))
            cells_s.append(np.bincount(at, away, some * bins).reshape(some, bins))
        yield start, {
            "w": np.concatenate(cells_w, axis=1), "s": np.concatenate(cells_s, axis=1),
            "q": np.bincount(mine, away * d[held], some), "n": np.bincount(mine, minlength=some),
        }


def _cutter(bins: tuple[int, ...], opened: list[int], last: bool):
    """The best cut of each node, -1 for a leaf: the first feature, and within it the lowest cut, wins a tie."""
    ends = np.cumsum(bins)

    def cut(key: tuple, found: pa.Table) -> pa.Table:
        # One order whatever the shuffle delivered.
        found = found.sort_by("part")
        kinds = {"w": np.float64, "s": np.float64, "q": np.float64, "n": np.int64}
        sums = {k: sum(np.frombuffer(c.as_buffer(), kind) for c in found.column(k)) for k, kind in kinds.items()}
        q, n = sums["q"], sums["n"]
        w, s = sums["w"].reshape(len(n), -1), sums["s"].reshape(len(n), -1)
        w_all, s_all = w[:, : bins[0]].sum(1), s[:, : bins[0]].sum(1)
        best, feature, place = np.zeros(len(n)), np.full(len(n), -1), np.full(len(n), -1)
        # Weights are whole numbers, so an empty side is exactly 0.
        with np.errstate(divide="ignore", invalid="ignore"):
            for f, (count, end) in enumerate(zip(() if last else bins, ends)):
                if count < 2:
                    continue
                lw, ls = (np.cumsum(a[:, end - count : end - 1], axis=1) for a in (w, s))
                rw, rs = w_all[:, None] - lw, s_all[:, None] - ls
                gain = np.where((lw > 0) & (rw > 0), ls**2 / lw + rs**2 / rw - (s_all**2 / w_all)[:, None], 0.0)
                top = gain.argmax(axis=1)
                gained = gain[np.arange(len(n)), top]
                better = (gained > best) & (gained > ROUNDING * q)
                best[better], feature[better], place[better] = gained[better], f, top[better]
        tree, first = (k.as_py() for k in key)
        node = opened[tree] + first + np.arange(len(n))
        return pa.table(
            {"tree": pa.array([tree] * len(n), pa.int32()), "node": pa.array(node, pa.int32()), "feature": pa.array(feature, pa.int32()),
             "bin": pa.array(place, pa.int32()), "gain": pa.array(best), "w": w_all, "s": s_all, "q": q, "n": n}
        )

    return cut


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of a few megabytes inside, unless the session names a size."""
    replaced = spark.conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT
    if replaced:
        spark.conf.set(BATCH_SETTING, BATCH)
    try:
        yield
    finally:
        if replaced:
            spark.conf.unset(BATCH_SETTING)


def _dealt(rows: DataFrame, cuts: list[np.ndarray], mean: float, count: int, trees: int) -> tuple[DataFrame, int]:
    """``part, group, x, d``: the blocks, each once for every group of trees."""
    limit = max(1, min(BLOCK_ROWS, BLOCK_BYTES // len(cuts)))
    packed = rows.repartition(-(-count // limit)).mapInArrow(_packed(cuts, mean, limit), "x binary, d binary")
    numbered = durable(packed.select(F.monotonically_increasing_id().alias("part"), "x", "d"), **BLOCK_FILES)
    parts, cores = numbered.count(), rows.sparkSession.sparkContext.defaultParallelism
    sets = min(parts, SETS)
    groups = min(trees, -(-TASKS_A_CORE * cores // sets))
    each = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    dealt = numbered.select("part", each, "x", "d").repartitionByRange(sets * groups, "group", "part")
    blocks = durable(dealt.sortWithinPartitions("group", "part"), **BLOCK_FILES)
    forget(numbered)
    return blocks, groups


def _nodes(blocks: DataFrame, groups: int, cuts: list[np.ndarray], estimator: RandomForestRegressor) -> pa.Table:
    """All nodes of all trees. Like the model, they are held by the driver."""
    context, depth = blocks.sparkSession.sparkContext, estimator.getMaxDepth()
    none = np.full(1, -1, np.int32)
    trees = [_Tree(none, none, none, 0)] * estimator.getNumTrees()
    bins, levels = tuple(len(c) + 1 for c in cuts), []
    for at in range(depth + 1):
        # Nodes of the last level are leaves: only their totals are needed.
        counted = bins[:1] if at == depth else bins
        shared = context.broadcast(_Round(at, trees, counted, _kind(cuts), estimator.getSeed(), estimator.getBootstrap()))
        cutter = _cutter(counted, [t.opened for t in trees], at == depth)
        sums = blocks.mapInArrow(_counter(shared, groups), COUNTS)
        found = sums.groupBy("tree", "first").applyInArrow(cutter, CUT).toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
        shared.destroy()
        tree, feature, place = (found.column(n).to_numpy() for n in ("tree", "feature", "bin"))
        lefts = []
        for t, known in enumerate(trees):
            mine = slice(*np.searchsorted(tree, [t, t + 1]))
            cut, made = feature[mine] >= 0, len(known.feature)
            left = np.where(cut, made + 2 * (np.cumsum(cut) - 1), -1).astype(np.int32)
            lefts.append(left)
            fresh = np.full(2 * int(cut.sum()), -1, np.int32)
            trees[t] = _Tree(*(
                np.concatenate([old[: known.opened], new, fresh])
                for old, new in ((known.feature, feature[mine]), (known.bin, place[mine]), (known.left, left))
            ), made)
        levels.append(found.append_column("left", pa.array(np.concatenate(lefts))))
        if not (feature >= 0).any():
            break
    return pa.concat_tables(levels)


def _model(spark: SparkSession, nodes: pa.Table, cuts: list[np.ndarray], mean: float, shell: RandomForestRegressionModel):
    """Spark's model of these nodes: the saved form of a model of the same settings, its nodes replaced."""
    columns = ("feature", "bin", "gain", "w", "s", "q", "n", "left")
    feature, place, gain, w, s, q, n, left = (nodes.column(c).to_numpy() for c in columns)
    each = np.maximum(w, 1.0)
    values = {
        "prediction": np.where(w > 0, mean + s / each, 0.0), "impurity": np.maximum(q / each - (s / each) ** 2, 0.0),
        "count": w, "sum": s + w * mean, "squares": q + 2 * mean * s + w * mean**2, "rawCount": n,
        "gain": np.where(left >= 0, gain / each, -1.0), "leftChild": left, "rightChild": np.where(left >= 0, left + 1, -1),
        "featureIndex": feature,
        "leftCategoriesOrThreshold": pa.array([[cuts[f][b]] if f >= 0 else [] for f, b in zip(feature, place)], pa.list_(pa.float64())),
    }
    flat = pa.table({"treeID": nodes.column("tree"), "id": nodes.column("node")} | values)
    split = F.struct("featureIndex", "leftCategoriesOrThreshold", F.lit(-1).alias("numCategories")).alias("split")
    data = F.struct(
        "id", "prediction", "impurity", F.array("count", "sum", "squares").alias("impurityStats"), "rawCount", "gain",
        "leftChild", "rightChild", split,
    ).alias("nodeData")
    path = f"{shared_folder(spark).rstrip('/')}/plumbline/{uuid.uuid4().hex}"
    shell.save(path)
    spark.createDataFrame(flat).select("treeID", data).write.mode("overwrite").parquet(f"{path}/data")
    model = RandomForestRegressionModel.load(path)
    remove(spark, path)
    return model


def fit_forest(estimator: RandomForestRegressor, rows: DataFrame) -> RandomForestRegressionModel:
    """The model of Spark's forest estimator for regression, with all features tried at each cut."""
    spark, target = rows.sparkSession, estimator.getLabelCol()
    # Also raises what Spark raises for its settings.
    shell = estimator.fit(rows.limit(1))
    y = quoted(target).cast("double").alias("y")
    plain = rows.select(vector_to_array(estimator.getFeaturesCol()).alias("x"), y)
    broken = F.col("y").isNull() | F.isnan("y")
    count, faulty, mean = plain.agg(F.count(F.lit(1)), F.count_if(broken), F.avg("y")).first()
    if faulty:
        raise ValueError(f"{faulty} training rows have no number as target.")
    cuts = _fitted_thresholds(plain, shell.numFeatures, estimator.getMaxBins())
    with _small_batches(spark):
        blocks, groups = _dealt(plain, cuts, mean, count, estimator.getNumTrees())
        nodes = _nodes(blocks, groups, cuts, estimator)
    forget(blocks)
    return _model(spark, nodes, cuts, mean, shell)
