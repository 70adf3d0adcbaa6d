"""Binned forests against a plain recursion and Spark's own trees."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from plumbline.operators import binned


def forest(**settings):
    return RandomForestRegressor(featuresCol="features", labelCol="y", featureSubsetStrategy="all", seed=42, **settings)


def table(spark, n=700, seed=0):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 9, n).astype(float), rng.integers(0, 20, n).astype(float)
    y = 1e4 + 30 * a + 5 * (b - 8) ** 2 + rng.normal(size=n)
    pdf = pd.DataFrame({"a": a, "b": b, "same": 2.0, "y": y})
    rows = spark.createDataFrame(pdf).repartition(5)
    return pdf, VectorAssembler(inputCols=["a", "b", "same"], outputCol="features").transform(rows)


def scored(model, rows):
    return {(r["a"], r["b"]): r["prediction"] for r in model.transform(rows).select("a", "b", "prediction").distinct().collect()}


@pytest.mark.parametrize("depth", [0, 1, 4, 30])
def test_one_tree_equals_sparks(spark, monkeypatch, depth):
    _, rows = table(spark)
    one = forest(numTrees=1, bootstrap=False, maxDepth=depth)
    spark.sparkContext.setLogLevel("ERROR")
    for limit, chunk, part in ((1 << 20, 256, 1 << 13), (150, 3, 7)):
        monkeypatch.setattr(binned, "BLOCK_ROWS", limit)
        monkeypatch.setattr(binned, "CHUNK", chunk)
        monkeypatch.setattr(binned, "SLICE", part)
        mine, theirs = binned.fit_forest(one, rows), one.fit(rows)
        assert scored(mine, rows) == pytest.approx(scored(theirs, rows))
        assert list(mine.featureImportances.toArray()) == pytest.approx(list(theirs.featureImportances.toArray()))
        assert mine.totalNumNodes == theirs.totalNumNodes


def test_forest_is_as_good_as_sparks_and_the_same_again(spark, tmp_path):
    pdf, rows = table(spark)
    many = forest(numTrees=30, maxDepth=6)
    mine, theirs = binned.fit_forest(many, rows), many.fit(rows)
    error = [((m.transform(rows).toPandas()["prediction"] - m.transform(rows).toPandas()["y"]) ** 2).mean() for m in (mine, theirs)]
    assert error[0] == pytest.approx(error[1], rel=0.2) and error[0] < 0.02 * pdf["y"].var()
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.02)
    assert mine.getNumTrees == 30 and mine.getMaxDepth() == 6 and len(set(t.numNodes for t in mine.trees)) > 1
    assert scored(binned.fit_forest(many, rows), rows) == scored(mine, rows)
    mine.save(str(tmp_path / "forest"))
    assert scored(type(mine).load(str(tmp_path / "forest")), rows) == scored(mine, rows)


def test_what_is_counted_does_not_grow_with_partitions(spark):
    _, rows = table(spark, 4000)
    cells = rows.select(F.array("a", "b").alias("x"), "y")
    blocks = [binned._dealt(cells.repartition(n), [np.arange(8) + 0.5, np.arange(19) + 0.5], 1e4, 4000, 10)[0] for n in (2, 64)]
    assert [b.count() for b in blocks] == [10, 10]


def test_cuts_of_few_and_of_many_values():
    assert list(binned.thresholds(np.array([3.0, 1.0, 7.0, 1.0]), np.array([1.0, 5.0, 1.0, 5.0]), 4)) == [2.0, 5.0]
    assert len(binned.thresholds(np.array([2.0]), np.array([9.0]), 4)) == 0
    cuts = binned.thresholds(np.arange(1000.0), np.ones(1000), 4)
    assert list(cuts) == pytest.approx([249.5, 499.5, 749.5], abs=1.0)
    hot = binned.thresholds(np.arange(100.0), np.where(np.arange(100) == 50, 1e6, 1.0), 8)
    assert 0 < len(hot) < 8 and sorted(set(hot)) == list(hot)


def test_odd_rows(spark):
    rows = spark.createDataFrame([(0.0, 4.0)], "a double, y double")
    fit = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    assert set(binned.fit_forest(forest(numTrees=9), fit).transform(fit).first()["features"].toArray()) == {0.0}
    assert binned.fit_forest(forest(numTrees=1, bootstrap=False), fit).transform(fit).first()["prediction"] == 4.0
    broken = VectorAssembler(inputCols=["a"], outputCol="features").transform(
        spark.createDataFrame([(0.0, 1.0), (1.0, None)], "a double, y double").orderBy("a")
    )
    with pytest.raises(Exception):
        binned.fit_forest(forest(numTrees=2), broken)


def test_counts_of_blocks_are_added_up_in_the_task():
    """Before, a task sent the counts of each of its blocks."""
    rng = np.random.default_rng(0)
    none = np.full(1, -1, np.int32)
    trees = [binned._Tree(none, none, none, 0)] * 4
    now = binned._Round(0, trees, (4, 2), np.uint8, 42, False)
    blocks, d = [rng.integers(0, 2, (2, 30), dtype=np.uint8) for _ in range(5)], rng.normal(size=30)

    def batches():
        for group in (0, 1):
            for part, x in enumerate(blocks):
                yield pa.record_batch({
                    "part": pa.array([part]), "group": pa.array([group], pa.int32()), "x": pa.array([x.tobytes()], pa.binary()),
                    "d": pa.array([d.tobytes()], pa.binary()),
                })

    class Shared:
        value = now

    sent = pa.Table.from_batches(binned._counter(Shared, 2)(batches()))
    assert sorted(sent.column("tree").to_pylist()) == [0, 1, 2, 3]
    for n in sent.column("n"):
        assert np.frombuffer(n.as_buffer(), np.int64).tolist() == [150]
    whole = np.concatenate(blocks, axis=1)
    for w in sent.column("w"):
        assert np.frombuffer(w.as_buffer(), np.float64).tolist() == [*np.bincount(whole[0], minlength=4), *np.bincount(whole[1], minlength=2)]


def test_blocks_are_written_and_read_a_few_at_a_time(spark, monkeypatch):
    """Up to a hundred blocks were one page of a file, held whole by writer and reader."""
    monkeypatch.setattr(binned, "BLOCK_ROWS", 50)
    monkeypatch.setattr(binned, "BLOCK_FILES", {**binned.BLOCK_FILES, "parquet.block.size": 1000})
    rows = spark.range(2000).select(F.array((F.col("id") % 7).cast("double"), F.col("id").cast("double")).alias("x"), F.col("id").cast("double").alias("y"))
    cuts = binned._fitted_thresholds(rows, 2, 16)
    blocks, _ = binned._dealt(rows, cuts, 0.0, 2000, 1)
    files = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")) for f in blocks.inputFiles()]
    groups = [f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert sum(groups) == blocks.count() >= 40 and max(groups) <= 5
    with binned._small_batches(spark):
        assert spark.conf.get(binned.BATCH_SETTING) == binned.BATCH
    assert spark.conf.get(binned.BATCH_SETTING, binned.BATCH_DEFAULT) == binned.BATCH_DEFAULT
