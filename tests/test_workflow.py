import dataclasses
import os

import numpy as np
import pandas as pd
import pytest

from plumbline.operators import models
from plumbline.plans import workflow
from plumbline.schema import ColumnRule, SemanticSchema
from plumbline.sources import fingerprint

QUICK = models.ModelSettings(trees=2, forest_depth=3, stages=2)


@pytest.fixture(scope="module")
def plan():
    schema = SemanticSchema((
        ColumnRule("x", "continuous_numeric", minimum=0.0), ColumnRule("y", "continuous_numeric", minimum=0.0),
        ColumnRule("z", "continuous_numeric", role="target", group="target"),
        ColumnRule("c", "nominal_categorical", storage="string", group="categorical"),
    ))
    return workflow.RunPlan(schema, "key", "x", [0.0, 5.0, float("inf")], ["x", "y", "c"], settings=QUICK)


def rows(spark, first, last):
    rng = np.random.default_rng(first)
    n = last - first
    pdf = pd.DataFrame({"key": np.arange(first, last), "x": rng.uniform(0, 9, n), "y": rng.uniform(0, 9, n),
                        "c": rng.choice(["a", "b"], n)})
    return spark.createDataFrame(pdf.assign(z=pdf["x"] + pdf["y"] + rng.normal(size=n)))


def content(spark, path):
    return fingerprint.dataset_fingerprint(spark.read.parquet(path)).first()


def never(*_):
    raise AssertionError("The table was read.")


def test_second_run_reads_results_only(spark, plan, tmp_path):
    path, store = str(tmp_path / "table"), str(tmp_path / "store")
    rows(spark, 0, 300).write.parquet(path)
    first = workflow.run_kept(spark, path, plan, store)
    again = workflow.run_kept(spark, path, plan, store, read=never)
    assert first.made and not again.made and first.place == again.place
    assert list(first.tables) == list(again.tables) and again.tables["splits"].count() == 300
    assert again.tables["model_comparison"].count() == 3 and again.model().stages

    # More rows are other content, another seed another plan; what was made before is deleted.
    rows(spark, 300, 320).write.mode("append").parquet(path)
    assert workflow.run_address(content(spark, path), plan) != os.path.basename(first.place)
    seeded = workflow.run_kept(spark, path, dataclasses.replace(plan, seed=7), store, train=False)
    assert seeded.made and seeded.tables["splits"].count() == 320
    assert not os.path.exists(first.place) and "model_comparison" not in seeded.tables


def test_broken_run_is_made_again(spark, plan, tmp_path):
    path, store = str(tmp_path / "table"), str(tmp_path / "store")
    rows(spark, 0, 200).write.parquet(path)

    class Lost(Exception):
        pass

    def broken(*_):
        raise Lost

    with pytest.raises(Lost):
        workflow.run_kept(spark, path, plan, store, train=False, read=broken)
    assert workflow.run_kept(spark, path, plan, store, train=False).made
    assert not workflow.run_kept(spark, path, plan, store, train=False, read=never).made
