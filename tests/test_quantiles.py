import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions.quantiles import fit_quantiles, grouped_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.993, 1.0]


def test_even_count_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], ["x"])
    assert fit_quantiles(df, ["x"], [0.5])["x"] == [2.5]


def test_all_null_column_gives_none(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    assert fit_quantiles(df, ["x", "y"], [0.5]) == {"x": [1.5], "y": [None]}


@pytest.fixture(scope="module")
def uneven(spark):
    """A hot value on a third of the rows, a long tail, and a hot group."""
    rng = np.random.default_rng(7)
    n = 60_000
    tail = np.exp(rng.normal(size=n) * 4)
    value = np.where(rng.random(n) < 0.34, 1.0, tail)
    group = np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdefgh"), n))
    pdf = pd.DataFrame({"g": group, "v": value})
    pdf.loc[pdf.index % 10 == 3, "g"] = None
    return pdf, spark.createDataFrame(pdf).repartition(7)


@pytest.mark.parametrize("bounded", [2_000, 20_000, 10**6])
def test_narrowing_equals_numpy_on_skewed_values(uneven, bounded):
    pdf, df = uneven
    found = fit_quantiles(df, ["v"], PROBS, bounded=bounded)["v"]
    assert found == pytest.approx(list(np.quantile(pdf["v"], PROBS)), rel=1e-12)


def test_hot_and_null_groups_are_exact(uneven):
    pdf, df = uneven
    found = {
        row["g"]: row["quantiles"]
        for row in grouped_quantiles(df, ["g"], F.col("v"), PROBS, bounded=5_000).collect()
    }
    pdf = pdf.assign(g=pdf["g"].astype(object).where(pdf["g"].notna(), "<none>"))
    for group, part in pdf.groupby("g"):
        key = None if group == "<none>" else group
        assert found[key] == pytest.approx(list(np.quantile(part["v"], PROBS)), rel=1e-12)
    assert len(found) == pdf["g"].nunique()


def test_constant_large_group(spark):
    df = spark.range(30_000).select(F.lit(4.5).alias("v"))
    assert fit_quantiles(df, ["v"], [0.1, 0.9], bounded=2_000)["v"] == [4.5, 4.5]


def test_many_large_groups_without_broadcast(uneven, monkeypatch):
    from plumbline.functions import quantiles

    pdf, df = uneven
    monkeypatch.setattr(quantiles, "BROADCAST_BYTES", 0)
    rows = grouped_quantiles(df, ["g"], F.col("v"), [0.5], bounded=5_000).collect()
    found = {row["g"]: row["quantiles"][0] for row in rows}
    assert found["hot"] == pytest.approx(np.median(pdf.loc[pdf["g"] == "hot", "v"]), rel=1e-12)


def test_intervals_are_cut_by_exact_counts(uneven):
    """A bound below the interval size forces further cuts on the counted values."""
    pdf, df = uneven
    found = fit_quantiles(df, ["v"], PROBS, bounded=60)["v"]
    assert found == pytest.approx(list(np.quantile(pdf["v"], PROBS)), rel=1e-12)


def test_misleading_sample_is_noticed(uneven, monkeypatch):
    """With a tiny sample the first intervals miss their ranks and are widened."""
    from plumbline.functions import quantiles

    pdf, df = uneven
    monkeypatch.setattr(quantiles, "SAMPLE_ROWS", 40)
    monkeypatch.setattr(quantiles, "SAMPLE_MARGIN", 1)
    found = fit_quantiles(df, ["v"], [0.25, 0.5, 0.9], bounded=5_000)["v"]
    assert found == pytest.approx(list(np.quantile(pdf["v"], [0.25, 0.5, 0.9])), rel=1e-12)


def test_many_ranks_of_whole_columns_are_counted_at_once(spark, monkeypatch):
    """No slot per rank is carried by each row: that cost grew with ranks times rows."""
    from plumbline.functions import quantiles

    def slots(*_):
        raise AssertionError("rows were grouped by one code for each rank")

    monkeypatch.setattr(quantiles, "_next_intervals", slots)
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"wide": rng.normal(size=5_000), "steps": rng.integers(0, 4, 5_000).astype(float), "few": np.nan})
    pdf.loc[:99, "wide"] = np.nan
    pdf.loc[pdf.index % 3 == 0, "steps"] = -0.0
    pdf.loc[:9, "few"] = np.arange(10.0)
    probs = [j / 100 for j in range(101)]
    found = fit_quantiles(spark.createDataFrame(pdf).repartition(3), list(pdf), probs, bounded=500)
    for name in pdf:
        assert found[name] == pytest.approx(list(np.quantile(pdf[name].dropna(), probs)), rel=1e-12, abs=1e-15)


def test_counted_quantiles_of_values_made_by_a_task(spark):
    """Values that only a task can make are ranked without being written as rows."""
    from plumbline.functions.quantiles import counted_quantiles

    a = np.random.default_rng(4).normal(size=4_000)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": np.arange(4_000.0)})).repartition(3)
    inputs = [{"a": F.col("a"), "b": F.col("b")}, {"b": F.col("b")}]

    def read(batch, i):
        b = batch.column("b").to_numpy()
        return np.abs(batch.column("a").to_numpy() - b) if i == 0 else b[b < 0]

    for bounded in (1_000_000, 50):
        found = counted_quantiles(df, inputs, [4_000, 4_000], [0.0, 0.5, 1.0], bounded, read)
        assert found[1] is None
        assert found[0] == pytest.approx(list(np.quantile(np.abs(a - np.arange(4_000.0)), [0, 0.5, 1])), rel=1e-12)
