import hashlib

import pytest
from pyspark.sql import functions as F

from plumbline.operators import split

EDGES = [0.0, 10.0, 20.0, float("inf")]


@pytest.fixture(scope="module")
def table(spark):
    """3,001 rows; the first stratum holds about a third of them and one is tiny."""
    value = F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") == 1, 15.0).otherwise(25.0)
    return spark.range(3001).select(F.col("id").alias("k"), value.alias("v")).repartition(9)


def ranked(rows, seed=42):
    """Splits by a full sort, in plain Python."""
    strata = {}
    for k, v in rows:
        strata.setdefault(1 if v <= 10 else 2 if v <= 20 else 3, []).append(k)
    quotas = split.split_quotas({s: len(ks) for s, ks in strata.items()})
    found = {}
    for s, keys in strata.items():
        keys.sort(key=lambda k: (hashlib.md5(f"{k}#{seed}".encode()).hexdigest(), k))
        train, validation, _ = quotas[s]
        for i, k in enumerate(keys):
            found[k] = "train" if i < train else "validation" if i < train + validation else "test"
    return found


@pytest.mark.parametrize("boundary_rows", [50_000, 5])
def test_split_equals_full_ranking(table, boundary_rows):
    stratum = split.right_closed_bin(F.col("v"), EDGES)
    rule = split.fit_split(table, "k", stratum, boundary_rows=boundary_rows)
    found = {r["k"]: r["split"] for r in rule.apply(table).collect()}
    assert found == ranked([(r["k"], r["v"]) for r in table.collect()])


def test_split_does_not_depend_on_partitions(table):
    one = split.stratified_split(table.repartition(1), "k", "v", EDGES)
    many = split.stratified_split(table.repartition(32), "k", "v", EDGES)
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_cover_and_audit(table):
    rows = split.stratified_split(table, "k", "v", EDGES)
    split.require_cover(table, rows)
    audit = {r["split"]: r["observations"] for r in split.split_audit(rows, by_stratum=False).collect()}
    assert audit == {"train": 2100, "validation": 450, "test": 451}
    with pytest.raises(ValueError):
        split.require_cover(table, rows.where("split = 'train'"))


def test_published_sizes():
    quotas = split.split_quotas({1: 822, 2: 6581, 3: 7236, 4: 3639, 5: 2362})
    assert sum(q[0] for q in quotas.values()) == 14_448
    assert sum(q[1] for q in quotas.values()) == sum(q[2] for q in quotas.values()) == 3_096


def test_assignment_is_a_projection(table):
    rows = split.stratified_split(table, "k", "v", EDGES)
    added = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in added and "Join" not in added


def test_row_outside_the_edges_is_an_error(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 5.0)], "k long, v double")
    with pytest.raises(split.UnassignedStratum):
        split.stratified_split(df, "k", "v", EDGES)
    with pytest.raises(split.UnassignedStratum):
        split.stratum_counts(df, "v", EDGES)


def test_largest_remainder_breaks_ties_by_stratum():
    assert split.largest_remainder({"a": 1, "b": 1, "c": 1}, 2) == {"a": 1, "b": 1, "c": 0}
    assert split.largest_remainder({}, 0) == {}


def test_text_keys(spark):
    df = spark.createDataFrame([(f"row {i}", float(i % 30)) for i in range(200)], "k string, v double")
    rows = split.stratified_split(df, "k", "v", EDGES)
    assert rows.where("split = 'train'").count() == 140


def test_many_strata_use_the_same_cuts(table, monkeypatch):
    stratum = F.col("k") % 7
    rule = split.fit_split(table, "k", stratum)
    by_expression = rule.apply(table)
    monkeypatch.setattr(split, "EXPRESSION_STRATA", 3)
    by_join = rule.apply(table)
    assert by_join.columns == by_expression.columns
    assert by_join.exceptAll(by_expression).isEmpty() and by_expression.exceptAll(by_join).isEmpty()


def test_repeated_and_missing_keys_are_errors(spark):
    base = spark.range(1000).select((F.col("id") % 10).alias("k"), F.lit(5.0).alias("v"))
    with pytest.raises(ValueError, match="unique"):
        split.stratified_split(base, "k", "v", EDGES)
    one = spark.createDataFrame([(1, 5.0), (None, 5.0)], "k long, v double")
    with pytest.raises(ValueError, match="unique"):
        split.stratified_split(one, "k", "v", EDGES)
    # One pair among many rows, in different strata.
    pair = spark.range(3000).select(F.when(F.col("id") == 2999, 0).otherwise(F.col("id")).alias("k"), F.when(F.col("id") == 2999, 25.0).otherwise(5.0).alias("v"))
    with pytest.raises(ValueError, match="unique"):
        split.stratified_split(pair, "k", "v", EDGES)


def test_uniqueness_and_prefixes_share_one_exchange(table):
    rows = table.select(split.right_closed_bin(F.col("v"), EDGES).alias("s"), "k", split.seeded_hash(F.col("k"), 42).alias("h"))
    counted = split._counted(table.sparkSession.createDataFrame(rows.collect(), rows.schema), 4)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert counted.agg(F.sum("count")).first()[0] == 3001 and not counted.where("repeated").count()


def test_different_keys_under_one_hash_are_no_error(table, monkeypatch):
    # Two keys share a hash; the split still covers all rows by its quotas.
    made = split.seeded_hash
    monkeypatch.setattr(split, "seeded_hash", lambda key, seed: made(F.when(key == 7, 8).otherwise(key), seed))
    rows = split.stratified_split(table, "k", "v", EDGES)
    split.require_cover(table, rows)


def test_cover_compares_sizes_with_quotas(table):
    rows = split.stratified_split(table, "k", "v", EDGES)
    moved = rows.withColumn("split", F.when(F.col("k") == 0, "test").when(F.col("k") == 3, "test").otherwise(F.col("split")))
    with pytest.raises(ValueError, match="quotas"):
        split.require_cover(table, moved)


@pytest.mark.parametrize("digits", [1, 2])
def test_short_prefixes_give_the_same_split(table, digits):
    rows = split.stratified_split(table, "k", "v", EDGES, boundary_rows=3, prefix_digits=digits)
    assert {r["k"]: r["split"] for r in rows.collect()} == ranked([(r["k"], r["v"]) for r in table.collect()])


def test_a_row_is_hashed_once(spark, capsys):
    """Each comparison of each stratum made the hash of the row again."""
    df = spark.range(400).select("id", (F.col("id") % 4).cast("double").alias("v"), F.lit(1).alias("_h"))
    made = split.stratified_split(df, "id", "v", [-1.0, 0.5, 1.5, 2.5, 9.0])
    capsys.readouterr()
    made.explain()
    assert capsys.readouterr().out.count("md5(") == 1
    assert made.columns == ["id", "v", "_h", "stratum", "split"]
