"""The order table against plain sums of awkward lines."""

from catalog import bindings


def test_order_table_counts_parts_and_suppliers_without_sets(spark, tmp_path, capsys):
    lines = [
        (1, 7, 1, 2.0, 10.005), (1, 7, 2, 3.0, 0.1), (1, 8, 2, None, 0.2), (2, None, 5, 1.0, None), (2, None, None, 1.0, None),
        (3, 9, 9, 1.0, 9999999999999.99), (3, 9, 9, 1.0, 0.01), (3, 9, 9, 1.0, -0.02), (None, 1, 1, 1.0, 1.0), (77, 1, 1, 1.0, 1.0),
        (5, 4, 4, 1.0, -3.33), (5, 4, 4, 1.0, 1.11),
    ]
    made = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double"),
        "orders": ([(1, 1), (2, 1), (2, 2), (3, None), (4, 3), (5, 1), (None, 1)], "o_orderkey long, o_custkey long"),
        "customer": ([(1, 5.0, "A"), (2, None, None)], "c_custkey long, c_acctbal double, c_mktsegment string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    block = bindings.joined_block(spark, str(tmp_path))
    found = sorted([tuple(r) for r in block.collect()], key=str)
    assert found == sorted([
        (1, 5.0, 2, 2, 3, 5.0, 10.31, "A"), (2, 2.0, 0, 1, 2, 5.0, None, "A"), (2, 2.0, 0, 1, 2, None, None, None),
        (3, 3.0, 1, 1, 3, None, 9999999999999.98, None), (4, None, 0, 0, 0, None, None, None),
        (5, 2.0, 1, 1, 2, 5.0, -2.22, "A"), (None, None, 0, 0, 0, 5.0, None, "A"),
    ], key=str)
    capsys.readouterr()
    block.explain()
    plan = capsys.readouterr().out
    # Sets are objects, which Spark sorts by order a second time.
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan
    assert plan.split("Initial Plan")[-1].count("REPARTITION_BY_COL") == 1
