"""Bindings of the operators to the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.durable import durable
from plumbline.operators.governance import DISTANCE, GROUPING, Interaction, planned
from plumbline.schema import ColumnRule, CrossRule, Ratio, SemanticSchema, quoted
from plumbline.sources.tables import read_parquet

KEY = "block_id"
TARGET = "gross_value"
STRATUM = "cust_balance"
EDGES = (-1000.0, 1000.0, 3000.0, 5000.0, 7000.0, float("inf"))
NUMBERS = ["total_qty", "part_count", "supp_count", "line_count", "cust_balance"]
CATEGORY = "segment"
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SEED = 42

RATIOS = (
    Ratio("qty_per_line", "total_qty", "line_count", "Average quantity per order line."),
    Ratio("parts_per_line", "part_count", "line_count", "Distinct parts per order line."),
    Ratio("qty_per_part", "total_qty", "part_count", "Average quantity per distinct part."),
)
INTERACTIONS = (
    Interaction("qty_line_interaction", ("total_qty", "line_count"), "total_qty × line_count",
                "Order size and length may act together."),
    Interaction("balance_segment_interaction", ("cust_balance", "segment"), "cust_balance × indicators of segment",
                "Balance may count differently by segment."),
)
DOMAIN = (
    planned(GROUPING, "segment_group", ("segment",), "approved mapping of segments to groups",
            "Coarser market segment.", "No grouping is approved yet."),
    planned(DISTANCE, "distance_to_warehouse", ("external_warehouse_coordinates",),
            "shortest great-circle distance to the given warehouses", "How far an order travels.",
            "Orders carry no location."),
)
SELECTED = ["total_qty", "part_count", "supp_count", "line_count", "cust_balance", "segment", "qty_per_line"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Doubles are compared on a grid of 2^-GRID_BITS. Cents and their means lie on a decimal grid, so
#: unlike decimal places it has no half-way cases on which two ways of adding could disagree.
GRID_BITS = 20


def shown(df: DataFrame) -> DataFrame:
    """Doubles rounded to the grid for comparison with SQL; -0.0 becomes 0.0."""
    grid = F.lit(float(1 << GRID_BITS))
    return df.select(
        *[
            (F.round(quoted(f.name) * grid) / grid + F.lit(0.0)).alias(f.name)
            if f.dataType.simpleString() == "double" else quoted(f.name)
            for f in df.schema.fields
        ]
    )


BILLION = 1_000_000_000

_LANDED: dict[tuple[str, str, str], DataFrame] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, made: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries start from, written once per session."""
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _LANDED:
        _LANDED[place] = durable(made())
    return _LANDED[place]


def order_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table, landed once: most operators read it several times."""
    return landed(spark, sf_dir, "orders", lambda: joined_block(spark, sf_dir))


def joined_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the primary fixture.

    Lines are aggregated by order before the join, so the joins see one row per order;
    the customer side is broadcast by the planner when its measured size allows.
    """
    # Lines are dealt by order once. A part of an order, and a supplier, becomes one group inside its
    # task: sets would be kept as objects and sorted, and distinct counts would be dealt anew.
    dealt = table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL").select(
        "l_orderkey", "l_quantity", "l_partkey", "l_suppkey",
        # Added as cents: a sum of doubles depends on the order of its parts, and operators that
        # read the table twice must see the same values both times.
        (F.round("l_extendedprice", 2).cast("decimal(18,2)") * F.lit(100)).cast("long").alias("cents"),
    ).repartition("l_orderkey")
    named = dealt.select(
        "l_orderkey", "l_quantity", "cents",
        F.inline(F.array(
            F.struct(F.lit(True).alias("part"), F.col("l_partkey").alias("named")),
            F.struct(F.lit(False).alias("part"), F.col("l_suppkey").alias("named")),
        )),
    )
    # Each line counts with its part; with its supplier it only names the supplier.
    of_part, some = F.col("part"), F.col("named").isNotNull()
    once = named.groupBy("l_orderkey", "part", "named").agg(
        F.sum(F.when(of_part, F.col("l_quantity"))).alias("qty"),
        # Two whole numbers that no sum of lines overflows: decimals of this width are added as objects.
        F.sum(F.when(of_part, F.expr(f"cents div {BILLION}"))).alias("high"),
        F.sum(F.when(of_part, F.col("cents") % BILLION)).alias("low"),
        F.count_if(of_part).alias("lines"),
    )
    lines = once.groupBy("l_orderkey").agg(
        F.sum("qty").alias("total_qty"),
        F.count_if(of_part & some).alias("part_count"),
        F.count_if(~of_part & some).alias("supp_count"),
        F.sum("lines").alias("line_count"),
        F.sum("high").cast("decimal(20,0)").alias("high"),
        F.sum("low").cast("decimal(20,0)").alias("low"),
    )
    cents = F.col("high") * F.lit(BILLION) + F.col("low")
    lines = lines.withColumn("gross_value", (cents.cast("decimal(34,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("double"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        customers, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    return joined.select(
        F.col("o_orderkey").alias("block_id"),
        "total_qty",
        F.coalesce("part_count", F.lit(0)).alias("part_count"),
        F.coalesce("supp_count", F.lit(0)).alias("supp_count"),
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
        F.col("c_acctbal").alias("cust_balance"),
        "gross_value",
        F.col("c_mktsegment").alias("segment"),
    )


def faulty_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order rows with injected faults, plus a second copy of every 50th row.

    Nothing is left out: the remainders only choose which rows get which fault.
    """
    base = order_block(spark, sf_dir)
    k = F.col(KEY)
    spoiled = base.withColumns(
        {
            "cust_balance": F.when(k % 97 != 0, F.col("cust_balance")),
            "part_count": F.col("part_count") + F.when(k % 101 == 0, 0.4).otherwise(0.0),
            "segment": F.when(k % 89 == 0, "???").when(k % 83 != 0, F.col("segment")),
        }
    )
    copies = F.when(k % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return spoiled.withColumn("_copy", F.explode(copies)).drop("_copy")


def untidy_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as they might arrive as text: padded categories, words among numbers."""
    base = faulty_block(spark, sf_dir)
    quantity = F.col("total_qty").cast("string")
    return base.withColumns(
        {
            "total_qty": F.when(F.col(KEY) % 97 == 0, "n/a").otherwise(quantity),
            "segment": F.concat(F.lit("  "), F.col("segment"), F.lit(" ")),
            "remark": F.lit("free text"),
        }
    )


def strained_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows on which every challenge shows: a curved, skewed response, gaps, spikes and a place."""
    k, balance = F.col(KEY), F.col("cust_balance")
    return order_block(spark, sf_dir).select(
        KEY,
        F.when(k % 97 != 0, F.col("total_qty")).alias("total_qty"),
        "line_count",
        "part_count",
        "cust_balance",
        F.when(k % 14 == 0, 1000.0 + k % 7).otherwise((k % 7).cast("double")).alias("spiked"),
        (F.pmod(k, F.lit(180)) - 90.0).alias("latitude"),
        (F.pmod(k * 7, F.lit(360)) - 180.0).alias("longitude"),
        F.pow((balance - 4500.0) / 1000.0, F.lit(4.0)).alias("strained_value"),
    )


def block_schema(allowed: bool = True) -> SemanticSchema:
    """Declared meaning of the order table (without its key)."""
    counted = {"semantic_type": "count", "minimum": 0.0, "whole_number": True}
    return SemanticSchema(
        (
            ColumnRule("total_qty", nullable=True, missing_treatment="median_imputation_after_split", **counted),
            ColumnRule("part_count", **counted),
            ColumnRule("supp_count", **counted),
            ColumnRule("line_count", **counted),
            ColumnRule("cust_balance", "continuous_numeric", minimum=0.0),
            ColumnRule(TARGET, "continuous_numeric", role="target", nullable=True, minimum=0.0, group="target"),
            ColumnRule(
                "segment", "nominal_categorical", storage="string", group="categorical",
                allowed_values=SEGMENTS if allowed else None,
            ),
        ),
        (
            CrossRule("suppliers_above_parts", "supp_count > part_count",
                      "Suppliers should not normally exceed parts.", ("supp_count", "part_count")),
            CrossRule("lines_above_parts", "line_count > part_count",
                      "A part should not normally repeat in an order.", ("line_count", "part_count")),
            CrossRule("parts_above_lines", "part_count > line_count",
                      "Parts cannot exceed lines.", ("part_count", "line_count")),
            CrossRule("lines_above_quantity", "line_count > total_qty",
                      "Lines should not normally exceed quantity.", ("line_count", "total_qty")),
        ),
    )
