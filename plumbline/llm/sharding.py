"""Sharding along a Hilbert curve over metadata, in DataFrame operations only.

Several metadata dimensions are quantised to 2^BITS steps each, the point of a row is
turned into its index on the Hilbert curve (Skilling's transform, folded with a higher-order
function), rows are ordered by the index, and the order is cut into runs of equal row counts.
Neighbours on the curve are near in every dimension, so a filter on any of them, or on
several, meets few shards.

Law `rows`: shard counts differ by one row at most. The exact position of a row in the order
comes without a global sort: cells of the curve are counted, a cell with many rows is cut
into parts by a hash of the row, the parts are counted too, and rows are numbered inside
their part. A source that holds a third of the rows is many parts. Only narrow rows are
shuffled (key, size, checksum), never texts.

Cases: NULL metadata is the lowest step of its dimension, a NULL text has size 1. NULL keys
and repeated rows are rows like others; rows alike in all that is ordered by may swap places.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import durable

#: Bits of each dimension; three dimensions make 2^(3 * BITS) cells at most.
BITS = 4
#: Least rows of a part of a cell, and the number of parts that a larger table is cut into about.
PART_ROWS, PARTS = 256, 1 << 16


def steps_of_size(size: Column, bits: int = BITS) -> Column:
    """A size on a logarithmic scale: two steps a doubling from 16 on."""
    step = F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * 2) - 8
    return F.least(F.greatest(step, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")


def steps_of_label(label: Column, bits: int = BITS) -> Column:
    """A label by its hash; NULL is step 0."""
    return F.when(label.isNull(), 0).otherwise(F.pmod(F.xxhash64(label), F.lit(1 << bits))).cast("int")


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a point with len(axes) coordinates of `bits` bits."""
    n = len(axes)
    point = F.array(*axes)
    masks = [1 << b for b in range(bits - 1, 0, -1)]

    def turned(x: Column, step: Column) -> Column:
        # Undo one rotation: exchange or invert the low bits of coordinate 0 and coordinate i.
        mask, i = step["mask"], step["axis"]
        low, first, own = mask - 1, F.get(x, F.lit(0)), F.get(x, step["axis"])
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        invert = own.bitwiseAND(mask) != 0
        new_first = F.when(invert, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))
        new_own = F.when(invert, own).otherwise(own.bitwiseXOR(swap))
        return F.transform(x, lambda v, k: F.when(k == 0, new_first).when(k == i, new_own).otherwise(v))

    steps = F.array(
        *[F.struct(F.lit(m).alias("mask"), F.lit(i).alias("axis")) for m in masks for i in range(n)]
    )
    turned_point = F.aggregate(steps, point, turned)

    def interleaved(x: Column) -> Column:
        # Gray code: coordinates are chained, then the last one tells which low bits to flip.
        gray = [reduce(lambda a, b: a.bitwiseXOR(b), [F.get(x, F.lit(j)) for j in range(i + 1)]) for i in range(n)]
        flip = reduce(
            lambda a, b: a.bitwiseXOR(b),
            [F.when(gray[-1].bitwiseAND(F.lit(m)) != 0, F.lit(m - 1)).otherwise(F.lit(0)) for m in masks],
        )
        done = [g.bitwiseXOR(flip) for g in gray]
        bit = lambda i, b: F.shiftleft(F.shiftright(done[i], b).bitwiseAND(F.lit(1)), b * n + (n - 1 - i))
        return reduce(lambda a, b: a.bitwiseOR(b), [bit(i, b) for b in range(bits) for i in range(n)])

    # A one-element array binds the turned point, so that it is computed once per row.
    return F.get(F.transform(F.array(turned_point), interleaved), F.lit(0)).cast("int")


def curve_shards(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    labels: tuple[str, ...] = ("lang", "source"),
) -> DataFrame:
    """Per row: key, size, text_crc32, curve (Hilbert index), shard, slot (place in the shard, from 0)."""
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")
    axes = [steps_of_size(F.col("size")), *[steps_of_label(F.col(f"_label{i}")) for i in range(len(labels))]]
    held = [F.col(name).cast("string").alias(f"_label{i}") for i, name in enumerate(labels)]
    rows = docs.select(F.col(id_col).alias("_key"), size.alias("size"), crc.alias("text_crc32"), *held)
    rows = durable(
        rows.withColumn("curve", hilbert_index(axes))
        .withColumn("_order", F.xxhash64("_key", "text_crc32", "size"))
        .select("_key", "size", "text_crc32", "curve", "_order")
    )
    # Cells: at most 2^(BITS * dimensions), whatever the number of rows.
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("curve").agg(F.count(F.lit(1)).alias("_rows"))
    cells = cells.withColumns(
        {
            "_start": F.coalesce(F.sum("_rows").over(before.orderBy("curve")), F.lit(0)),
            "_total": F.sum("_rows").over(Window.partitionBy()),
        }
    )
    part_rows = F.greatest(F.lit(PART_ROWS), F.col("_total") / PARTS)
    cells = cells.withColumn("_parts", F.ceil(F.col("_rows") / part_rows).cast("long"))
    placed = rows.join(F.broadcast(durable(cells.drop("_rows"))), "curve")
    # Parts are ranges of the hash, so that their order is the order of the hash.
    high = F.shiftrightunsigned("_order", 33)
    placed = placed.withColumn("_part", F.shiftright(high * F.col("_parts"), 31))
    parts = placed.groupBy("curve", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    parts = parts.select(
        "curve",
        "_part",
        F.coalesce(F.sum("_rows").over(before.partitionBy("curve").orderBy("_part")), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("curve", "_part").orderBy(
        F.shiftrightunsigned("_order", 1), "_order", "_key", "text_crc32"
    )
    numbered = placed.withColumn("_place", F.row_number().over(inside) - 1).join(parts, ["curve", "_part"])
    numbered = numbered.withColumn("_rank", F.col("_start") + F.col("_before") + F.col("_place"))
    numbered = numbered.withColumn("shard", F.expr(f"_rank * {shards} div _total").cast("int"))
    # The first rank of shard s is the smallest r with r * shards >= s * total.
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    slot = (F.col("_rank") - first).cast("long").alias("slot")
    return numbered.select(F.col("_key").alias(id_col), "size", "text_crc32", "curve", "shard", slot)
