"""What the operators of this package share: scans, salted joins and scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.durable import durable, forget

__all__ = ["bounded_batches", "durable", "forget", "hot_join", "looked_up", "running", "small", "table", "tasks_for", "unused"]

#: Parts into which the rows of one join key are dealt; the small side is repeated as often.
SALTS = 16
#: Rows of a few numbers that may be broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


#: Bytes of the Arrow batches in which texts reach Python, and Spark's default, which is replaced.
BATCH_SETTING, BATCH, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "8m", "67108864b"


def bounded_batches(docs: DataFrame) -> DataFrame:
    """The same rows; they will reach Python in batches of a few megabytes, unless the session says otherwise.

    A batch is held by the executor and its worker in several copies, two tasks at a time.
    """
    session = docs.sparkSession
    if session.conf.get(BATCH_SETTING, BATCH_DEFAULT) == BATCH_DEFAULT:
        session.conf.set(BATCH_SETTING, BATCH)
    return docs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many more underscores in front as no column of `taken` has."""
    held, found = {name.lower() for name in taken}, []
    for name in names:
        while name.lower() in held:
            name = f"_{name}"
        found.append(name)
    return found


def salt(*row_columns: Column, salts: int = SALTS) -> Column:
    """A part number from what tells the rows of one key apart."""
    return F.pmod(F.xxhash64(*row_columns), F.lit(salts)).cast("int")


def hot_join(
    rows: DataFrame, keyed: DataFrame, keys: list[str], by: list[Column], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join many rows with at most one row per key where a few keys hold much of the rows.

    The rows of a key are dealt into `salts` parts by the columns of `by`; `keyed` has one
    row per key and is repeated for each part. Keys must not be NULL. Both sides are shuffled
    at every size, since the repeated rows are no good to broadcast.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    (part,) = unused([*rows.columns, *keyed.columns], "_salt")
    left = rows.withColumn(part, salt(*by, salts=salts))
    return left.join(keyed.withColumn(part, parts).hint("merge"), [*keys, part], how).drop(part)


def small(keys: DataFrame) -> DataFrame:
    """A table of keys (a few numbers a row), marked for broadcast if its counted rows are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys.hint("merge")


def tasks_for(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running(rows: DataFrame, order: list[str], sums: dict[str, str], within: tuple[str, ...] = ()) -> DataFrame:
    """The rows with the sums, along an order, of what stands before them (inside each key of `within`).

    Rows are cut into ranges of (key, order), so that a key with most rows is many ranges; only
    the totals of ranges meet in one window. The order must tell rows apart.
    """
    keys = list(within)
    cut = durable(rows.repartitionByRange(tasks_for(rows), *keys, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_range").agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    earlier = before.partitionBy(*keys).orderBy("_range")
    offsets = totals.select(
        *keys, "_range", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_{name}") for name in sums]
    )
    inside = before.partitionBy(*keys, "_range").orderBy(*order)
    found = cut.join(offsets, [*keys, "_range"])
    for name, value in sums.items():
        found = found.withColumn(name, F.col(f"_{name}") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return found.drop("_range", *[f"_{name}" for name in sums])


def looked_up(rows: DataFrame, keyed: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    """Each row with what its key has in a small table; dealt over parts where that is not small."""
    if keyed.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keyed), keys)
    return hot_join(rows, keyed, keys, by)
