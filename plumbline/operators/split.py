"""Exact, reproducible stratified train / validation / test split.

Rows are ordered inside their stratum by a seeded hash of their key, and each split
takes its exact quota of that order. The order is never built: the hash value at each
quota is found by counting hash prefixes, and the split of a row then follows from
its own hash and key alone. Assigning splits is therefore a projection without any
shuffle, and gives the same answer for any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.durable import durable, forget
from plumbline.functions.expressions import percentage, right_closed_bin, seeded_hash
from plumbline.schema import quoted

TRAIN, VALIDATION, TEST = "train", "validation", "test"
PREFIX_DIGITS = 4
BOUNDARY_ROWS = 50_000
MAX_STRATA = 10_000
EXPRESSION_STRATA = 50
HASH_DIGITS = 32


class UnassignedStratum(ValueError):
    """Some rows fall into no stratum."""


def stratum_bins(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """The table with its ``stratum``; no row may stay without one."""
    return df.withColumn("stratum", right_closed_bin(quoted(column), edges))


def stratum_counts(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Rows per stratum and their share; fails when a row falls outside the edges."""
    counts = _sizes(stratum_bins(df, column, edges), F.col("stratum"))
    total = sum(counts.values())
    rows = [(k, v, 100.0 * v / total) for k, v in sorted(counts.items())]
    return df.sparkSession.createDataFrame(rows, "stratum int, observations long, percentage double")


def _sizes(df: DataFrame, stratum: Column) -> dict:
    return _stratum_sizes(df.groupBy(stratum.alias("s")).count())


def _stratum_sizes(counts: DataFrame) -> dict:
    found = counts.limit(MAX_STRATA + 1).collect()
    if len(found) > MAX_STRATA:
        raise ValueError(f"More than {MAX_STRATA} strata; stratify by a coarser column.")
    sizes = {row["s"]: row["count"] for row in found}
    if None in sizes:
        raise UnassignedStratum(f"{sizes[None]} rows could not be assigned to a stratum.")
    return sizes


def largest_remainder(sizes: Mapping, wanted: int) -> dict:
    """Split ``wanted`` over the groups in proportion to their sizes, exactly."""
    total = sum(sizes.values())
    if total == 0:
        return {k: 0 for k in sizes}
    exact = {k: Fraction(v * wanted, total) for k, v in sizes.items()}
    quota = {k: math.floor(share) for k, share in exact.items()}
    by_remainder = sorted(sizes, key=lambda k: (-(exact[k] - quota[k]), k))
    for k in by_remainder[: wanted - sum(quota.values())]:
        quota[k] += 1
    return quota


def split_quotas(sizes: Mapping, held_out: float = 0.30, test_share: float = 0.50) -> dict:
    """``(train, validation, test)`` rows per stratum, in two stages like the split itself."""
    total = sum(sizes.values())
    held = largest_remainder(sizes, _ceil_share(total, held_out))
    test = largest_remainder(held, _ceil_share(sum(held.values()), test_share))
    return {k: (sizes[k] - held[k], held[k] - test[k], test[k]) for k in sizes}


def _ceil_share(total: int, share: float) -> int:
    return math.ceil(Fraction(str(share)) * total)


@dataclass(frozen=True)
class SplitRule:
    """A learned split: per stratum the (hash, key) of the last train and validation row."""

    row_key: str
    stratum: Column
    seed: int
    cuts: tuple[tuple[object, tuple | None, tuple | None], ...]

    def column(self, hashed: Column | None = None) -> Column:
        """``train``, ``validation`` or ``test`` from the row's own hash, which a caller may have at hand, and key."""
        k = quoted(self.row_key)
        h = seeded_hash(k, self.seed) if hashed is None else hashed
        chain = None
        for value, last_train, last_validation in self.cuts:
            inner = F.lit(TEST)
            for name, last in ((VALIDATION, last_validation), (TRAIN, last_train)):
                if last is not None:
                    upto = (h < F.lit(last[0])) | ((h == F.lit(last[0])) & (k <= F.lit(last[1])))
                    inner = F.when(upto, F.lit(name)).otherwise(inner)
            condition = self.stratum == F.lit(value)
            chain = F.when(condition, inner) if chain is None else chain.when(condition, inner)
        return chain

    def apply(self, df: DataFrame) -> DataFrame:
        """Add ``split``: an expression for a few strata, a broadcast of the cuts for many."""
        if len(self.cuts) <= EXPRESSION_STRATA:
            # A column of its own: each comparison would make the hash again.
            hashed = df.withColumn("_split_hash", seeded_hash(quoted(self.row_key), self.seed))
            return hashed.withColumn("split", self.column(F.col("_split_hash"))).drop("_split_hash")
        kind, key = df.select(self.stratum.alias("s")).dtypes[0][1], dict(df.dtypes)[self.row_key]
        rows = [(s, *(t or (None, None)), *(v or (None, None))) for s, t, v in self.cuts]
        cuts = df.sparkSession.createDataFrame(
            rows, f"_s {kind}, _th string, _tk {key}, _vh string, _vk {key}"
        )
        h, k = F.col("_h"), quoted(self.row_key)

        def upto(last_h: str, last_k: str) -> Column:
            return (h < F.col(last_h)) | ((h == F.col(last_h)) & (k <= F.col(last_k)))

        place = F.when(upto("_th", "_tk"), TRAIN).when(upto("_vh", "_vk"), VALIDATION).otherwise(TEST)
        # At most MAX_STRATA short rows.
        joined = df.withColumn("_h", seeded_hash(k, self.seed)).join(
            F.broadcast(cuts), self.stratum == F.col("_s"), "left"
        )
        return joined.withColumn("split", F.when(F.col("_s").isNotNull(), place)).drop(
            "_h", "_s", "_th", "_tk", "_vh", "_vk"
        )


def fit_split(
    df: DataFrame,
    row_key: str,
    stratum: Column,
    held_out: float = 0.30,
    test_share: float = 0.50,
    seed: int = 42,
    boundary_rows: int = BOUNDARY_ROWS,
    prefix_digits: int = PREFIX_DIGITS,
) -> SplitRule:
    """Find the hash and key at each quota boundary.

    ``row_key`` must be unique and not NULL. The first scan finds repeated keys and counts hash
    prefixes per stratum by one exchange of hashes; from the counts sizes, quotas and the prefix of each boundary follow; a prefix of four digits
    holds about 1 row in 65,536. Further scans lengthen prefixes that hold more than
    ``boundary_rows`` rows; a last one ranks the rows of the boundary prefixes.
    """
    rows = df.select(
        stratum.alias("s"), quoted(row_key).alias("k"), seeded_hash(quoted(row_key), seed).alias("h")
    )
    counted = _unique_counts(rows, row_key, prefix_digits).select("s", "p", "count")
    sizes = _stratum_sizes(counted.groupBy("s").agg(F.sum("count").alias("count")))
    # Wanted 1-based ranks per stratum: end of train, end of validation.
    wanted = []
    for s, (train, validation, _) in split_quotas(sizes, held_out, test_share).items():
        wanted += [(s, slot, "", rank, sizes[s]) for slot, rank in ((0, train), (1, train + validation)) if rank > 0]
    open_cuts = []
    if wanted:
        # Two cuts per stratum: a short table.
        cuts = F.broadcast(_cut_frame(rows, wanted)).select("cs", "slot", "wanted")
        open_cuts = _chosen(counted.join(cuts, F.col("s") == F.col("cs")).drop("cs"))
    found: dict[tuple, tuple] = {}
    while open_cuts:
        ready = [c for c in open_cuts if c[4] <= boundary_rows or len(c[2]) >= HASH_DIGITS]
        found.update(_ranked(rows, ready))
        wide = [c for c in open_cuts if c not in ready]
        open_cuts = _descend(rows, wide, prefix_digits) if wide else []
    forget(counted)
    return SplitRule(
        row_key,
        stratum,
        seed,
        tuple((s, found.get((s, 0)), found.get((s, 1))) for s in sorted(sizes)),
    )


def _counted(rows: DataFrame, digits: int) -> DataFrame:
    """``s, p, count, repeated``: rows per stratum and hash prefix, and whether a whole hash repeats among them.

    One exchange serves both: (hash, stratum) pairs are dealt by prefix, so a hash meets its
    copies and a prefix its count in the same task. A missing key has no hash and counts as repeated.
    """
    dealt = rows.select("s", F.substring("h", 1, digits).alias("p"), F.unhex("h").alias("b")).repartition("p")
    once = dealt.groupBy("p", "b").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("s"))
    suspect = (F.col("n") > 1) | F.col("b").isNull()
    return once.groupBy("s", "p").agg(F.sum("n").alias("count"), F.max(suspect).alias("repeated"))


def _unique_counts(rows: DataFrame, row_key: str, digits: int) -> DataFrame:
    """The counted prefixes, written; a repeated or missing key would change the quotas and is an error."""
    counted = durable(_counted(rows, digits))
    if counted.where("repeated").isEmpty():
        return counted
    if not rows.groupBy("k").count().where("k IS NULL OR count > 1").isEmpty():
        forget(counted)
        raise ValueError(f"The row key {row_key} must be unique and not NULL.")
    # Different keys under one hash, next to impossible: each row counts in its own stratum.
    forget(counted)
    return durable(rows.groupBy("s", F.substring("h", 1, digits).alias("p")).count())


def _cut_frame(rows: DataFrame, cuts: list[tuple]) -> DataFrame:
    """The open cuts as a table: two per stratum, so it is safe to broadcast."""
    kind = rows.schema["s"].dataType.simpleString()
    return rows.sparkSession.createDataFrame(
        cuts, f"cs {kind}, slot int, prefix string, wanted long, candidates long"
    )


def _candidates(rows: DataFrame, cuts: list[tuple]) -> DataFrame:
    frame = F.broadcast(_cut_frame(rows, cuts))
    return rows.join(frame, (F.col("s") == F.col("cs")) & F.startswith("h", F.col("prefix"))).drop("cs")


def _descend(rows: DataFrame, cuts: list[tuple], digits: int = PREFIX_DIGITS) -> list[tuple]:
    """Extend the prefix of each cut by the digits that hold its rank."""
    longer = F.expr(f"substring(h, 1, length(prefix) + {digits})")
    return _chosen(_candidates(rows, cuts).groupBy("s", "slot", "wanted", longer.alias("p")).count())


def _chosen(counted: DataFrame) -> list[tuple]:
    """Of the counted prefixes of each cut (at most 65,536) the one that holds its rank."""
    order = Window.partitionBy("s", "slot").orderBy("p")
    running = counted.withColumn("upto", F.sum("count").over(order))
    chosen = running.where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("count") < F.col("wanted")))
    return [
        (r["s"], r["slot"], r["p"], r["wanted"] - (r["upto"] - r["count"]), r["count"])
        for r in chosen.collect()
    ]


def _ranked(rows: DataFrame, cuts: list[tuple]) -> dict[tuple, tuple]:
    """The row at the wanted rank among the few candidates of each cut."""
    if not cuts:
        return {}
    order = Window.partitionBy("s", "slot").orderBy("h", "k")
    placed = _candidates(rows, cuts).withColumn("place", F.row_number().over(order))
    return {
        (r["s"], r["slot"]): (r["h"], r["k"])
        for r in placed.where(F.col("place") == F.col("wanted")).collect()
    }


def stratified_split(
    df: DataFrame,
    row_key: str,
    column: str,
    edges: Sequence[float],
    held_out: float = 0.30,
    test_share: float = 0.50,
    seed: int = 42,
    boundary_rows: int = BOUNDARY_ROWS,
    prefix_digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """The table with ``stratum`` and ``split`` columns."""
    stratum = right_closed_bin(quoted(column), edges)
    rule = fit_split(df, row_key, stratum, held_out, test_share, seed, boundary_rows, prefix_digits)
    return rule.apply(df.withColumn("stratum", stratum))


def split_audit(split: DataFrame, by_stratum: bool = True) -> DataFrame:
    """Rows and shares per split, and per stratum inside it."""
    keys = ["split", "stratum"] if by_stratum else ["split"]
    counts = split.groupBy(*keys).agg(F.count(F.lit(1)).alias("observations"))
    total = counts.agg(F.sum("observations")).scalar()
    return counts.withColumn("percentage", percentage(F.col("observations"), total))


def require_cover(original: DataFrame, split: DataFrame, held_out: float = 0.30, test_share: float = 0.50) -> None:
    """Every row is in exactly one split, sizes are the quotas, and the columns are unchanged."""
    counted = split.groupBy("stratum", "split").count().collect()
    if any(r["split"] not in (TRAIN, VALIDATION, TEST) for r in counted):
        raise ValueError("Some rows have no split.")
    if sum(r["count"] for r in counted) != original.count():
        raise ValueError("The splits do not add up to the original rows.")
    sizes: dict = {}
    for r in counted:
        sizes[r["stratum"]] = sizes.get(r["stratum"], 0) + r["count"]
    found = {(r["stratum"], r["split"]): r["count"] for r in counted}
    for stratum, quota in split_quotas(sizes, held_out, test_share).items():
        if tuple(found.get((stratum, name), 0) for name in (TRAIN, VALIDATION, TEST)) != quota:
            raise ValueError(f"The splits of stratum {stratum} are not its quotas {quota}.")
    if set(split.columns) - {"split", "stratum"} != set(original.columns) - {"stratum"}:
        raise ValueError("The split table has other columns than the original.")
