"""Exact quantiles with linear interpolation that keep every task and shuffle bounded.

A group is sorted inside one task only when its counted size is at most ``bounded``
(about three times faster there than Spark's ``percentile``). In larger groups

1. a sketch over a random sample suggests, for each wanted rank, an interval of values;
2. a scan counts the rows below, above and in each of CELLS even cells of every interval,
   and notes the least and greatest value of each. The cells that hold the wanted ranks
   follow exactly, also where the sample was misleading: then it is the rows beside the
   interval. Their least and greatest values are the next interval, until it holds at most
   ``bounded`` rows or one value;
3. a last scan counts the values inside the final intervals.

Counts are combined in every task, so what is shuffled depends on the number of intervals
and cells, not on the table. A value that fills a third of the table is one interval of its own.

Whole columns with many wanted ranks go the same way on Arrow batches: a task finds the cell of
every value by binary search, so a scan costs the same for one rank and for a hundred.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.durable import durable, forget
from plumbline.functions.expressions import INFINITY, finite
from plumbline.schema import quoted

BOUNDED_GROUP = 1_000_000
GRID = 1_000
SKETCH_ACCURACY = 10_000
SAMPLE_ROWS = 500_000
# Grid cells added on both sides: five standard errors of a sampled median rank.
SAMPLE_MARGIN = 4
CELLS = 1024
SEED = 42
BROADCAST_BYTES = 64 << 20


def _between(low: Column, high: Column, share: Column) -> Column:
    return F.when(low == high, low).otherwise(low + (high - low) * share)


def _sorted_quantiles(grouped: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Quantiles of groups whose values were collected into a sorted array ``_all``."""
    listed = ", ".join(f"{float(p)!r}D" for p in probs)
    placed = grouped.select(
        *[quoted(k) for k in keys],
        "_all",
        F.expr(f"transform(array({listed}), p -> p * (size(_all) - 1))").alias("_places"),
    )
    values = F.expr(
        """transform(_places, place -> CASE
             WHEN get(_all, int(floor(place))) = get(_all, int(ceil(place))) THEN get(_all, int(floor(place)))
             ELSE get(_all, int(floor(place)))
                  + (get(_all, int(ceil(place))) - get(_all, int(floor(place)))) * (place - floor(place)) END)"""
    )
    return placed.select(*[quoted(k) for k in keys], values.alias("quantiles"))


def grouped_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    value: Column,
    probs: Sequence[float],
    largest: int | None = None,
    bounded: int = BOUNDED_GROUP,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """``keys..., quantiles array<double>`` with one entry per probability.

    ``largest`` is an upper limit of the group size where the caller knows one; a
    limit of at most ``bounded`` saves the counting job. ``sizes`` (``keys..., n``)
    gives the sizes themselves, if known. Groups without a value do not appear.
    """
    keys, probs = list(keys), list(probs)
    pairs = rows.select(*[quoted(k) for k in keys], finite(value.cast("double")).alias("_v"))
    pairs = pairs.where(F.col("_v").isNotNull())
    ordered = F.sort_array(F.collect_list("_v")).alias("_all")
    if largest is not None and largest <= bounded:
        return _sorted_quantiles(pairs.groupBy(*keys).agg(ordered), keys, probs)
    if sizes is None:
        sizes = pairs.groupBy(*keys).agg(F.count("_v").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= bounded:
            return _sorted_quantiles(pairs.groupBy(*keys).agg(ordered), keys, probs)
        sizes = durable(sizes.where(F.col("n") > bounded))
    # At most rows / bounded groups are large: one in a million rows.
    large = sizes.where(F.col("n") > bounded)
    groups = large.count()
    same = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
    rest = pairs.alias("a").join(_sized(large.alias("b"), groups), same, "left_anti")
    small = _sorted_quantiles(rest.groupBy(*keys).agg(ordered), keys, probs)
    return small.unionByName(_narrowed(pairs, large, keys, probs, bounded, groups))


def _sized(side: DataFrame, groups: int) -> DataFrame:
    """Broadcast a table with one row of numbers per large group, up to a checked size in bytes."""
    width = 32 + 16 * len(side.columns)
    return F.broadcast(side) if groups * width <= BROADCAST_BYTES else side


def _with_state(pairs: DataFrame, state: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """Attach the state of its group to every row of a large group; NULL keys match.

    With the state broadcast, the rows themselves are never shuffled by a hot key.
    """
    wanted = [c for c in state.columns if c not in keys]
    small = state.select(
        *[quoted(k).alias(f"_s_{k}") for k in keys], *[quoted(c) for c in wanted]
    )
    same = [quoted(k).eqNullSafe(quoted(f"_s_{k}")) for k in keys]
    return pairs.join(_sized(small, groups), same).drop(*[f"_s_{k}" for k in keys])


def _narrowed(
    pairs: DataFrame, large: DataFrame, keys: list[str], probs: list[float], bounded: int, groups: int
) -> DataFrame:
    """Quantiles of the large groups."""
    state = durable(_first_intervals(_sampled_grid(pairs, large, keys, groups), keys, probs))
    while not state.where((F.col("rows") > bounded) & F.col("low").isNull()).isEmpty():
        open_ = state.where("low IS NULL")
        after = durable(_next_intervals(pairs, open_, keys, len(probs), groups).unionByName(state.where("low IS NOT NULL")))
        forget(state)
        state = after
    listed = state.where("low IS NULL")
    wide = _side_by_side(listed, keys, len(probs), ("lo", "hi"))
    v = F.col("_v")
    inside = [
        F.when(v.between(F.col(f"lo{i}"), F.col(f"hi{i}")), F.struct(F.lit(i).alias("_slot"), v.alias("_v")))
        for i in range(len(probs))
    ]
    values = _with_state(pairs, wide, keys, groups).select(
        *[quoted(k) for k in keys], F.inline(F.array_compact(F.array(*inside)))
    )
    return _ranked_values(values.groupBy(*keys, "_slot", "_v").agg(F.count(F.lit(1)).alias("_w")), state, keys)


def _sampled_grid(pairs: DataFrame, large: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """``keys, n, grid``: values at 1,001 even ranks of about ``SAMPLE_ROWS`` rows per group."""
    kept = F.rand(SEED) < F.lit(float(SAMPLE_ROWS)) / F.col("n")
    grid = F.percentile_approx("_v", _even_ranks(), F.lit(SKETCH_ACCURACY))
    return _with_state(pairs, large, keys, groups).where(kept).groupBy(*keys).agg(
        F.max("n").alias("n"), grid.alias("grid")
    )


def _even_ranks() -> Column:
    return F.expr("array(" + ", ".join(f"{g / GRID!r}D" for g in range(GRID + 1)) + ")")


def _first_intervals(grids: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """``keys, _slot, lo, hi, rank, step, share, rows``: the sketch's interval of each wanted rank.

    ``step`` is the distance to the second rank that interpolation needs, ``share`` its weight;
    ``low`` and ``high`` are the values of both ranks once they are known.
    """
    cells = []
    for i, p in enumerate(probs):
        rank = F.floor(F.lit(p) * (F.col("n") - 1)).cast("long")
        left = F.floor(rank * GRID / F.col("n")).cast("int") - SAMPLE_MARGIN
        right = F.ceil((rank + 2) * GRID / F.col("n")).cast("int") + SAMPLE_MARGIN
        cells.append(
            F.struct(
                F.lit(i).alias("_slot"),
                F.get("grid", F.greatest(left, F.lit(0))).alias("lo"),
                F.get("grid", F.least(right, F.lit(GRID))).alias("hi"),
                rank.alias("rank"),
                (F.least(rank + 1, F.col("n") - 1) - rank).alias("step"),
                (F.lit(p) * (F.col("n") - 1) - rank).alias("share"),
                F.col("n").alias("rows"),
                # Nothing is cut away yet: ranks count from the first row of the group.
                F.lit(-INFINITY).alias("from_value"),
                F.lit(INFINITY).alias("to_value"),
                F.lit(None).cast("double").alias("low"),
                F.lit(None).cast("double").alias("high"),
            )
        )
    return grids.select(*[quoted(k) for k in keys], F.inline(F.array(*cells)))


def _side_by_side(state: DataFrame, keys: list[str], slots: int, names: Sequence[str]) -> DataFrame:
    """One row per group with the named numbers of every slot."""
    picked = [
        F.max(F.when(F.col("_slot") == i, F.col(name))).alias(f"{name}{i}") for name in names for i in range(slots)
    ]
    return state.groupBy(*[quoted(k) for k in keys]).agg(*picked)


def _next_intervals(pairs: DataFrame, state: DataFrame, keys: list[str], slots: int, groups: int) -> DataFrame:
    """Count the cells of every interval and keep those that hold its ranks."""
    v = F.col("_v")
    wide = _side_by_side(state, keys, slots, ("lo", "hi", "from_value", "to_value"))
    codes = []
    for i in range(slots):
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        cell = F.least(F.floor((v - lo) / F.nullif(hi - lo, F.lit(0.0)) * CELLS), F.lit(CELLS - 1)).cast("int")
        code = F.when(v < lo, -1).when(v > hi, CELLS).otherwise(F.coalesce(cell, F.lit(0)))
        codes.append(F.when(v.between(F.col(f"from_value{i}"), F.col(f"to_value{i}")), code).alias(f"_c{i}"))
    # Codes rise with the value, so the number of their combinations is the sum of the cells.
    counted = (
        _with_state(pairs, wide, keys, groups)
        .groupBy(*[quoted(k) for k in keys], *codes)
        .agg(F.count(F.lit(1)).alias("w"), F.min("_v").alias("least"), F.max("_v").alias("most"))
    )
    by_slot = [
        F.when(
            F.col(f"_c{i}").isNotNull(),
            F.struct(F.lit(i).alias("_slot"), F.col(f"_c{i}").alias("code"), "w", "least", "most"),
        )
        for i in range(slots)
    ]
    each = counted.select(*[quoted(k) for k in keys], F.inline(F.array_compact(F.array(*by_slot))))
    slotted = [*keys, "_slot"]
    cells = each.groupBy(*slotted, "code").agg(
        F.sum("w").alias("w"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    # At most CELLS + 2 rows per interval.
    upto = F.sum("w").over(Window.partitionBy(*slotted).orderBy("code"))
    running = cells.withColumn("upto", upto).alias("a").join(state.alias("b"), _same("a", "b", slotted))
    first, last = F.col("upto") > F.col("rank"), F.col("upto") - F.col("w") <= F.col("rank") + F.col("step")
    found = running.where(first & last).groupBy(*[F.col(f"a.`{k}`").alias(k) for k in slotted]).agg(
        F.min("least").alias("lo"),
        F.max("most").alias("hi"),
        (F.max("rank") - F.min(F.col("upto") - F.col("w"))).alias("rank"),
        F.max("step").alias("step"),
        F.max("share").alias("share"),
        F.sum("w").alias("rows"),
        # Ranks in two cells are the last value of one and the first value of the other.
        F.count(F.lit(1)).alias("cells"),
        F.min("most").alias("end_of_first"),
        F.max("least").alias("start_of_last"),
    )
    one = F.col("lo") == F.col("hi")
    return found.select(
        *slotted, "lo", "hi", "rank", "step", "share", "rows",
        F.col("lo").alias("from_value"),
        F.col("hi").alias("to_value"),
        F.when(one, F.col("lo")).when(F.col("cells") > 1, F.col("end_of_first")).alias("low"),
        F.when(one, F.col("lo")).when(F.col("cells") > 1, F.col("start_of_last")).alias("high"),
    )


def _same(left: str, right: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]


def _ranked_values(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Read the wanted ranks off the few counted values of each interval; known ones stay."""
    slotted = [*keys, "_slot"]
    order = Window.partitionBy(*slotted).orderBy("_v")
    running = rows.withColumn("upto", F.sum("_w").over(order))
    found = running.alias("a").join(state.where("low IS NULL").alias("b"), _same("a", "b", slotted)).select(
        *[F.col(f"a.`{k}`").alias(k) for k in slotted], "_v", "upto", "rank", "step", "share"
    )
    low = F.min(F.when(F.col("upto") > F.col("rank"), F.col("_v")))
    high = F.min(F.when(F.col("upto") > F.col("rank") + F.col("step"), F.col("_v")))
    values = found.groupBy(*slotted).agg(low.alias("low"), high.alias("high"), F.max("share").alias("share"))
    values = values.unionByName(state.where("low IS NOT NULL").select(*slotted, "low", "high", "share"))
    one = _between(F.col("low"), F.col("high"), F.col("share")).alias("value")
    ordered = F.sort_array(F.collect_list(F.struct("_slot", one)))
    return values.groupBy(*keys).agg(F.transform(ordered, lambda x: x["value"]).alias("quantiles"))


def long_form(df: DataFrame, columns: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """``variable, value`` rows of the named numeric columns or expressions."""
    if not isinstance(columns, Mapping):
        columns = {name: quoted(name) for name in columns}
    wide = df.select(*[expr.cast("double").alias(name) for name, expr in columns.items()])
    return wide.unpivot([], list(columns), "variable", "value")


#: The values of the column of that number in a batch, without missing ones.
Reader = Callable[[pa.RecordBatch, int], np.ndarray]


def _present(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """The values of a column that are there; -0.0 becomes 0.0."""
    return batch.column(f"_{column}").drop_null().to_numpy(zero_copy_only=False) + 0.0


def _sampler(shares: dict[int, float], read: Reader) -> Callable:
    """``col, v, n``: a random share of the values of each column, and once for a task how many there are."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        rows = dict.fromkeys(shares, 0)
        for batch in batches:
            for c, share in shares.items():
                values = read(batch, c)
                rows[c] += len(values)
                values = values[rng.random(len(values)) < share]
                number, none = np.full(len(values), c, np.int32), np.zeros(len(values), np.int64)
                yield pa.RecordBatch.from_pydict({"col": number, "v": values, "n": none})
        number, n = pa.array(list(rows), pa.int32()), pa.array(list(rows.values()), pa.int64())
        yield pa.RecordBatch.from_pydict({"col": number, "v": pa.nulls(len(rows), pa.float64()), "n": n})

    return sample


def _cell_of(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Cells in the order of their values: 2i between the edges before and at i, 2i + 1 the edge i itself."""
    place = np.searchsorted(edges, values)
    return 2 * place + (edges[np.minimum(place, len(edges) - 1)] == values)


def _cell_counter(edges: dict[int, np.ndarray], read: Reader) -> Callable:
    """Rows, least and greatest value of each cell of each column, once for a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {c: np.zeros(2 * len(e) + 1, np.int64) for c, e in edges.items()}
        least = {c: np.full(len(n), np.inf) for c, n in rows.items()}
        most = {c: np.full(len(n), -np.inf) for c, n in rows.items()}
        for batch in batches:
            for c, e in edges.items():
                values = read(batch, c)
                cells = _cell_of(values, e)
                rows[c] += np.bincount(cells, minlength=len(rows[c]))
                np.minimum.at(least[c], cells, values)
                np.maximum.at(most[c], cells, values)
        for c, n in rows.items():
            held = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "col": pa.array(np.full(len(held), c), pa.int32()), "cell": pa.array(held, pa.int32()), "n": n[held],
                "least": least[c][held], "most": most[c][held],
            })

    return count


def _cell_values(wanted: dict[int, list[tuple[float, float]]], read: Reader) -> Callable:
    """``col, cell, v, w``: the values inside the wanted cells (disjoint, in their order), counted by batch."""

    def values_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, spans in wanted.items():
                low, high = (np.array(side) for side in zip(*spans))
                values = read(batch, c)
                cells = np.searchsorted(low, values, "right") - 1
                values, cells = values[cells >= 0], cells[cells >= 0]
                inside = values <= high[cells]
                # Spans are in order and disjoint: a value names its cell.
                found, first, w = np.unique(values[inside], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "col": pa.array(np.full(len(found), c), pa.int32()), "cell": pa.array(cells[inside][first], pa.int32()),
                    "v": found, "w": w.astype(np.int64),
                })

    return values_of


def counted_quantiles(
    df: DataFrame,
    inputs: Sequence[Mapping[str, Column]],
    likely: Sequence[int],
    probs: Sequence[float],
    bounded: int = BOUNDED_GROUP,
    read: Reader = _present,
) -> list[list[float] | None]:
    """Quantiles of columns of any size, in their order; None for a column without values.

    ``read(batch, i)`` gives the finite values of column i, from a batch that has what ``inputs[i]``
    names; about ``likely[i]`` of them are expected. The driver holds the edges around the wanted ranks
    and the cells that have them; cells are counted and their values ranked by tasks.
    """
    spark = df.sparkSession

    def scan(columns, task: Callable, schema: str) -> DataFrame:
        named = {name: value for i in columns for name, value in inputs[i].items()}
        return df.select(*[value.alias(name) for name, value in named.items()]).mapInArrow(task, schema)

    shares = {i: SAMPLE_ROWS / max(n, 1) for i, n in enumerate(likely)}
    sampled = scan(shares, _sampler(shares, read), "col int, v double, n long").groupBy("col").agg(
        F.sum("n").alias("n"), F.percentile_approx("v", _even_ranks(), F.lit(SKETCH_ACCURACY)).alias("grid")
    )
    drawn = {r["col"]: r for r in sampled.collect()}
    sizes = {i: drawn[i]["n"] for i in shares if i in drawn and drawn[i]["n"]}
    edges: dict[int, np.ndarray] = {}
    # Of each column the wanted ranks: (rank, values that stand before what is still open).
    open_: dict[int, list[tuple[int, int]]] = {}
    known: dict[tuple[int, int], float] = {}
    for i, n in sizes.items():
        around = {0, GRID}
        open_[i] = sorted({(rank, 0) for p in probs for rank in _ranks(p, n)})
        for rank, _ in open_[i]:
            middle = rank * GRID // n
            around |= set(range(max(0, middle - SAMPLE_MARGIN), min(GRID, middle + 1 + SAMPLE_MARGIN) + 1))
        # Where the sample came out empty, the extremes of all doubles are a first cell.
        grid = drawn[i]["grid"] or [0.0]
        edges[i] = np.unique([grid[min(g, len(grid) - 1)] for g in around]) + 0.0
    ready: dict[int, dict[tuple[float, float], tuple[int, list[int]]]] = {}
    while edges:
        counted = scan(edges, _cell_counter(edges, read), "col int, cell int, n long, least double, most double")
        cells = counted.groupBy("col", "cell").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
        # A few cells for each wanted rank of each column.
        found: dict[int, list] = {}
        for r in cells.orderBy("col", "cell").collect():
            found.setdefault(r["col"], []).append(r)
        following: dict[int, np.ndarray] = {}
        for i in edges:
            upto = np.cumsum([r["n"] for r in found[i]])
            still, finer = [], []
            for rank, _ in open_[i]:
                at = int(np.searchsorted(upto, rank, "right"))
                r, before = found[i][at], int(upto[at]) - found[i][at]["n"]
                if rank == before or r["least"] == r["most"]:
                    known[i, rank] = r["least"]
                elif rank == before + r["n"] - 1:
                    known[i, rank] = r["most"]
                elif r["n"] <= bounded:
                    spans = ready.setdefault(i, {})
                    spans.setdefault((r["least"], r["most"]), (before, []))[1].append(rank)
                else:
                    still.append((rank, before))
                    finer.append(r["least"] + (r["most"] / CELLS - r["least"] / CELLS) * np.arange(CELLS + 1))
                    finer.append([r["least"], r["most"]])
            open_[i] = still
            if still:
                following[i] = np.unique(np.concatenate(finer)) + 0.0
        edges = following
    if ready:
        spans = {i: sorted(ready[i]) for i in sorted(ready)}
        inside = scan(spans, _cell_values(spans, read), "col int, cell int, v double, w long")
        wanted = [(i, c, rank - ready[i][s][0], rank) for i in spans for c, s in enumerate(spans[i]) for rank in ready[i][s][1]]
        ranks = spark.createDataFrame(wanted, "col int, cell int, place long, rank long")
        # A cell has at most `bounded` rows.
        upto = F.sum("w").over(Window.partitionBy("col", "cell").orderBy("v"))
        running = inside.groupBy("col", "cell", "v").agg(F.sum("w").alias("w")).withColumn("upto", upto)
        hits = running.join(F.broadcast(ranks), ["col", "cell"]).where("upto > place AND upto - w <= place")
        known.update({(r["col"], r["rank"]): r["v"] for r in hits.select("col", "rank", "v").collect()})
    result: list[list[float] | None] = [None] * len(inputs)
    for i, n in sizes.items():
        result[i] = []
        for p in probs:
            rank, after = _ranks(p, n)
            low, high = known[i, rank], known[i, after]
            result[i].append(low if low == high else low + (high - low) * (p * (n - 1) - rank))
    return result


def _ranks(p: float, n: int) -> tuple[int, int]:
    """The ranks, from 0, between which the quantile lies."""
    rank = int(p * (n - 1) // 1)
    return rank, min(rank + 1, n - 1)


def _column_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column] | Sequence[str],
    probs: Sequence[float],
    largest: int | None,
    bounded: int,
) -> DataFrame:
    """``variable, quantiles``; columns of more than ``bounded`` values are counted at once."""
    named = columns if isinstance(columns, Mapping) else {n: quoted(n) for n in columns}
    if largest is not None and largest <= bounded:
        return grouped_quantiles(long_form(df, named), ["variable"], F.col("value"), probs, largest, bounded)
    counted = [finite(e.cast("double")) for e in named.values()]
    found = dict(zip(named, df.agg(*[F.count(c).alias(f"_{i}") for i, c in enumerate(counted)]).first()))
    few = {n: e for n, e in named.items() if found[n] <= bounded}
    many = {n: e for n, e in named.items() if n not in few}
    inputs = [{f"_{i}": finite(e.cast("double"))} for i, e in enumerate(many.values())]
    made = dict(zip(many, counted_quantiles(df, inputs, [found[n] for n in many], list(probs), bounded))) if many else {}
    large = df.sparkSession.createDataFrame(list(made.items()), "variable string, quantiles array<double>")
    if not few:
        return large
    most = max(found[n] for n in few)
    return grouped_quantiles(long_form(df, few), ["variable"], F.col("value"), probs, most, bounded).unionByName(large)


def fit_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column] | Sequence[str],
    probs: Sequence[float],
    largest: int | None = None,
    bounded: int = BOUNDED_GROUP,
) -> dict[str, list[float | None]]:
    """Quantiles of whole columns as plain numbers, O(columns x probabilities) on the driver.

    Callers use them as literals, so later filters can reach the scan.
    """
    names = list(columns)
    found = _column_quantiles(df, columns, probs, largest, bounded).collect()
    result: dict[str, list[float | None]] = {name: [None] * len(probs) for name in names}
    result.update({row["variable"]: list(row["quantiles"]) for row in found})
    return result


def quantile_table(
    df: DataFrame,
    columns: Mapping[str, Column] | Sequence[str],
    named: Mapping[str, float],
    largest: int | None = None,
    bounded: int = BOUNDED_GROUP,
) -> DataFrame:
    """``variable`` and one column per named quantile, without driver round trip of values."""
    found = _column_quantiles(df, columns, list(named.values()), largest, bounded)
    return found.select(
        "variable", *[F.get("quantiles", F.lit(i)).alias(name) for i, name in enumerate(named)]
    )
