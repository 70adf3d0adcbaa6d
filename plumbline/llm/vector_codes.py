"""Vector codes: product quantisation by a lexicographic trie over distinct parts.

Vectors are cut into consecutive parts, and each part position has a codebook. A round of
fitting assigns every part to the nearest entry of its codebook and moves each entry to the
floored mean of its parts; after the last round parts are assigned to the final codebooks.

Equal parts are counted once: (position, part) is grouped with its number of rows, ordered
lexicographically by a range partition and written as a table, so that a vector repeated
without end is one row per position. A round walks the trie over the ordered parts of a
batch depth first. The node of a prefix holds the accumulated squared distances of that
prefix to all entries, which its children share and extend by one dimension; a leaf takes
the smallest distance and adds its part, weighted by its rows, to the sums of that entry.
A path without forks is finished in one step. Only the sums of entries leave a task (at
most entries x dimensions numbers), and only codebooks reach the driver.

Final codes come from the same walk over the rows themselves, with no join.

Arithmetic is on integers. While no square can leave the 53 bits of a double, doubles hold
them exactly; otherwise Python's integers do. Components and errors beyond the range of a
long are the range's end.

Cases: a vector that is NULL or holds NULL, NaN or infinite components takes no part. A
NULL key is larger than all others. Repeated rows are rows like others; of equal keys the
smaller vector is the earlier codebook entry. Vectors of another dimension have codebooks
of their own, as many as there are dimensions. Where parts cannot be equal, later parts are the
longer ones. Fewer vectors than entries give a smaller codebook, an empty table none. Other
columns are carried on demand, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from plumbline.llm.common import durable, forget, hot_join

#: Distinct parts walked at once, and parts of one task of a round.
WALK, TASK_ROWS = 4096, 1 << 18
#: A double holds integers below this exactly.
EXACT, LONG = 1 << 53, (1 << 63) - 1

Codebooks = dict[int, list[np.ndarray]]


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """_key, _vec (floor(scale * x) of each component), _size and the carried columns of the rows that take part."""
    vector = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(f"`{vector_col}`").isNotNull() & ~bad)
    carried = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry]).alias("_carried")
    rows = rows.select(
        F.col(f"`{id_col}`").alias("_key"), F.transform(vector, lambda x: F.floor(x * scale).cast("long")).alias("_vec"), carried
    )
    return rows.withColumn("_size", F.size("_vec"))


def bounds(size: int, parts: int) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    return [size * p // parts for p in range(parts + 1)]


def _parts(rows: DataFrame, parts: int) -> DataFrame:
    """One row per row and position: _size, _position, _part."""
    size = F.col("_size")
    cut = [F.floor(size * p / parts).cast("int") for p in range(parts + 1)]
    pieces = [
        F.struct(F.lit(p).alias("_position"), F.slice("_vec", cut[p] + 1, cut[p + 1] - cut[p]).alias("_part"))
        for p in range(parts)
    ]
    return rows.select("_size", F.inline(F.array(*pieces)))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per part (rows in lexicographic order, distinct) its nearest entry, the first of equals, and the squared distance."""
    count, depths = parts.shape
    reach = 2 * max(_largest(parts), _largest(entries))
    kind = np.float64 if reach * reach * max(depths, 1) < EXACT else object
    values, books = parts.astype(kind), entries.astype(kind)
    codes, errors = np.zeros(count, np.int64), np.zeros(count, kind)
    if not depths:
        return codes, errors

    def settle(rows: np.ndarray, distances: np.ndarray) -> None:
        codes[rows] = distances.argmin(axis=1)
        errors[rows] = distances[np.arange(len(rows)), codes[rows]]

    # A node: rows from, rows to, its depth, and the distances of its prefix to all entries.
    stack = [(0, count, 0, np.zeros(len(books), kind))]
    while stack:
        low, high, depth, shared = stack.pop()
        column = values[low:high, depth]
        starts = low + np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
        ends = np.append(starts[1:], high)
        children = shared + (values[starts, depth][:, None] - books[:, depth]) ** 2
        if depth + 1 == depths:
            settle(starts, children)
            continue
        alone = ends - starts == 1
        if alone.any():
            rest, tails = values[starts[alone], depth + 1 :], books[:, depth + 1 :]
            square = (rest * rest).sum(axis=1)[:, None] + (tails * tails).sum(axis=1)
            settle(starts[alone], children[alone] + square - 2 * (rest @ tails.T))
        for child in np.flatnonzero(~alone)[::-1]:
            stack.append((starts[child], ends[child], depth + 1, children[child]))
    return codes, errors


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of equally long lists."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


SUMS = "_size int, _position int, _entry int, _place int, _rows long, _high long, _low long"


def _sums(books: Codebooks):
    """Per batch of counted parts the weighted sums of each entry, split at 32 bits."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, positions = batch.column("_size").to_numpy(), batch.column("_position").to_numpy()
            for size, position in set(zip(sizes.tolist(), positions.tolist(), strict=True)):
                held = np.flatnonzero((sizes == size) & (positions == position))
                entries = books[size][position]
                width = entries.shape[1]
                if not width:
                    continue
                some = batch.take(pa.array(held))
                parts, rows = _matrix(some.column("_part"), width), some.column("_rows").to_numpy()
                order = np.lexsort(parts.T[::-1])
                total, used = np.zeros((len(entries), width), object), np.zeros(len(entries), np.int64)
                for start in range(0, len(order), WALK):
                    now = order[start : start + WALK]
                    codes, _ = nearest(parts[now], entries)
                    np.add.at(used, codes, rows[now])
                    heaviest = _largest(parts[now]) * int(rows[now].sum())
                    part = np.zeros(total.shape, np.int64 if heaviest <= LONG else object)
                    np.add.at(part, codes, parts[now].astype(part.dtype) * rows[now].astype(part.dtype)[:, None])
                    total += part
                entry, place = np.nonzero(np.broadcast_to((used > 0)[:, None], total.shape))
                sums = total[entry, place]
                yield pa.RecordBatch.from_pydict(
                    {
                        "_size": pa.array(np.full(len(entry), size, np.int32)),
                        "_position": pa.array(np.full(len(entry), position, np.int32)),
                        "_entry": pa.array(entry.astype(np.int32)),
                        "_place": pa.array(place.astype(np.int32)),
                        "_rows": pa.array(used[entry]),
                        "_high": pa.array((sums >> 32).astype(np.int64)),
                        "_low": pa.array((sums & 0xFFFFFFFF).astype(np.int64)),
                    }
                )

    return walk


def _first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the first vectors by key, for each dimension."""
    first = Window.partitionBy("_size").orderBy(F.col("_key").asc_nulls_last(), "_vec")
    taken = rows.select("_size", "_key", "_vec").withColumn("_place", F.row_number().over(first))
    books: Codebooks = {}
    held: dict[int, list] = {}
    for row in taken.where(F.col("_place") <= entries).orderBy("_size", "_place").collect():
        held.setdefault(row["_size"], []).append(row["_vec"])
    for size, vecs in held.items():
        matrix, cut = np.array(vecs, np.int64).reshape(len(vecs), size), bounds(size, parts)
        books[size] = [matrix[:, cut[p] : cut[p + 1]] for p in range(parts)]
    return books


def fit(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks:
    """Codebooks of the rows of `quantised`: per dimension an array (entry, place) for each part position."""
    books = _first_codebooks(rows, parts, entries)
    if not books or not rounds:
        return books
    distinct = durable(_parts(rows, parts).groupBy("_size", "_position", "_part").agg(F.count(F.lit(1)).alias("_rows")))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-distinct.count() // TASK_ROWS))
    ordered = durable(
        distinct.repartitionByRange(tasks, "_size", "_position", "_part").sortWithinPartitions("_size", "_position", "_part")
    )
    forget(distinct)
    for _ in range(rounds):
        sums = ordered.mapInArrow(_sums(books), SUMS).groupBy("_size", "_position", "_entry", "_place")
        moved = sums.agg(*[F.sum(c).alias(c) for c in ("_rows", "_high", "_low")]).collect()
        books = {size: [book.copy() for book in own] for size, own in books.items()}
        for r in moved:
            books[r["_size"]][r["_position"]][r["_entry"], r["_place"]] = ((r["_high"] << 32) + r["_low"]) // r["_rows"]
    forget(ordered)
    return books


def encode(rows: DataFrame, books: Codebooks, parts: int = 4) -> DataFrame:
    """Per row of `quantised`: _key, _carried, _codes (array of entry numbers by position) and _error."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("_size").to_numpy()
            codes, errors = np.zeros((len(sizes), parts), np.int32), np.zeros(len(sizes), object)
            for size in set(sizes.tolist()):
                held, cut = np.flatnonzero(sizes == size), bounds(size, parts)
                vecs = _matrix(batch.column("_vec").take(pa.array(held)), size)
                for position in range(parts):
                    part = vecs[:, cut[position] : cut[position + 1]]
                    if not part.shape[1]:
                        continue
                    distinct, back = np.unique(part, axis=0, return_inverse=True)
                    found, error = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), object)
                    for start in range(0, len(distinct), WALK):
                        some = slice(start, start + WALK)
                        found[some], error[some] = nearest(distinct[some], books[size][position])
                    codes[held, position] = found[back.ravel()]
                    errors[held] += error[back.ravel()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"),
                    batch.column("_carried"),
                    pa.ListArray.from_arrays(np.arange(0, codes.size + 1, parts, dtype=np.int32), codes.ravel()),
                    pa.array(np.minimum(errors, LONG).astype(np.int64)),
                ],
                names=["_key", "_carried", "_codes", "_error"],
            )

    kept = rows.select("_key", "_carried", "_size", "_vec")
    added = StructType().add("_codes", ArrayType(IntegerType())).add("_error", LongType())
    return kept.mapInArrow(walk, StructType([kept.schema["_key"], kept.schema["_carried"], *added.fields]))


def summed_by(encoded: DataFrame, label: Column, name: str) -> DataFrame:
    """The encoded rows with the sum of _error over rows of equal label, NULLs together.

    Sums are made before the shuffle and joined back over dealt rows: a label may hold most rows.
    """
    rows = encoded.withColumns({"_label": F.coalesce(label.cast("string"), F.lit("")), "_none": label.isNull()})
    total = F.least(F.sum(F.col("_error").cast("decimal(38,0)")), F.lit(LONG)).cast("long").alias(name)
    sums = rows.groupBy("_label", "_none").agg(total)
    return hot_join(rows, sums, ["_label", "_none"], [F.col("_key"), F.col("_codes")]).drop("_label", "_none")
