"""Repeated byte strings by a sparse suffix array, sorted deep-shallow.

Removed is every byte covered by a string of `length` bytes that also starts earlier in the
corpus (in a document with a smaller key, or earlier in the same document).

A full suffix array has an entry per byte. Here the window at each position is looked up by an
anchor, the place in the window where the hash of the next GRAM bytes is least (leftmost of
ties). It depends on the window's bytes only, so equal windows have their anchor at the same
place. Windows in a row share anchors: a document is a list of runs (anchor, first and last
window), one per 43 bytes or so of ordinary text, and only suffixes at anchors are sorted.

1. A map finds the runs. A run is identified by the hashes of its anchor and of its bytes. Of
   equal runs in a batch only the first goes on, the others are repeated as a whole; so a
   passage found everywhere sends one row per batch.
2. Runs meet by anchor in one shuffle. Windows of a run equal to an earlier one are all
   repeated. An anchor with one run, nearly all of them, is done.
3. Anchors with different runs need their bytes. Suffixes at the anchors and reversed prefixes
   before them are sorted (multikey quicksort to a shallow depth, blind tries below); the
   common prefixes of neighbours tell, for each distance from the anchor, which windows are
   equal, and all but the first are repeated. A frequent anchor is dealt by that distance.
4. Spans of a document are united and cut from its text. Only texts that take part in step 3 or
   lose something are shuffled.

Cases: a NULL text is the empty text. NULL keys come first. Documents that share a key are told
apart by a hash of their text; of rows that repeat key and text each gets the same answer, as one
document. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import durable, small
from plumbline.llm.suffix_order import deep_shallow

#: Bytes hashed at an anchor (a power of two), and bytes of a text looked at together.
GRAM, BLOCK = 16, 1 << 20
#: Distinct runs of an anchor from which they are dealt by distance, and runs sorted together.
FREQUENT, TOGETHER = 2048, 65_536

_U = np.uint64
_LETTER = np.random.default_rng(2).integers(0, 1 << 63, 256, dtype=_U)
_FACTOR = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on."""
    held, width, factor = _LETTER[data], 1, _FACTOR
    while width < GRAM:
        held = held[: len(held) - width] * _U(factor) + held[width:]
        held ^= held >> _U(29)
        width, factor = width * 2, factor * _FACTOR % (1 << 64)
    return held


def runs(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same anchor: (hash of the anchor's bytes, anchor, first window, last window)."""
    data = np.frombuffer(raw, np.uint8)
    span = length - GRAM + 1
    found = []
    bits = _U(21)
    for start in range(0, max(len(data) - length + 1, 0), BLOCK):
        hashes = gram_hashes(data[start : start + BLOCK + length - 1])
        # The place is in the low bits: ties of the hash go to the leftmost.
        least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=_U)
        width = 1
        while width * 2 <= span:
            least, width = np.minimum(least[: len(least) - width], least[width:]), width * 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        anchors = (least & ((_U(1) << bits) - _U(1))).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        last = np.append(first[1:], len(anchors)) - 1
        at = anchors[first]
        found.append((hashes[at], at + start, first + start, last + start))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty.astype(_U), empty, empty, empty
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _run_rows(length: int):
    """Rows (anchor hash, run hash, place of the anchor, first window, last window) of each text; repeats in a batch marked."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, contents, rows = [], [], []
            seen = set()
            for row, (key, text_hash, text) in enumerate(zip(*batch.columns[:3], strict=True)):
                # Rows that repeat key and text are one document.
                document = key.as_py(), text_hash.as_py()
                if document in seen:
                    continue
                seen.add(document)
                raw = text.as_py()
                grams, at, first, last = runs(raw, length)
                held = memoryview(raw)
                # The anchor's place in the run belongs to the run's identity.
                contents += [
                    xxhash.xxh3_64_intdigest(held[a : b + length], p - a)
                    for a, b, p in zip(first.tolist(), last.tolist(), at.tolist())
                ]
                parts.append((grams.view(np.int64), at, first, last))
                rows.append(np.full(len(at), row))
            if not parts or not contents:
                continue
            grams, at, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
            content, row = np.array(contents, _U).view(np.int64), np.concatenate(rows)
            # First in the order of the corpus: key (NULL first), hash of the text, place.
            keys = batch.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)[row]
            hashes = batch.column(1).to_numpy(zero_copy_only=False)[row]
            order = np.lexsort((first, hashes, keys, content, grams))
            g, c = grams[order], content[order]
            again = np.zeros(len(order), bool)
            again[order[1:]] = (g[1:] == g[:-1]) & (c[1:] == c[:-1])
            # Neighbouring repeats of a document are one span.
            gone = np.flatnonzero(again)
            if len(gone):
                cut = np.append(True, (row[gone][1:] != row[gone][:-1]) | (first[gone][1:] > last[gone][:-1] + length))
                begin = np.flatnonzero(cut)
                stop = np.append(begin[1:], len(gone)) - 1
                spans = (row[gone[begin]], first[gone[begin]], last[gone[stop]])
            else:
                spans = (gone, gone, gone)
            fresh = np.flatnonzero(~again)
            taken = pa.array(np.concatenate([row[fresh], spans[0]]), pa.int64())
            none = pa.nulls(len(spans[0]), pa.int64())

            def with_none(values: np.ndarray) -> pa.Array:
                return pa.concat_arrays([pa.array(values[fresh], pa.int64()), none])

            columns = [
                batch.column(0).take(taken),
                batch.column(1).take(taken),
                with_none(grams),
                with_none(content),
                pa.concat_arrays([pa.array((at - first)[fresh], pa.int64()), none]),
                pa.array(np.concatenate([first[fresh], spans[1]]), pa.int64()),
                pa.array(np.concatenate([last[fresh], spans[2]]), pa.int64()),
            ]
            names = [batch.schema.names[0], "text_hash", "gram", "content", "back", "first", "last"]
            yield pa.record_batch(columns, names=names)

    return apply


def _cut_contexts(length: int):
    """Bytes of the wanted runs of each text; runs are (gram, back, first, last, slice, slices)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = [], []
            for row, (text, wanted) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                raw = text.as_py()
                for run in wanted.as_py():
                    rows.append(row)
                    made.append((*run.values(), raw[run["first"] : run["last"] + length]))
            if not made:
                continue
            taken = pa.array(rows, pa.int64())
            kinds = [pa.int64()] * 6 + [pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
            names = [*batch.schema.names[:2], "gram", "back", "first", "last", "slice", "slices", "context"]
            yield pa.record_batch([batch.column(0).take(taken), batch.column(1).take(taken), *arrays], names=names)

    return apply


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width)


def repeated_windows(
    grams: np.ndarray, backs: np.ndarray, counts: np.ndarray, contexts: list[bytes], allowed: Column, length: int
) -> list[tuple[int, int]]:
    """(run, distance of the window from its anchor) of windows equal to one of an earlier run.

    Runs come in the order of the corpus. `backs` is the distance of a run's first window from
    the anchor, `counts` its number of windows; `allowed(distance)` marks the runs that are to
    be compared at a distance.
    """
    # Suffixes at the anchors, and what precedes the anchors, read backwards.
    after = _padded([c[b:] for c, b in zip(contexts, backs, strict=True)], length)
    before = _padded([c[:b][::-1] for c, b in zip(contexts, backs, strict=True)], max(int(backs.max()), 1))
    order_a, common_a = deep_shallow(after)
    order_b, common_b = deep_shallow(before)
    nearest = backs - counts + 1
    found = []
    for distance in range(int(nearest.min()), int(backs.max()) + 1):
        here = (nearest <= distance) & (distance <= backs) & allowed(distance)
        places = np.flatnonzero(here)
        if len(places) < 2:
            continue
        # Strings that share so many bytes are neighbours: a new group begins where they share fewer.
        group_a, group_b = np.empty(len(backs), np.int64), np.empty(len(backs), np.int64)
        group_a[order_a] = np.cumsum(common_a < length - distance)
        group_b[order_b] = np.cumsum(common_b < distance) if distance else 0
        same = np.lexsort((places, group_b[places], group_a[places], grams[places]))
        sorted_ = places[same]
        again = np.zeros(len(sorted_), bool)
        again[1:] = (
            (grams[sorted_][1:] == grams[sorted_][:-1])
            & (group_a[sorted_][1:] == group_a[sorted_][:-1])
            & (group_b[sorted_][1:] == group_b[sorted_][:-1])
        )
        found += [(int(run), distance) for run in sorted_[again]]
    return found


def _compare(length: int):
    """Spans of repeated windows from contexts that come sorted by (gram, slice)."""

    def spans(table: pa.Table) -> pa.RecordBatch:
        keys = table.column(0).combine_chunks().fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
        text_hash, gram, back, first, last, part, parts = (
            table.column(i).to_numpy().astype(np.int64) for i in range(1, 8)
        )
        order = np.lexsort((first, text_hash, keys))
        contexts = table.column(8).take(pa.array(order)).to_pylist()
        part, parts = part[order], parts[order]
        counts = (last - first + 1)[order]
        found = repeated_windows(
            gram[order], back[order], counts, contexts, lambda d: d % parts == part, length
        )
        # Windows of a run next to each other are one span.
        made: list[tuple[int, int, int]] = []
        for run, distance in sorted(found, key=lambda x: (x[0], -x[1])):
            at = int(first[order[run]] + back[order[run]] - distance)
            if made and made[-1][0] == run and made[-1][2] == at - 1:
                made[-1] = (run, made[-1][1], at)
            else:
                made.append((run, at, at))
        rows = pa.array([int(order[run]) for run, _, _ in made], pa.int64())
        columns = [
            table.column(0).combine_chunks().take(rows),
            table.column(1).combine_chunks().take(rows),
            pa.array([a for _, a, _ in made], pa.int64()),
            pa.array([b for _, _, b in made], pa.int64()),
        ]
        return pa.record_batch(columns, names=[table.schema.names[0], "text_hash", "first", "last"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < TOGETHER:
                continue
            # Whole groups leave; the last group may go on in the next batch.
            table = pa.Table.from_batches(held).combine_chunks()
            gram, part = table.column(2).to_numpy(), table.column(6).to_numpy()
            inner = np.flatnonzero((gram != gram[-1]) | (part != part[-1]))
            whole = int(inner[-1]) + 1 if len(inner) else 0
            if whole:
                yield spans(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
            rows = table.num_rows - whole
        if rows:
            yield spans(pa.Table.from_batches(held))

    return apply


def _applied(length: int):
    """Unite the spans of each text (as first and last window) and cut them out."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py()
                spans: list[list[int]] = []
                for run in sorted(found.as_py() or [], key=lambda x: x["first"]):
                    begin, stop = run["first"], run["last"] + length
                    if spans and begin <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], stop)
                    else:
                        spans.append([begin, stop])
                at, kept = 0, []
                for begin, stop in spans:
                    kept.append(raw[at:begin])
                    at = stop
                kept.append(raw[at:])
                gone = sum(b - a for a, b in spans)
                made.append((len(raw), gone, [{"begin": a, "stop": b} for a, b in spans], b"".join(kept)))
            span = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), span, pa.binary()]
            columns = zip(*made, strict=True) if made else [[]] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = [batch.schema.names[0], "n_bytes", "n_removed", "spans", "kept"]
            yield pa.record_batch([batch.column(0), *arrays], names=names)

    return apply


def remove_repeated_strings(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: key, n_bytes, n_removed, spans (removed byte ranges), kept (the other bytes)."""
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    source = docs.select(F.col(id_col).alias("_key"), F.xxhash64(raw).alias("text_hash"), raw.alias("_text"))
    source = source.withColumn("_key", F.col("_key").cast("long"))
    key = T.StructType([source.schema["_key"]]).add("text_hash", "long")

    def typed(*names: str) -> T.StructType:
        schema = T.StructType(list(key.fields))
        for name in names:
            schema = schema.add(name, "long")
        return schema

    found = source.mapInArrow(_run_rows(length), typed("gram", "content", "back", "first", "last"))
    # One shuffle, by the anchor; spans known within a batch are dealt by their document.
    place = F.coalesce("gram", F.xxhash64("_key", "text_hash"))
    by = Window.partitionBy("place", "gram")
    inside = by.orderBy("content", F.col("_key").asc_nulls_first(), "text_hash", "first")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = (
        found.withColumn("place", place)
        .withColumn("previous", F.lag(F.struct("content", "_key", "text_hash", "first")).over(inside))
        .withColumn("distinct", F.first("content").over(whole) != F.last("content").over(whole))
        .withColumn("repeated", F.col("gram").isNull() | F.coalesce(F.col("previous.content") == F.col("content"), F.lit(False)))
        # The same run of the same document, from another row of it, is neither earlier nor a run more.
        .where(F.col("gram").isNull() | ~F.col("previous").eqNullSafe(F.struct("content", "_key", "text_hash", "first")))
        .where("repeated or distinct")
        .select("_key", "text_hash", "gram", "back", "first", "last", "repeated")
    )
    known = durable(known)

    # Anchors with different runs: their number of runs decides how they are dealt.
    open_ = known.where("not repeated")
    counts = open_.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(f"n > {FREQUENT}")
    counts = counts.withColumn("slices", F.least(F.ceil(F.col("n") / FREQUENT), F.lit(length)).cast("long"))
    dealt = open_.join(small(durable(counts.select("gram", "slices"))), "gram", "left")
    dealt = dealt.withColumn("slices", F.coalesce("slices", F.lit(1).cast("long")))
    slices = F.expr("filter(sequence(0L, slices - 1), s -> exists(sequence(back - (last - first), back), d -> d % slices = s))")
    dealt = dealt.withColumn("slice", F.explode(slices))
    wanted = F.struct("gram", "back", "first", "last", "slice", "slices")
    wanted = durable(dealt.groupBy("_key", "text_hash").agg(F.collect_list(wanted).alias("wanted")))

    def same(frame: DataFrame) -> Column:
        return source["_key"].eqNullSafe(frame["_k"]) & (source["text_hash"] == frame["_h"])

    def keyed(frame: DataFrame) -> DataFrame:
        return frame.withColumnRenamed("_key", "_k").withColumnRenamed("text_hash", "_h")

    def with_text(frame: DataFrame) -> DataFrame:
        # Only texts that are wanted are shuffled, as long as their keys are few enough to broadcast.
        return source.join(small(frame.select("_k", "_h")), same(frame), "left_semi").join(frame.hint("merge"), same(frame))

    texts = with_text(keyed(wanted)).dropDuplicates(["_key", "text_hash"]).select("_key", "text_hash", "_text", "wanted")
    schema = typed("gram", "back", "first", "last", "slice", "slices").add("context", "binary")
    contexts = texts.mapInArrow(_cut_contexts(length), schema)
    contexts = contexts.repartition("gram", "slice").sortWithinPartitions("gram", "slice")
    spans = contexts.mapInArrow(_compare(length), typed("first", "last"))
    spans = spans.unionByName(known.where("repeated").select("_key", "text_hash", "first", "last"))
    united = spans.groupBy("_key", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    united = keyed(durable(united))
    others = source.join(small(united.select("_k", "_h")), same(united), "left_anti")
    others = others.withColumn("runs", F.lit(None).cast(united.schema["runs"].dataType))
    columns = [F.col("_key").alias(id_col), "_text", "runs"]
    held = with_text(united).select(*columns).unionByName(others.select(*columns))
    span = T.ArrayType(T.StructType().add("begin", "long").add("stop", "long"))
    result = T.StructType([T.StructField(id_col, T.LongType())]).add("n_bytes", "long").add("n_removed", "long")
    return held.mapInArrow(_applied(length), result.add("spans", span).add("kept", "binary"))
