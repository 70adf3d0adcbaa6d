"""Repeated passages by content-defined chunks.

A gear rolling hash over the last WINDOW bytes cuts every text where the hash matches a mask,
so cuts depend on the bytes around them alone and an insertion moves only the cuts near it.
Chunks are compared by a 128-bit digest over the whole corpus. A chunk is repeated if it
occurs in a document with a smaller key or earlier in its own document. Runs of repeated
chunks of at least `least` bytes are removed; shorter ones are everyday phrases and stay.

A first pass counts the documents of each digest and their smallest key, with map-side
partial aggregates; only digests met in two documents go on. The chunks join them on the
digest (adaptive execution splits a digest that is everywhere), and the numbers of the
repeated chunks, bounded by a document's own length, are gathered per document and applied to
its text, which is cut once more in the same way. Only texts with such chunks are shuffled.

Cases: a NULL text is the empty text and has no chunks. Documents that share a key are told
apart by a hash of the text and not compared with each other; rows that repeat key and text are
one document and get the same answer. A NULL key comes before all others. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import bounded_batches, durable, small

#: Bytes the rolling hash sees (a power of two), least and greatest chunk, bits of the mask.
WINDOW, LEAST_CHUNK, GREATEST_CHUNK, MASK_BITS = 16, 20, 256, 4
#: Bytes of the shortest run of repeated chunks that is removed. A repeated passage of 250 bytes
#: holds whole chunks of so many bytes in nearly all cases; shared phrases are shorter.
LEAST_RUN = 96
#: Bytes hashed at once.
BLOCK = 1 << 20

_GEAR = np.random.default_rng(16).integers(0, 1 << 32, 256, dtype=np.uint32)
_MASK = np.uint32(((1 << MASK_BITS) - 1) << (WINDOW - 1))


def cut_points(raw: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    data = np.frombuffer(raw, np.uint8)
    ends: list[int] = []
    at = 0
    for start in range(0, len(data), BLOCK):
        before = min(start, WINDOW - 1)
        rolling = _GEAR[data[start - before : start + BLOCK]]
        width = 1
        while width < WINDOW:  # the hash over 2 * width bytes from two over width bytes
            wider = rolling.copy()
            wider[width:] += rolling[:-width] << np.uint32(width)
            rolling, width = wider, width * 2
        matches = np.flatnonzero((rolling[before:] & _MASK) == 0) + (start + 1)
        for end in matches.tolist():
            while end - at > GREATEST_CHUNK:
                at += GREATEST_CHUNK
                ends.append(at)
            if end - at >= LEAST_CHUNK:
                at = end
                ends.append(at)
    while len(data) - at > GREATEST_CHUNK:
        at += GREATEST_CHUNK
        ends.append(at)
    if at < len(data):
        ends.append(len(data))
    return ends


def chunk_digests(raw: bytes, ends: list[int]) -> list[bytes]:
    held = memoryview(raw)
    return [xxhash.xxh3_128_digest(held[a:b]) for a, b in zip([0, *ends], ends)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for the first of each distinct chunk of a document: digest, key, text hash and number in one."""
    for batch in batches:
        rows, numbers, digests = [], [], []
        for row, text in enumerate(batch.column(2)):
            raw = text.as_py()
            first: dict[bytes, int] = {}
            for number, digest in enumerate(chunk_digests(raw, cut_points(raw))):
                first.setdefault(digest, number)
            rows += [row] * len(first)
            numbers += first.values()
            digests += first
        held = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        taken = pa.array(rows, pa.int64())
        places = batch.column(1).to_numpy()[rows] << 32 | np.array(numbers, np.int64) if rows else np.zeros(0, np.int64)
        columns = [pa.array(held[:, 0]), pa.array(held[:, 1]), batch.column(0).take(taken), pa.array(places)]
        yield pa.record_batch(columns, names=["d0", "d1", batch.schema.names[0], "place"])


def removed_spans(ends: list[int], digests: list[bytes], repeated: set[int], least: int) -> list[tuple[int, int]]:
    """Runs of repeated chunks, by number or as later copies within the text, of at least `least` bytes."""
    spans, seen, start, at = [], set(), None, 0
    first: dict[bytes, int] = {}
    for number, (end, digest) in enumerate(zip(ends, digests, strict=True)):
        again = digest in seen or first.setdefault(digest, number) in repeated
        seen.add(digest)
        if again and start is None:
            start = at
        if not again and start is not None:
            spans.append((start, at))
            start = None
        at = end
    if start is not None:
        spans.append((start, at))
    return [(a, b) for a, b in spans if b - a >= least]


def _applied(least: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py()
                ends = cut_points(raw)
                repeated = {place & 0xFFFFFFFF for place in found.as_py() or []}
                spans = removed_spans(ends, chunk_digests(raw, ends), repeated, least)
                at, kept = 0, []
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                spans = [{"begin": a, "stop": b} for a, b in spans]
                gone = sum(x["stop"] - x["begin"] for x in spans)
                made.append((len(raw), len(ends), len(repeated), gone, spans, b"".join(kept)))
            kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())])), pa.binary()]
            columns = zip(*made, strict=True) if made else [[]] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["n_bytes", "n_chunks", "n_repeated", "n_removed", "spans", "kept"]
            yield pa.record_batch([batch.column(0), *arrays], names=[batch.schema.names[0], *names])

    return apply


def remove_repeats(
    docs: DataFrame, least: int = LEAST_RUN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: key, n_bytes, n_chunks, n_repeated (distinct chunks of earlier documents), n_removed, spans, kept.

    `spans` are the removed byte ranges, `kept` the remaining bytes.
    """
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    source = bounded_batches(docs).select(id_col, F.pmod(F.xxhash64(raw), F.lit(1 << 31)).alias("text_hash"), raw.alias("_text"))
    schema = T.StructType().add("d0", "long").add("d1", "long").add(source.schema[0]).add("place", "long")
    chunks = source.mapInArrow(_chunks, schema)
    # NULL keys count as the smallest, so that aggregates need one number.
    order = F.coalesce(F.col(id_col), F.lit(-(1 << 63)).cast("long"))
    counted = chunks.groupBy("d0", "d1").agg(F.min(order).alias("least"), F.max(order).alias("most"))
    counted = durable(counted.where("least < most").drop("most"))
    found = chunks.join(counted.hint("merge"), ["d0", "d1"]).where(order > F.col("least"))
    found = found.select(F.col(id_col).alias("_key"), F.shiftright("place", 32).alias("_hash"), "place").distinct()
    found = durable(found.groupBy("_key", "_hash").agg(F.collect_list("place").alias("places")))
    same = source[id_col].eqNullSafe(F.col("_key")) & (source["text_hash"] == F.col("_hash"))
    touched = small(found.select("_key", "_hash"))
    among = source.join(touched, same, "left_semi").join(found.hint("merge"), same)
    others = source.join(touched, same, "left_anti").withColumn("places", F.lit(None).cast("array<bigint>"))
    held = among.select(id_col, "_text", "places").unionByName(others.select(id_col, "_text", "places"))
    span = T.ArrayType(T.StructType().add("begin", "long").add("stop", "long"))
    result = T.StructType([source.schema[0]])
    for name in ("n_bytes", "n_chunks", "n_repeated", "n_removed"):
        result = result.add(name, "long")
    return held.mapInArrow(_applied(least), result.add("spans", span).add("kept", "binary"))
