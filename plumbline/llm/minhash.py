"""Near duplicates by MinHash: banding, signature check, confirmation, connected components.

1. A map gives each document the set of its word shingles as 64-bit hashes and from it the
   set's size and digest, `BANDS * ROWS` minima under universal hash functions, a key per
   band of minima, and a signature of one byte per minimum.
2. Documents with the same set are one class; what follows is about classes, so a group of
   copies of any size is one.
3. Classes that share a band key are a bucket. Every member is compared with the bucket's
   pivot, the member that meets most others: sizes and signatures first, then the full sets,
   taken anew from the whole texts. Confirmed links give components (large-star, small-star).
4. Buckets whose members are not yet in one component are searched in full: members are
   dealt into blocks, and pairs of blocks compare signatures. The texts of members that have a
   pair left come to the blocks they are needed in, and pairs are confirmed there, so rows are
   members and links, never pairs. Nothing is capped; a pair is met in the first bucket it
   shares, and not at all if its members are in one component, as in a large group of near
   copies they are after step 3.

At similarity 0.8 a pair shares none of 40 bands of 5 with probability 1.3e-7, and an
estimate from 200 minima falls below `0.8 - MARGIN` with probability about 1e-9.

Cases: a document without words (or with NULL text) has the empty set and no links; with
fewer words than a shingle the whole sequence is its one shingle. Of a component the
document with the smallest key stays; NULL keys come last and the text's hash breaks ties.
Rows that repeat key and text are one document and share its answer. An empty table gives no
rows. Other columns are passed through by `keep_first` and are otherwise not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import bounded_batches, durable, forget, hot_join, small, unused
from plumbline.llm.components import components

BANDS, ROWS = 40, 5
#: An estimated similarity may fall short of the wanted one by so much before a pair is dismissed.
MARGIN = 0.17
#: Members of a block in a bucket searched in full.
BLOCK = 512

_U = np.uint64
_RNG = np.random.default_rng(20)
_A = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=_U) * _U(2) + _U(1)
_B = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=_U)
_C = _RNG.integers(0, 1 << 63, ROWS, dtype=_U) * _U(2) + _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of a well-known generator)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; A-Z are lowered."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, _U)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), _U, len(found))
    width = min(words, len(found))
    # A sequence shorter than a shingle starts from its own seed.
    mixed = np.full(len(found) - width + 1, width, _U)
    for k in range(width):
        mixed = _mixed(mixed + hashes[k : len(found) - width + 1 + k])
    return np.unique(mixed)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash function over a set that is not empty."""
    least = np.full(len(_A), np.iinfo(_U).max, _U)
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[at : at + 512, None] * _A + _B).min(axis=0), out=least)
    return least


def _sketch(words: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.arange(BANDS, dtype=_U)
        for batch in batches:
            sizes, digests, bands, signatures = [], [], [], []
            for text in batch.column(2):
                shingles = shingle_set(text.as_py(), words)
                sizes.append(len(shingles))
                if not len(shingles):
                    digests.append(None), bands.append(None), signatures.append(None)
                    continue
                least = minima(shingles)
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                keys = _mixed((_mixed(least.reshape(BANDS, ROWS)) * _C).sum(axis=1, dtype=_U) + numbers)
                bands.append(keys.view(np.int64))
                signatures.append((_mixed(least) >> _U(56)).astype(np.uint8).tobytes())
            made = [
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(signatures, pa.binary()),
            ]
            names = [*batch.schema.names[:2], "n", "digest", "bands", "signature"]
            yield pa.record_batch([*batch.columns[:2], *made], names=names)

    return apply


def _alike(n_a, n_b, percent: int):
    """Sizes that allow the similarity."""
    return 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity estimated from one-byte minima, of which 1 in 256 agree by chance."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def _check_signatures(percent: int):
    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pairs in batches:
            if len(pairs):
                good = _alike(pairs["n_a"].to_numpy(), pairs["n_b"].to_numpy(), percent)
                good &= _estimate(_signatures(pairs["s_a"]), _signatures(pairs["s_b"])) >= percent / 100 - MARGIN
                yield pairs.loc[good, ["a", "b"]]

    return apply


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of rows that come sorted by bucket, low and high."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = (pa.concat_tables([held, table]) if held is not None else table).combine_chunks()
        if not table.num_rows:
            continue
        keys = [table.column(name).to_numpy() for name in ("bucket", "low", "high")]
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        for start, stop in zip(starts, starts[1:]):
            yield table.slice(start, stop - start)
        held = table.slice(starts[-1])
    if held is not None:
        yield held


def _near_pairs(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a bucket's two blocks (or one) that are still to be confirmed, likeliest first.

    They are in different components, alike by size and signature, not tested with the
    bucket's pivot, and share no band before this bucket's, where they are met as well.
    """
    cls, comps, n, side = (group.column(c).to_numpy() for c in ("cls", "component", "n", "side"))
    low, high, bucket = (group.column(c)[0].as_py() for c in ("low", "high", "bucket"))
    pivot = cls == group.column("pivot")[0].as_py()
    signatures = _signatures(group.column("signature").to_pylist())
    bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(cls), BANDS)
    second = np.flatnonzero((side == high) & ~pivot)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in np.flatnonzero((side == low) & ~pivot):
        good = (comps[second] != comps[i]) & _alike(n[second], n[i], percent)
        if low == high:
            good &= second > i
        others = second[good]
        if not len(others):
            continue
        alike = _estimate(signatures[others], signatures[i])
        others, alike = others[alike >= percent / 100 - MARGIN], alike[alike >= percent / 100 - MARGIN]
        if len(others):
            shared = bands[others] == bands[i]
            here = bands[i][shared.argmax(axis=1)] == bucket
            found.append((np.full(here.sum(), i), others[here], alike[here]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    first, second, alike = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(-alike, kind="stable")
    return first[order], second[order]


def _members_to_confirm(percent: int):
    """The members of each group that have a pair to be confirmed."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            places = np.unique(np.concatenate(_near_pairs(group, percent)))
            if len(places):
                yield group.take(pa.array(places)).combine_chunks().to_batches()[0]

    return apply


def _confirmed_in_groups(words: int, percent: int):
    """Links of each group, confirmed on full sets; pairs that earlier links have joined are left out."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            cls, comps = group.column("cls").to_numpy(), group.column("component").to_numpy().copy()
            texts, sets, links = group.column("text"), {}, []
            for i, j in zip(*(x.tolist() for x in _near_pairs(group, percent)), strict=True):
                if comps[i] == comps[j]:
                    continue
                for k in (i, j):
                    if k not in sets:
                        sets[k] = shingle_set(texts[k].as_py(), words)
                if _similar(sets[i], sets[j], percent):
                    links.append((int(cls[i]), int(cls[j])))
                    comps[comps == comps[j]] = comps[i]
            if links:
                a, b = zip(*links, strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return apply


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on two sets of distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    places = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[places] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm_sets(words: int, percent: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, held, known = [], None, None
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                text = b.as_py()
                if known is None or text != held:
                    held, known = text, shingle_set(text, words)
                own = shingle_set(a.as_py(), words)
                good.append(_similar(own, known, percent))
            yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return apply


def _text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _texts(needed: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``cls, text``: the whole text of the first document of each needed class, as a table."""
    wanted = durable(classes.join(needed.select("cls").distinct(), "cls", "left_semi").select("cls", "first"))
    texts = docs.select(F.col(id_col).alias("key"), _text_hash(text_col).alias("hash"), F.col(text_col).alias("text"))
    same = F.col("key").eqNullSafe(F.col("first.key")) & (F.col("hash") == F.col("first.text_hash"))
    held = durable(texts.join(small(wanted), same).select("cls", "text").dropDuplicates(["cls"]))
    forget(wanted)
    return held


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: key, text_hash, n_shingles, component_id (smallest key reachable), kept (one of each component)."""
    source = bounded_batches(docs).select(id_col, _text_hash(text_col).alias("text_hash"), F.col(text_col).alias("_text"))
    schema = T.StructType([source.schema[0]]).add("text_hash", "long").add("n", "long").add("digest", "binary")
    schema = schema.add("bands", T.ArrayType(T.LongType())).add("signature", "binary")
    rows = durable(source.mapInArrow(_sketch(words), schema))

    first = F.struct(F.col(id_col).isNull().alias("no_key"), F.col(id_col).alias("key"), F.col("text_hash"))
    classes = rows.where("n > 0").groupBy("digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = durable(classes.withColumn("cls", F.monotonically_increasing_id()))
    own = rows.where("n > 0").withColumn("first", first).select("digest", "first", "n", "bands", "signature")
    lead = classes.select("cls", F.col("digest").alias("d"), F.col("first").alias("f"))
    match = (F.col("digest") == F.col("d")) & F.col("first.key").eqNullSafe(F.col("f.key"))
    match &= F.col("first.text_hash") == F.col("f.text_hash")
    leads = durable(own.join(lead, match).select("cls", "n", "bands", "signature").dropDuplicates(["cls"]))

    # Buckets: members of each band key and their number. The pivot is the member that meets most
    # others in all its buckets: the text that near copies were made from rather than one of them.
    members = leads.select("cls", F.explode("bands").alias("bucket"))
    buckets = durable(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    met = durable(hot_join(members, buckets, ["bucket"], [F.col("cls")]))
    weights = met.groupBy("cls").agg(F.sum("size").alias("weight"))
    place = F.struct("weight", F.xxhash64("cls").alias("order"), "cls")
    pivots = met.join(weights, "cls").groupBy("bucket").agg(F.max(place)["cls"].alias("pivot"))
    members = durable(hot_join(met, pivots, ["bucket"], [F.col("cls")]))
    forget(buckets, met)

    sketch = leads.select("cls", "n", "signature")

    def side(name: str) -> DataFrame:
        return sketch.select(F.col("cls").alias(name), F.col("n").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}"))

    stars = members.where("cls <> pivot").select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = stars.join(side("a"), "a").join(side("b"), "b")
    near = durable(stars.mapInPandas(_check_signatures(percent), "a long, b long"))
    held = _texts(near.select(F.explode(F.array("a", "b")).alias("cls")), docs, classes, id_col, text_col)
    both = near.join(held.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(held.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.select("a", "b", "text_a", "text_b")
    links = durable(both.mapInArrow(_confirm_sets(words, percent), "a long, b long"))
    forget(held, near)
    joined = components(links)

    # Buckets of three or more whose members the pivots did not bring together.
    root = joined.select(F.col("a").alias("cls"), F.col("b").alias("root"))
    more = members.where("size > 2").join(root, "cls", "left")
    more = durable(more.select("bucket", "cls", "size", "pivot", F.coalesce("root", "cls").alias("component")))
    mixed = more.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    open_ = hot_join(more, mixed.select("bucket"), ["bucket"], [F.col("cls")]).join(leads, "cls")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    open_ = open_.withColumn("side", F.pmod(F.xxhash64("cls", F.lit(1)), blocks).cast("int"))
    others = F.explode(F.sequence(F.lit(0), blocks - 1))
    open_ = open_.withColumn("other", others).withColumns(
        {"low": F.least("side", "other"), "high": F.greatest("side", "other")}
    )
    group = ["bucket", "low", "high"]
    open_ = open_.select(*group, "side", "pivot", "cls", "component", "n", "signature", "bands")
    open_ = open_.repartition(*group).sortWithinPartitions(*group, "cls")
    due = durable(open_.mapInArrow(_members_to_confirm(percent), open_.schema))
    if not due.isEmpty():
        held = _texts(due, docs, classes, id_col, text_col)
        due_texts = due.join(held, "cls").repartition(*group).sortWithinPartitions(*group, "cls")
        further = durable(due_texts.mapInArrow(_confirmed_in_groups(words, percent), "a long, b long"))
        forget(held)
        if not further.isEmpty():
            joined = components(joined.unionByName(further))
    forget(due, more, members)

    # The first document of each component, then of each class that has more than one document.
    root = joined.select(F.col("a").alias("cls"), F.col("b").alias("root"))
    linked = joined.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    placed = durable(
        classes.join(linked.withColumn("linked", F.lit(True)), "cls", "left")
        .where("copies > 1 or linked")
        .join(root, "cls", "left")
        .select("digest", "first", F.coalesce("root", "cls").alias("root"))
    )
    firsts = placed.groupBy("root").agg(F.min("first").alias("lead"))
    placed = hot_join(placed.drop("first"), firsts, ["root"], [F.col("digest")]).select("digest", "lead")
    narrow = rows.select(id_col, "text_hash", "n", "digest", F.coalesce("digest", F.lit(b"")).alias("class"))
    by_class = placed.withColumnRenamed("digest", "class")
    found = hot_join(narrow, by_class, ["class"], [F.col(id_col), F.col("text_hash")], "left")
    component = F.when(F.col("lead").isNull(), F.col(id_col)).otherwise(F.col("lead.key"))
    leads_it = F.col(id_col).eqNullSafe(F.col("lead.key")) & (F.col("text_hash") == F.col("lead.text_hash"))
    return found.select(
        id_col,
        "text_hash",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("lead").isNull() | leads_it).alias("kept"),
    )


def keep_first(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that stay, all columns unchanged: one document of each component."""
    key, text = unused(docs.columns, "_gone", "_hash")
    gone = durable(
        near_duplicates(docs, words, percent, id_col, text_col)
        .where("not kept")
        .select(F.col(id_col).alias(key), F.col("text_hash").alias(text))
    )
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & (_text_hash(text_col) == F.col(text))
    return docs.join(small(gone), same, "left_anti")
