"""Mixing sources to target weights by blocks and multinomial draws, in DataFrame operations only.

The words of a source are laid end to end, in an order of documents that depends on their
keys alone, and packed into blocks of a fixed number of words. Source weights give targets,
which stop at a multiple of the source's size; what they leave goes to the others by weight
until none is above. The mix is a list of output shards of many slots. Per shard the whole
part of each source's expected count is fixed, and the slots that the fractions make up are
drawn multinomially from them, so that counts stay near their expectation with few blocks
as well. The n-th slot of a source is in pass n div blocks over its blocks, and takes the
block at which a pseudorandom permutation of that source and pass puts n mod blocks. Slots
beyond the last allowed pass stay empty. Blocks are joined by source and index, so a block
is taken at most once a pass.

Nothing is drawn from a generator with a state: hashes of numbers decide, sums are of whole
numbers, and reruns agree under any partitioning.

A source may hold most rows: places of documents come from range partitions of (source,
hash of the document) with the totals of the parts before them; slots are dealt by source
and shard. Joins are by block, of which none has more than its words. Only numbers about
all sources together reach the driver. The table of sources is broadcast after counting it.

Cases: NULL is a source of its own, the last one. A NULL or empty text, or one of white
space, has size 0 and is never taken. NULL keys and repeated rows are documents like others;
alike rows (source, key, size) are laid side by side, and may swap places. A table without
words has targets 0. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import durable, forget, looked_up, running, tasks_for

#: Words of a block, slots of a shard, and the least number of slots of a shard for each source.
BLOCK, SHARD, SHARE = 64, 1 << 16, 16
#: Weights of the sources in their order, repeating, and how often a source may be taken at most.
WEIGHTS, PASSES = (5, 2, 1), 3
#: Parts that a slot is counted in, rounds of a permutation, copies of a row laid by one task.
UNIT, ROUNDS, COPIES = 1 << 16, 16, 1024
SEED = 20_260


@dataclass(frozen=True)
class Mix:
    """sources: source, source_size, target, _s, _blocks; slots: shard, slot, _s, pass, index; documents: one row each."""

    sources: DataFrame
    slots: DataFrame
    documents: DataFrame


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and \\t to \\r; no list of words is made."""
    marks = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def water_level(sources: DataFrame, passes: int) -> float:
    """Words per weight of the sources that are not held back by their size."""
    sums = sources.agg(F.sum("_words"), F.sum("_weight")).first()
    total, weight = int(sums[0] or 0), int(sums[1] or 0)
    spare, shared = total, weight
    while total and shared:
        level = spare / shared
        full = sources.where(F.col("_words") * passes < F.lit(level) * F.col("_weight"))
        held = full.agg(F.sum(F.col("_words") * passes), F.sum("_weight")).first()
        now = total - int(held[0] or 0), weight - int(held[1] or 0)
        if now == (spare, shared):
            return level
        spare, shared = now
    return 0.0


def permuted(place: Column, count: Column, *keys: Column) -> Column:
    """Where a pseudorandom permutation of 0 .. count - 1, one for each value of the keys, puts a place.

    In each round a place and its mirror image about a random centre swap or not, as a bit of the
    pair decides; this maps any range onto itself.
    """
    rounds = F.transform(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        lambda r: F.struct(r.alias("round"), F.pmod(F.xxhash64(F.lit(SEED), r, *keys), count).alias("center")),
    )

    def swapped(x: Column, step: Column) -> Column:
        image = F.pmod(step["center"] - x, count)
        coin = F.xxhash64(F.lit(SEED + 1), step["round"], F.greatest(x, image), *keys)
        return F.when(coin.bitwiseAND(F.lit(1)) == 1, image).otherwise(x)

    return F.aggregate(rounds, place.cast("long"), swapped)


def targets(rows: DataFrame, weights: tuple[int, ...], passes: int, block: int) -> DataFrame:
    """Per source its number _s in code point order (NULL last), size, weight, target and blocks."""
    sums = rows.groupBy("_none", "_source").agg(F.sum(F.col("_size") * F.col("_copies")).alias("_words"))
    ranked = running(sums.withColumn("_one", F.lit(1).cast("long")), ["_none", "_source"], {"_s": "_one"})
    turn = F.array(*map(F.lit, weights))
    weighed = durable(ranked.withColumn("_weight", F.get(turn, (F.col("_s") % len(weights)).cast("int")).cast("long")))
    level = water_level(weighed, passes)
    most = (F.col("_words") * passes).cast("double")
    return weighed.withColumns(
        {
            "target": F.least(most, F.lit(level) * F.col("_weight")),
            "_blocks": F.expr(f"(_words + {block - 1}) div {block}"),
        }
    ).drop("_one")


def drawn_slots(sources: DataFrame, shard_slots: int, passes: int) -> DataFrame:
    """shard, slot (place in the shard), _s, _blocks and _n (number of the slot among those of its source)."""
    spark = sources.sparkSession
    expected = F.col("target") * F.col("_blocks") / F.greatest(F.col("_words"), F.lit(1))
    units = sources.withColumn("_units", F.round(expected * UNIT).cast("long"))
    known = units.agg(F.sum(F.col("_units").cast("decimal(38,0)")), F.count(F.lit(1))).first()
    slots, count = int(known[0] or 0) // UNIT, known[1]
    shards = max(1, slots // max(shard_slots, SHARE * count))
    units = units.withColumn("_fixed", F.expr(f"_units div {shards * UNIT}"))
    units = units.withColumn("_left", F.col("_units") - F.col("_fixed") * shards * UNIT)
    # Sources as ranges of [0, all); a number of slots drawn is where a hash falls.
    ranged = durable(running(units, ["_s"], {"_from": "_left", "_slot": "_fixed"}))
    sums = ranged.agg(F.sum("_left"), F.sum("_fixed")).first()
    span, fixed = int(sums[0] or 0), int(sums[1] or 0)
    draws = (span + UNIT // 2) // UNIT

    wide = max(tasks_for(sources), slots >> 20)
    every = ranged.where("_fixed > 0").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1))))
    every = every.repartition(wide, "_s", "shard").withColumn("_j", F.explode(F.expr("sequence(0L, _fixed - 1)")))
    found = every.select(
        "shard", (F.col("_slot") + F.col("_j")).alias("slot"), "_s", "_blocks", (F.col("shard") * F.col("_fixed") + F.col("_j")).alias("_n")
    )
    if draws:
        # Cells of equal width bound how many sources a draw is compared with.
        width = -(-span // max(1, count))
        cells = F.explode(F.expr(f"sequence(_from div {width}, (_from + _left - 1) div {width})"))
        ranges = ranged.where("_left > 0").withColumn("_cell", cells)
        drawn = spark.range(draws).select(
            F.col("id").alias("_draw"),
            F.expr(f"id * {shards} div {draws}").alias("shard"),
            F.pmod(F.xxhash64(F.lit(SEED + 2), "id"), F.lit(span)).alias("_at"),
        )
        drawn = drawn.withColumn("_cell", F.expr(f"_at div {width}")).join(ranges, "_cell")
        drawn = drawn.where("_at >= _from and _at < _from + _left").select("_draw", "shard", "_s", "_blocks", "_fixed")
        drawn = running(drawn.withColumn("_one", F.lit(1).cast("long")), ["_draw"], {"_rank": "_one"}, ("_s",))
        # The first draw of a shard is the smallest d with d * shards >= shard * draws.
        first = F.expr(f"(shard * {draws} + {shards - 1}) div {shards}")
        found = found.unionByName(
            drawn.select(
                "shard", (F.col("_draw") - first + fixed).alias("slot"), "_s", "_blocks",
                (F.col("_fixed") * shards + F.col("_rank")).alias("_n"),
            )
        )
    return found.where(F.col("_n") < F.col("_blocks") * passes)


def placed_documents(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per document: _s, _key, _size and _start, the words of its source before it."""
    numbered = looked_up(
        rows, sources.select("_none", "_source", "_s"), ["_none", "_source"], [F.col("_key"), F.col("_size")]
    )
    numbered = numbered.select(
        "_s", "_key", "_size", "_copies", F.xxhash64(F.lit(SEED + 3), "_key", "_size").alias("_order"),
        (F.col("_size") * F.col("_copies")).alias("_words"),
    )
    laid = durable(running(numbered, ["_order", "_key", "_size"], {"_first": "_words"}, ("_s",)))
    single = laid.where("_copies = 1").select("_s", "_key", "_size", F.col("_first").alias("_start"))
    lots = F.explode(F.expr(f"sequence(0L, (_copies - 1) div {COPIES})"))
    many = laid.where("_copies > 1").withColumn("_lot", lots).repartition(tasks_for(rows), "_s", "_key", "_size", "_lot")
    last = F.expr(f"least(_copies, (_lot + 1) * {COPIES}) - 1")
    many = many.withColumn("_copy", F.explode(F.sequence(F.expr(f"_lot * {COPIES}"), last)))
    return single.unionByName(
        many.select("_s", "_key", "_size", (F.col("_first") + F.col("_copy") * F.col("_size")).alias("_start"))
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    passes: int = PASSES,
    block: int = BLOCK,
    shard_slots: int = SHARD,
) -> Mix:
    """The sources with their targets, the slots of the mix, and per document how many of its words the mix takes.

    documents: the key, size, source_size, target, taken (words, repeats counted).
    """
    source = F.col(f"`{source_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_key"),
        source.isNull().alias("_none"),
        F.coalesce(source.cast("string"), F.lit("")).alias("_source"),
        word_count(F.col(f"`{text_col}`").cast("string")).alias("_size"),
    )
    rows = durable(rows.groupBy("_none", "_source", "_key", "_size").agg(F.count(F.lit(1)).alias("_copies")))
    sources = durable(targets(rows, weights, passes, block))
    turn, place = F.expr("_n div _blocks"), F.expr("_n % _blocks")
    slots = drawn_slots(sources, shard_slots, passes).select(
        "shard", "slot", "_s", turn.alias("pass"), permuted(place, F.col("_blocks"), F.col("_s"), turn).alias("index")
    )
    slots = durable(slots)
    times = slots.groupBy("_s", "index").agg(F.count(F.lit(1)).alias("_times"))
    placed = durable(placed_documents(rows, sources))
    forget(rows)
    end = F.col("_start") + F.col("_size")
    blocks = F.explode(F.expr(f"sequence(_start div {block}, (_start + _size - 1) div {block})"))
    pieces = placed.where("_size > 0").withColumn("index", blocks)
    words = F.least((F.col("index") + 1) * block, end) - F.greatest(F.col("index") * block, F.col("_start"))
    pieces = pieces.select("_s", "index", "_start", "_key", "_size", words.alias("_words"))
    taken = (
        pieces.join(times, ["_s", "index"], "left")
        .groupBy("_s", "_start", "_key", "_size")
        .agg(F.sum(F.col("_words") * F.coalesce("_times", F.lit(0))).cast("long").alias("taken"))
        .select("_s", "_key", "_size", "taken")
    )
    none = placed.where("_size = 0").select("_s", "_key", "_size", F.lit(0).cast("long").alias("taken"))
    shown = sources.select("_s", F.col("_words").alias("source_size"), "target")
    documents = looked_up(taken.unionByName(none), shown, ["_s"], [F.col("_key"), F.col("taken")])
    documents = documents.select(F.col("_key").alias(id_col), F.col("_size").alias("size"), "source_size", "target", "taken")
    named = F.when(~F.col("_none"), F.col("_source")).alias("source")
    return Mix(sources.select(named, F.col("_words").alias("source_size"), "target", "_s", "_blocks"), slots, documents)
