"""Mixing against loops over whole texts, and what must hold for any draw."""

import re
from collections import Counter, defaultdict

import pytest
from fixtures import frame, odd_rows, plain  # noqa: F401
from pyspark.sql import functions as F

from plumbline.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), passes=3):
    """Targets by sharing the excess again until no source is above its limit."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    found, spare = {n: 0.0 for n in names}, float(sum(sizes.values()))
    while spare > 1e-9:
        room = [n for n in names if found[n] < passes * sizes[n]]
        share = spare / sum(weight[n] for n in room)
        spare = 0.0
        for n in room:
            found[n] += share * weight[n]
            if found[n] > passes * sizes[n]:
                spare += found[n] - passes * sizes[n]
                found[n] = float(passes * sizes[n])
    return found


def documents(count=400, seed=1):
    """Texts of 0 to 300 words, half of them of one source, one source that its weight asks too much of."""
    import random

    rng = random.Random(seed)
    rows = []
    for key in range(count):
        source = "big" if rng.random() < 0.5 else rng.choice(["a", "b", "é", "😀", None])
        rows.append((key, " \n".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 300))), source))
    return [*rows, (count, "few words here", "A"), (count + 1, " \t ", "Z"), (count + 2, None, "Z")]


def table_of(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)


@pytest.mark.parametrize("shard_slots", [1, 1 << 16])
def test_taken_words_are_those_of_the_blocks_that_slots_name(spark, shard_slots):
    rows = documents()
    made = mixing.mix(table_of(spark, rows), block=16, shard_slots=shard_slots)
    slots, sources = made.slots.collect(), {r["_s"]: r for r in made.sources.collect()}
    number = {r["source"]: s for s, r in sources.items()}
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    wanted = plain_targets(sizes)
    assert {r["source"]: r["source_size"] for r in sources.values()} == dict(sizes)
    assert {r["source"]: pytest.approx(r["target"]) for r in sources.values()} == wanted
    # Each block at most once a pass, and all numbers in range.
    assert len({(r["_s"], r["pass"], r["index"]) for r in slots}) == len(slots)
    assert all(0 <= r["pass"] < 3 and 0 <= r["index"] < sources[r["_s"]]["_blocks"] for r in slots)
    assert (len({r["shard"] for r in slots}) > 5) == (shard_slots == 1)
    assert len({(r["shard"], r["slot"]) for r in slots}) == len(slots)
    # Lay the words end to end and count them block by block.
    order = {
        r["doc_id"]: (r["o"], r["doc_id"])
        for r in table_of(spark, rows).select(
            "doc_id", F.xxhash64(F.lit(mixing.SEED + 3), "doc_id", mixing.word_count(F.col("text"))).alias("o")
        ).collect()
    }
    times, laid, taken = Counter((r["_s"], r["index"]) for r in slots), defaultdict(int), Counter()
    for key, text, source in sorted(rows, key=lambda r: order[r[0]]):
        for _ in WORD.findall(text or ""):
            taken[key] += times[number[source], laid[source] // 16]
            laid[source] += 1
    found = {r["doc_id"]: r for r in made.documents.collect()}
    assert {k: r["taken"] for k, r in found.items()} == {key: taken[key] for key, _, _ in rows}
    assert all(r["taken"] <= 3 * r["size"] for r in found.values())
    by_source = Counter()
    for key, _, source in rows:
        by_source[source] += found[key]["taken"]
    for name, target in wanted.items():
        assert abs(by_source[name] - target) <= 16 * (3 if shard_slots > 1 else 20) + 0.02 * target


def test_reruns_agree_under_any_partitioning(spark):
    rows = documents(150, 2)
    first, second = (
        sorted(map(tuple, mixing.mix(table_of(spark, rows, parts), block=8).documents.collect())) for parts in (1, 7)
    )
    assert first == second


@pytest.mark.parametrize("count", [1, 2, 3, 64, 1000])
def test_a_permutation_hits_every_place_once(spark, count):
    place = mixing.permuted(F.col("id"), F.lit(count).cast("long"), F.col("k"))
    found = spark.range(count).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("p", place)
    rows = found.groupBy("k").agg(F.collect_list("p").alias("p"), F.sum((F.col("p") == F.col("id")).cast("int")).alias("same"))
    for row in rows.collect():
        assert sorted(row["p"]) == list(range(count))
        assert count < 1000 or row["same"] < 20


def test_odd_rows(spark):
    rows = odd_rows()
    found = mixing.mix(frame(spark, rows)).documents
    sizes = Counter(len(WORD.findall(r[1] or "")) for r in rows)
    got = found.collect()
    assert Counter(r["size"] for r in got) == sizes
    assert sorted(map(repr, (r["doc_id"] for r in got))) == sorted(map(repr, (r[0] for r in rows)))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert found.columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_many_equal_rows_are_laid_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 4)
    rows = [(None, "a b c", "x")] * 30 + [(1, "d", "x")] * 3 + [(2, "e f", "y")]
    got = mixing.mix(table_of(spark, rows), block=2).documents.collect()
    assert len(got) == 34
    assert sum(r["taken"] for r in got) == pytest.approx(95, abs=12)
    assert all(r["source_size"] == (2 if r["doc_id"] == 2 else 93) for r in got)


def test_empty_table_and_table_without_words(spark):
    assert mixing.mix(table_of(spark, [])).documents.collect() == []
    got = mixing.mix(table_of(spark, [(1, "", "a"), (2, None, None)])).documents.collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
