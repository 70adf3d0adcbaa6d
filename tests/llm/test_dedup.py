"""Exact, near, suffix and chunk duplicates against plain programs."""

import hashlib
import re

import numpy as np
import pytest
from fixtures import empty, frame, odd, odd_rows, plain  # noqa: F401
from pyspark.sql import functions as F

from plumbline.llm import chunk_dedup, common, exact_dedup, minhash, suffix_dedup
from plumbline.llm.components import components
from plumbline.llm.suffix_order import deep_shallow


def sf_texts(sf_dir):
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()


# Exact


def test_exact_groups_and_digests(odd):
    rows = [(r[0], r[1] or "") for r in odd_rows()]
    found = exact_dedup.mark_copies(odd).collect()
    groups = {}
    for key, text in rows:
        groups.setdefault(text, []).append(key)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): keys for t, keys in groups.items()}
    assert len(found) == len(rows)
    for r in found:
        keys = by_sha[r["text_sha256"]]
        known = [k for k in keys if k is not None]
        assert r["group_size"] == len(keys)
        assert r["keep_id"] == (max(known) if known else None)
    for sha, keys in by_sha.items():
        assert sum(r["kept"] for r in found if r["text_sha256"] == sha) == 1, keys


def test_exact_keeps_one_whole_row(odd):
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in odd_rows()})
    # The row that stays of a group with a NULL text keeps its own text: the largest key, 5, is not empty.
    assert {r["doc_id"]: r["text"] for r in kept.collect()}[4] == ""


def test_exact_long_texts_that_part_late(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FIRST", 2)
    monkeypatch.setattr(exact_dedup, "GROWTH", 2)
    monkeypatch.setattr(exact_dedup, "WIDEST", 16)
    long = "a" * 300
    texts = [(1, long + "b"), (2, long + "c"), (3, long + "b"), (4, "a" * 301), (5, "a"), (6, "a"), (7, "ab")]
    found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.mark_copies(plain(spark, texts)).collect()}
    assert found == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1), 5: (6, 2), 6: (6, 2), 7: (7, 1)}


# Near


def shingles(text, size):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def brute_components(texts, size):
    sets = {k: shingles(t, size) for k, t in texts}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {k: (len(sets[k]), root(k)) for k in keys}


@pytest.mark.parametrize("size", [2, 5])
def test_near_components_match_brute_force(spark, sf_dir, size):
    texts = sf_texts(sf_dir)
    found = minhash.near_duplicates(plain(spark, texts), words=size).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(texts, size)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_group_without_a_common_pivot(spark, monkeypatch):
    # A chain: neighbours are similar, ends are not; small blocks and shuffles instead of broadcasts.
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    base = [f"w{i}" for i in range(300)]
    chain = [" ".join(f"n{i}" if i < 9 * k else w for i, w in enumerate(base)) for k in range(25)]
    texts = list(enumerate(chain))
    found = minhash.near_duplicates(plain(spark, texts), words=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(texts, 2)


def test_near_odd_cases(odd):
    found = minhash.near_duplicates(odd, words=2).collect()
    assert len(found) == len(odd_rows())
    by_key = {r["doc_id"]: r for r in found if r["doc_id"] not in (None, 16, 17)}
    assert by_key[3]["n_shingles"] == by_key[4]["n_shingles"] == by_key[5]["n_shingles"] == 0
    assert by_key[4]["component_id"] == 4 and by_key[5]["kept"]
    assert by_key[6]["n_shingles"] == 1 and by_key[7]["component_id"] == 6 and not by_key[7]["kept"]
    assert by_key[2]["component_id"] == 0 and by_key[1]["component_id"] == 0
    assert all(not r["kept"] and r["component_id"] == 0 for r in found if r["doc_id"] == 16)
    kept = minhash.keep_first(odd, words=2)
    assert kept.columns == odd.columns
    assert sum((r["text"] or "").startswith(odd_rows()[0][1][:40]) for r in kept.collect()) == 1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 180)] + [(500, 501), (501, 500), (7, 7)]
    found = {r["a"]: r["b"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 61)} | {x: 100 for x in range(101, 180)} | {501: 500}
    assert found == want


# Strings of a fixed length


def brute_repeats(texts, length):
    seen, found = set(), {}
    for key, text in sorted(texts, key=lambda x: x[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        found[key] = (sum(gone), bytes(b for b, x in zip(raw, gone, strict=True) if not x))
    return found


def test_repeated_strings_match_brute_force(spark, sf_dir):
    texts = sf_texts(sf_dir)
    found = suffix_dedup.remove_repeated_strings(plain(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_removed"], bytes(r["kept"])) for r in found} == brute_repeats(texts, 100)


@pytest.mark.parametrize("parts", [1, 7])
def test_rows_that_repeat_key_and_text_are_one_document(spark, parts):
    rng = np.random.default_rng(3)

    def text(size):
        return "".join(rng.choice(list("abcdefgh "), size))

    shared, alone = text(300), text(400)
    # Twice under one key and nowhere else; with a repeat in itself, an earlier document's passage, runs that
    # share anchors but not all bytes; a NULL key; the least key beside it.
    lone = [(5, alone), (6, shared + text(50) + alone[:200]), (7, text(80) + shared + text(70) + shared), (8, text(30) + shared[40:])]
    lone += [(9, text(150)), (-(1 << 63), text(500))]
    docs = plain(spark, (lone + [(None, text(250))]) * 3)
    found = suffix_dedup.remove_repeated_strings(docs.repartition(parts)).collect()
    assert len(found) == 3 * (len(lone) + 1)
    want = brute_repeats(lone, 100) | {None: (0, docs.where("doc_id is null").first()["text"].encode())}
    assert all((r["n_removed"], bytes(r["kept"])) == want[r["doc_id"]] for r in found)
    assert want[5][0] == want[9][0] == 0 and want[6][0] == 200 and want[7][0] == 600


def test_repeated_strings_of_frequent_anchors(spark, monkeypatch):
    # Periodic and nearly equal texts; anchors are dealt by distance, contexts sorted a few at a time.
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 3)
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 5)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rng = np.random.default_rng(3)
    common_part = "".join(rng.choice(list("abcd "), 70))
    texts = [(i, "".join(rng.choice(list("ab"), i % 40)) + common_part + "".join(rng.choice(list("ab"), 60))) for i in range(60)]
    texts += [(100, "ab" * 150), (101, "ab" * 90 + "c" + "ab" * 90), (102, "z" * 250), (103, "z" * 120), (104, None)]
    found = suffix_dedup.remove_repeated_strings(plain(spark, texts), 80).collect()
    assert {r["doc_id"]: (r["n_removed"], bytes(r["kept"])) for r in found} == brute_repeats(texts, 80)


def test_deep_shallow_order_and_common_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(60):
        count, width = int(rng.integers(1, 50)), int(rng.integers(1, 70))
        rows = rng.integers(0, 3, (4, width)).astype(np.uint8)[rng.integers(0, 4, count)].copy()
        for _ in range(20):
            rows[rng.integers(0, count), rng.integers(0, width)] = rng.integers(0, 256)
        order, shared = deep_shallow(rows)
        texts = [rows[i].tobytes() for i in order]
        assert texts == sorted(r.tobytes() for r in rows) and sorted(order) == list(range(count))
        for k in range(1, count):
            alike = [a == b for a, b in zip(texts[k], texts[k - 1], strict=True)]
            assert shared[k] == (alike.index(False) if False in alike else width)


# Chunks


def brute_chunks(texts, least):
    seen, found = {}, {}
    for key, text in sorted(texts, key=lambda x: x[0]):
        raw = (text or "").encode()
        ends = chunk_dedup.cut_points(raw)
        parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
        assert b"".join(parts) == raw
        repeated, own = [], set()
        for part in parts:
            repeated.append(part in seen or part in own)
            own.add(part)
        spans, at = [], 0
        for part, again in zip(parts, repeated, strict=True):
            if again and spans and spans[-1][1] == at:
                spans[-1][1] += len(part)
            elif again:
                spans.append([at, at + len(part)])
            at += len(part)
        spans = [(a, b) for a, b in spans if b - a >= least]
        seen.update(dict.fromkeys(own, key))
        found[key] = (len(ends), spans)
    return found


def test_chunks_match_brute_force(spark, sf_dir, monkeypatch):
    texts = sf_texts(sf_dir)
    want = brute_chunks(texts, 96)
    for bound in (common.BROADCAST_ROWS, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", bound)
        found = chunk_dedup.remove_repeats(plain(spark, texts)).collect()
        assert {r["doc_id"]: (r["n_chunks"], [tuple(s) for s in r["spans"]]) for r in found} == want


def test_chunks_resist_insertions():
    rng = np.random.default_rng(5)
    text = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    moved = b"inserted" + text[:7000] + b"!" + text[7000:]

    def parts(raw):
        ends = chunk_dedup.cut_points(raw)
        return {raw[a:b] for a, b in zip([0, *ends], ends)}

    assert len(parts(text) - parts(moved)) <= 6


def test_chunks_of_blocks_and_of_runs(monkeypatch):
    rng = np.random.default_rng(6)
    text = bytes(rng.integers(97, 123, 5000).astype(np.uint8)) + b"x" * 3000
    whole = chunk_dedup.cut_points(text)
    monkeypatch.setattr(chunk_dedup, "BLOCK", 100)
    assert chunk_dedup.cut_points(text) == whole
    sizes = np.diff([0, *whole])
    assert sizes[:-1].min() >= chunk_dedup.LEAST_CHUNK and sizes.max() <= chunk_dedup.GREATEST_CHUNK


def test_repeated_passages_are_caught_and_others_left(odd):
    for found in (suffix_dedup.remove_repeated_strings(odd), chunk_dedup.remove_repeats(odd)):
        rows = found.collect()
        assert len(rows) == len(odd_rows())
        removed = {r["doc_id"]: r["n_removed"] for r in rows if r["doc_id"] is not None}
        # Keys 10 and 18 repeat the passage of 9; the NULL key comes first, so 0 repeats it.
        assert removed[10] > 200 and removed[18] > 200 and removed[0] > 300 and removed[16] > 300
        assert not any(removed[k] for k in (3, 4, 5, 6, 7, 8, 9, 11, 14, 15, 19))


# Hot groups and empty tables


def test_many_copies_of_one_text(spark):
    text = "the same words again and again " * 8
    rows = [(i, text, "en", "s", 1, *["?"] * 12) for i in range(3000)] + [(9000 + i, f"{text} {i}", "en", "s", 1, *["?"] * 12) for i in range(50)]
    docs = frame(spark, rows)
    assert exact_dedup.keep_one(docs).count() == 51
    assert minhash.keep_first(docs, words=2).count() == 1
    kept = suffix_dedup.remove_repeated_strings(docs).where("n_removed = 0").collect()
    assert len(kept) == 0 or kept[0]["doc_id"] == 0
    assert chunk_dedup.remove_repeats(docs).where(F.col("doc_id") > 0).agg(F.min("n_removed")).first()[0] > 100


def test_empty_tables(empty):
    assert exact_dedup.mark_copies(empty).count() == exact_dedup.keep_one(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == minhash.keep_first(empty).count() == 0
    assert suffix_dedup.remove_repeated_strings(empty).count() == chunk_dedup.remove_repeats(empty).count() == 0
