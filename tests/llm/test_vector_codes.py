"""Vector codes against plain loops over all parts and entries."""

import hashlib

import numpy as np
import pytest

from plumbline.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, _key string, _size int"


def brute(rows, entries=256, rounds=4, scale=1024):
    """{(vec_id, code, error, label_error)} sorted, and the codebooks of each dimension."""
    held = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    ints = [[int(np.floor(np.float64(np.float32(x)) * scale)) for x in r[1]] for r in held]
    books, coded = {}, []
    for size in sorted({len(v) for v in ints}):
        cut = vector_codes.bounds(size, 4)
        own = sorted(
            (place for place in range(len(held)) if len(ints[place]) == size),
            key=lambda place: (held[place][0] is None, held[place][0] or 0, ints[place]),
        )
        codes = []
        for p in range(4):
            parts = [ints[place][cut[p] : cut[p + 1]] for place in own]
            book = [list(x) for x in parts[:entries]]

            def assign(parts=parts, book=book):
                found = []
                for x in parts:
                    distances = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
                    found.append((min(distances), distances.index(min(distances))))
                return found

            for _ in range(rounds):
                found = assign()
                for e in range(len(book)):
                    mine = [x for x, (_, entry) in zip(parts, found, strict=True) if entry == e]
                    if mine:
                        book[e] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
            books.setdefault(size, []).append(book)
            codes.append(assign())
        for i, place in enumerate(own):
            code = "".join(f"{codes[p][i][1]:02x}" for p in range(4))
            coded.append((held[place][0], code, sum(codes[p][i][0] for p in range(4)), held[place][2]))
    by_label = {}
    for _, _, error, label in coded:
        by_label[label] = by_label.get(label, 0) + error
    numbers = ",".join(str(n) for size in sorted(books) for book in books[size] for entry in book for n in entry)
    return sorted(((k, c, e, by_label[l]) for k, c, e, l in coded), key=repr), hashlib.sha256(numbers.encode()).hexdigest()


def coded(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op11_vector_codes(spark, str(tmp_path)).collect()
    assert len({r["codebooks_sha256"] for r in found}) <= 1
    digest = found[0]["codebooks_sha256"] if found else None
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found), key=repr), digest


def clustered(count, size, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, size))
    rows = centres[rng.integers(0, 20, count)] + rng.normal(size=(count, size)).round(1) * 0.2
    return [(int(i), [float(np.float32(x)) for x in v], int(i) % 3) for i, v in enumerate(rows)]


def test_codes_errors_and_codebooks_match_plain_loops(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_codes, "WALK", 50)
    rows = clustered(700, 8)
    assert coded(spark, rows, tmp_path) == brute(rows)


def test_rows_that_take_no_part_copies_ties_and_other_dimensions(spark, tmp_path):
    rows = clustered(300, 8, 2)
    rows += [(1000 + i, rows[3][1], None) for i in range(200)] + [rows[5], rows[5], (5, rows[6][1], 1)]
    rows += [(2000, None, 1), (2001, [1.0, None] * 4, 1), (2002, [float("nan")] * 8, 1), (2003, [float("-inf")] * 8, 1)]
    rows += [(None, [0.5] * 8, 1), (-7, [0.25] * 8, None), (3000, [1.0, 2.0, 3.0], 4), (3001, [1.0, 2.0, 4.0], 4)]
    rows += [(4000, [], 1), (4001, [], 1)]
    assert coded(spark, rows, tmp_path) == brute(rows)


def test_components_too_large_for_doubles_stay_exact(spark, tmp_path):
    rows = [(i, [float(2**20 + i), -float(2**18), float(i), 0.0], 0) for i in range(300)]
    assert coded(spark, rows, tmp_path) == brute(rows)


def test_empty_table_and_single_vector(spark, tmp_path):
    assert coded(spark, [], tmp_path / "none") == ([], None)
    one = [(3, [1.5, -2.5, 0.0, 9.0], None)]
    assert coded(spark, one, tmp_path / "one") == brute(one)


def test_errors_beyond_a_long_are_its_end(spark, tmp_path):
    rows = [(i, [3e38 if i == 299 else float(i)] * 4, 0) for i in range(300)]
    found, _ = coded(spark, rows, tmp_path)
    assert len(found) == 300


@pytest.mark.parametrize("kind", ["few", "wide"])
def test_nearest_takes_the_first_of_equal_entries(kind):
    rng = np.random.default_rng(3)
    reach = 3 if kind == "few" else 1 << 40
    parts = np.unique(rng.integers(-reach, reach, (200, 5)), axis=0)
    entries = rng.integers(-reach, reach, (30, 5))
    entries[7] = entries[3]
    codes, errors = vector_codes.nearest(parts, entries)
    for part, code, error in zip(parts.tolist(), codes, errors, strict=True):
        distances = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in entries.tolist()]
        assert (int(code), int(error)) == (distances.index(min(distances)), min(distances))
