from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tickstream.llm import vector_codes as vc

SHAPE = "vec_id long, embedding array<float>, label int"


def _plain(rows, parts=4, entries=256, rounds=4):
    """All distances in every round, in Python's own numbers."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(book))

    for turn in range(rounds + 1):
        found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    sums = {}
    for (_, _, lab), e in zip(kept, errors):
        sums[lab] = sums.get(lab, 0) + e
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), err, sums[lab], digest)
                   for (i, _, lab), f, err in zip(kept, found, errors)), key=str)


def _report(spark, rows):
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    return sorted((tuple(r) for r in vc.code_report(df).collect()), key=str)


def test_against_a_plain_version(spark):
    random.seed(13)
    # Few distinct values make many equal distances, within and between entries.
    rows = [(k, [float(random.choice((-0.3, -0.001, 0.0, 0.25, 0.5))) for _ in range(8)], random.choice((1, 2, None)))
            for k in range(700)]
    rows += [(k, [random.uniform(-1, 1) for _ in range(8)], 3) for k in range(1000, 1300)]
    rows = [(i, np.array(v, np.float32).tolist(), lab) for i, v, lab in rows]
    rows += [rows[0], rows[0], (None, rows[5][1], 1), (2000, None, 1), (2001, [float("nan")] * 8, 1),
             (2002, [float("inf")] + [0.0] * 7, 1), (2003, [None] * 8, 1), (-1, [], 1)]
    random.shuffle(rows)
    assert _report(spark, rows) == _plain(rows)


def test_fewer_vectors_than_entries(spark):
    rows = [(k, [k / 8, 0.5, -0.5, 1.0], k % 2) for k in range(7)] + [(9, [0.0, 0.5, -0.5, 1.0], None)]
    assert _report(spark, rows) == _plain(rows)


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(5)
    rows = rng.integers(-4, 5, (3000, 4))
    book = rng.integers(-4, 5, (64, 4))
    codes, dists = vc.assign(rows, book)
    for _ in range(6):
        moved = rng.random(64) < 0.3
        book = np.where(moved[:, None], rng.integers(-4, 5, (64, 4)), book)
        codes, dists = vc.assign(rows, book, codes, dists, moved)
        want = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
        assert (codes == want.argmin(axis=1)).all() and (dists == want.min(axis=1)).all()


def test_distances_are_exact_for_large_numbers():
    rows, book = np.array([[1 << 28, 3], [-(1 << 28), 5]]), np.array([[(1 << 28) - 1, 0], [7, 1 << 27]])
    got = vc._distances(rows, book)
    assert got.tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c)) for c in book] for r in rows]
    with pytest.raises(ValueError):
        vc._distances(rows << 10, book)


def test_empty_tables_clashing_names_and_odd_lengths(spark):
    assert vc.code_report(spark.createDataFrame([], SHAPE)).count() == 0
    assert vc.code_report(spark.createDataFrame([(1, None, 1)], SHAPE)).count() == 0
    rows = [(k, [float(k), 0.0, 0.0, 0.0], "a", "b", k) for k in range(3)] + [(7, [1.0] * 8, "a", "b", 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string, error string, __x long")
    out, books = vc.encode_vectors(df)
    assert out.columns == ["vec_id", "__x", "code", "error"] and books.shape == (4, 3, 1)
    assert sorted((r["vec_id"], bytes(r["code"])[0], r["error"], r["__x"]) for r in out.collect()) == [
        (k, k, 0, k) for k in range(3)]
    with pytest.raises(ValueError):
        vc.encode_vectors(spark.createDataFrame([(1, [1.0, 2.0], 1)], SHAPE))
