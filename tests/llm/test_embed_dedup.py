from __future__ import annotations

import numpy as np
import pytest

from tickstream.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def _plain(rows):
    good = [(k, np.array(v, float)) for k, v in rows
            if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    least = {k: k for k, _ in rows}
    links = dict.fromkeys(least, 0)

    def find(a):
        while least[a] != a:
            a = least[a]
        return a
    for i, (a, x) in enumerate(good):
        for b, y in good[i + 1:]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= embed_dedup.MIN_COSINE:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                least[max(p, q)] = min(p, q)
    return {k: (links[k], find(k), find(k) == k) for k in least}


def _vectors(seed: int, groups: int, size: int = 32):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        center = rng.standard_normal(size)
        center /= np.linalg.norm(center)
        for _ in range(rng.integers(1, 9)):
            rows.append((center + rng.standard_normal(size) * 0.15 / np.sqrt(size)) * rng.uniform(0.1, 10))
    rows = [[float(np.float32(x)) for x in v] for v in rows]
    rows += [rows[0], rows[0], rows[3], [0.0] * size, None, [], [float("nan")] + rows[1][1:],
             [float("inf")] + rows[1][1:], [None] + rows[1][1:], rows[2][:16], rows[2][:16]]
    order = rng.permutation(len(rows))
    return [(int(k) * 3, rows[k]) for k in order]


@pytest.mark.parametrize("block", [None, 3])
def test_links_against_brute_force(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(embed_dedup, "BLOCK_VECTORS", block)
    rows = _vectors(4, 120)
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.link_vectors(df).collect()}
    want = _plain(rows)
    assert all(got[k][0] <= want[k][0] for k in want)  # no link below the limit
    found, all_ = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert found >= 0.97 * all_
    if found == all_:
        assert got == want


def test_plan_keeps_recall_at_every_size():
    for n in (0, 1, 100, 10**6, 10**10):
        plan = embed_dedup.Plan.of(n)
        near = embed_dedup._same_step(embed_dedup.GRID_STEP) ** plan.directions
        assert 1 - (1 - near) ** plan.tables >= embed_dedup.CELL_RECALL - 1e-9 and 0 < plan.needed < embed_dedup.COUNTED


def test_edge_cases(spark):
    assert embed_dedup.link_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [2.0, 0.0], 1), (5, [2.0, 0.0], 1), (9, None, None)], SCHEMA)
    got = sorted((tuple(r) for r in embed_dedup.link_vectors(df).collect()), key=str)
    assert got == sorted([(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (9, 0, 9, True)], key=str)
    wide = df.withColumnRenamed("label", "cls")
    assert embed_dedup.link_vectors(wide).columns == ["vec_id", "n_links", "component_id", "kept"]
    doubles = spark.createDataFrame([(1, [1e200, 1e200]), (2, [1e-200, 1.1e-200])], "vec_id long, embedding array<double>")
    assert [r["n_links"] for r in embed_dedup.link_vectors(doubles).collect()] == [1, 1]
