"""Search by pivots and angles gives what the full search gives, from fewer vectors."""

from __future__ import annotations

import numpy as np
import pytest

from tickstream.operators.annuli import annulus_search, build_index, least_angle, open_index, search_with_counts
from tickstream.operators.search import knn_search
from tickstream.session import work_path

SHAPE = "array<float>"


def _frame(spark, name, rows):
    return spark.createDataFrame([(k, None if v is None else [float(x) for x in v]) for k, v in rows],
                                 f"{name} bigint, embedding {SHAPE}")


def _hits(df):
    return sorted(tuple(r) for r in df.collect())


def test_same_hits_and_most_vectors_left_out(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24))
    vectors = [(k, centres[k % 40] + 0.1 * rng.normal(size=24)) for k in range(6000)]
    vectors = _frame(spark, "vec_id", vectors)
    queries = _frame(spark, "query_id", [(k, centres[k] + 0.1 * rng.normal(size=24)) for k in range(20)])
    index = build_index(vectors, max_pivots=64, block_rows=32)
    hits, counts = search_with_counts(queries, index, 7)
    assert _hits(hits) == _hits(knn_search(queries, vectors, 7))
    row = counts.first()
    assert row["pairs"] == 120_000 and row["scored"] < 0.15 * row["pairs"]
    # Several blocks of queries, and an index that is opened again.
    again = annulus_search(queries, open_index(spark, index.path), 7, max_bytes=2_000)
    assert _hits(again) == _hits(hits)


def test_equal_distances_go_to_the_lower_id(spark):
    # All vectors are as near to the queries as others: on a sphere's axes, many times over.
    axes = np.concatenate([np.eye(6), -np.eye(6)])
    vectors = _frame(spark, "vec_id", [(999 - k, axes[k % 12] * (1 + k % 3)) for k in range(600)])
    queries = _frame(spark, "query_id", [(1, np.ones(6)), (2, axes[3]), (3, [1, 1, 0, 0, 0, 0]), (4, -axes[0])])
    index = build_index(vectors, max_pivots=5, block_rows=7)
    for k in (1, 5, 60, 700):
        assert _hits(annulus_search(queries, index, k)) == _hits(knn_search(queries, vectors, k))


def test_vectors_without_direction_and_empty_tables(spark):
    rows = [(1, [0, 0]), (2, [1, 0]), (3, [float("nan"), 1]), (4, None), (5, [0, -2]), (6, [0, 0])]
    vectors = _frame(spark, "vec_id", rows)
    queries = _frame(spark, "query_id", [(1, [1, 1]), (2, [0, 0]), (3, [-1, 0]), (4, [float("nan"), 0]), (5, None)])
    index = build_index(vectors)
    assert _hits(annulus_search(queries, index, 3)) == _hits(knn_search(queries, vectors, 3))
    none = build_index(vectors.filter("false"))
    assert annulus_search(queries, none).count() == 0
    assert annulus_search(queries.filter("false"), index).count() == 0
    with pytest.raises(ValueError):
        annulus_search(_frame(spark, "query_id", [(1, [1, 1, 1])]), index).count()


def test_other_pivots_files_are_not_read(spark):
    index = build_index(_frame(spark, "vec_id", [(k, [np.cos(k / 9), np.sin(k / 9)]) for k in range(3000)]),
                        max_pivots=16, block_rows=16, path=work_path(spark, "index"))
    plan = spark.read.parquet(f"{index.path}/blocks").filter("pivot IN (3)")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(pivot" in plan or "PartitionFilters: [pivot" in plan


def test_bound_never_exceeds_the_angle():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 4))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    angle = np.arccos(np.clip(v @ v.T, -1, 1))
    low, high = angle[0, 1:50].min(), angle[0, 1:50].max()
    assert (least_angle(angle[50:, 0], low, high)[:, None] <= angle[50:, 1:50] + 1e-7).all()
