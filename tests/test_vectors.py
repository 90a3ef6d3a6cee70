from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import bronze_news, column
from pyspark.sql import functions as F

from tickstream.operators import embed, search, silver
from tickstream.schemas import VECTORS

IDS = "vec_id bigint, embedding array<float>"


def frame(spark, matrix, id_col="vec_id"):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{id_col} bigint, embedding array<float>")


def brute_force(queries, vectors, k):
    q, v = (np.asarray(m, dtype=np.float32).astype(np.float64) for m in (queries, vectors))
    q, v = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in (q, v))
    out = []
    for i, row in enumerate(np.round(q @ v.T, 9)):
        best = sorted(range(len(v)), key=lambda j: (-row[j], j))[:k]
        out += [(i, r, j, row[j]) for r, j in enumerate(best, 1)]
    return out


def run(queries, vectors, **kw):
    rows = search.knn_search(queries, vectors, **kw).orderBy("query_id", "rank").collect()
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in rows]


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-9)


@pytest.fixture(scope="module")
def matrices():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 8))
    vectors[50:190] = vectors[0]  # A third of the rows are copies.
    vectors[7] = 0
    return rng.normal(size=(23, 8)), vectors


@pytest.mark.parametrize("k", [1, 5, 200])
def test_sent_queries_match_brute_force(spark, matrices, k):
    queries, vectors = matrices
    queries = np.vstack([queries, vectors[0]])
    stored = frame(spark, vectors).repartition(5)
    same(run(frame(spark, queries, "query_id"), stored, k=k), brute_force(queries, vectors, k))


@pytest.mark.parametrize("k", [5, 150])
def test_blocks_match_brute_force(spark, matrices, k):
    queries, vectors = matrices
    queries = np.vstack([queries, vectors[0]])
    got = run(frame(spark, queries, "query_id"), frame(spark, vectors), k=k,
              max_bytes=7 * (16 + 8 * 8))
    same(got, brute_force(queries, vectors, k))


def test_wide_queries_are_sent_in_blocks(spark, matrices):
    queries, vectors = matrices
    got = run(frame(spark, queries, "query_id"), frame(spark, vectors), k=3, max_bytes=300)
    same(got, brute_force(queries, vectors, 3))
    plan = search.knn_search(frame(spark, queries, "query_id"), frame(spark, vectors),
                             max_bytes=300)._jdf.queryExecution().toString()
    # Only hits are left to pick from: vectors are neither copied nor joined.
    assert "embedding" not in plan and "Join" not in plan


def test_small_batches(spark, matrices):
    queries, vectors = matrices
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "13")
    try:
        same(run(frame(spark, queries, "query_id"), frame(spark, vectors), k=20),
             brute_force(queries, vectors, 20))
    finally:
        spark.conf.set(key, before)


def test_edges(spark):
    three = frame(spark, [[1, 0], [0, 1], [0, 0]])
    one = frame(spark, [[2, 0]], "query_id")
    assert run(one, three) == [(0, 1, 0, 1.0), (0, 2, 1, 0.0), (0, 3, 2, 0.0)]
    assert run(one, three.limit(0)) == []
    assert run(one.limit(0), three) == []
    with_null = three.unionAll(spark.createDataFrame([(9, None)], IDS))
    assert len(run(one, with_null)) == 3
    with pytest.raises(Exception, match="dimensions"):
        run(one, frame(spark, [[1, 0, 0]]))
    with pytest.raises(Exception, match="different lengths"):
        run(one, frame(spark, [[1, 0, 0], [1, 0]]).coalesce(1))


def test_self_match_ranks_first(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(50, 16))
    top = run(frame(spark, m, "query_id"), frame(spark, m), k=1)
    assert [(q, v) for q, _, v, _ in top] == [(i, i) for i in range(50)]
    assert all(s == pytest.approx(1.0) for *_, s in top)


def test_citations_keep_unmatched_hits(spark):
    hits = search.knn_search(frame(spark, [[1, 0]], "query_id"),
                             frame(spark, [[1, 0], [0, 1]]))
    meta = spark.createDataFrame(
        [(0, "T", None, None, "text")],
        "vec_id bigint, title string, source_name string, published_at string, text string",
    )
    out = search.citations(search.with_metadata(hits, meta)).orderBy("rank").collect()
    assert out[0].citation == (
        "[1] T\n    Source: Unknown | Published: Unknown | Relevance: 1.000\n    text..."
    )
    assert out[1].citation.startswith("[2] Unknown\n")


# Embedding ----------------------------------------------------------------


def test_hash_embedder():
    embedder = embed.hash_embedder(16)
    a, b, c, nothing = embedder(["Ärger über Öl", "öl ärger ÜBER", "öl", "..."])
    assert a == b != c
    assert sum(abs(x) for x in c) == 1
    assert nothing == [0.0] * 16


def test_hashing_in_the_jvm_gives_the_same_vectors(spark):
    texts = ["Ärger über Öl", "öl ärger ÜBER", "", "...", "a a a b 42", None, "ǅ x" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [list(r.v) for r in df.select(embed.hashed_vectors(F.col("t"), 16).alias("v")).collect()]
    assert got == embed.hash_embedder(16)([t or "" for t in texts])
    assert embed.hashed_vectors(F.col("t")) is not None


def test_message_ids_out_of_range_are_an_error(spark):
    def number(partition, offset):
        df = spark.createDataFrame([(partition, offset)], "kafka_partition int, kafka_offset bigint")
        return df.select(embed.message_id().alias("x")).first().x

    assert number(2, 5) == (2 << 44) + 5 and number(None, 5) is None
    for partition, offset in ((1 << 19, 0), (0, 1 << 44), (-1, 0)):
        with pytest.raises(Exception, match="no message id"):
            number(partition, offset)


def test_embed_calls_the_model_in_batches(spark):
    def make():
        def model(texts):
            return [[float(len(texts)), float(len(t))] for t in texts]
        return model

    df = spark.range(0, 120, 1, 1).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("t"))
    out = df.select(F.length("t").alias("n"),
                    embed.embed_texts(F.col("t"), make, 50).alias("v")).collect()
    assert all(r.v[1] == r.n for r in out)
    assert sorted({r.v[0] for r in out}) == [20.0, 50.0]


def test_model_is_called_once_per_text(spark):
    df = spark.range(3).select(
        "id", embed.embed_texts(F.lit("a"), lambda: embed.hash_embedder()).alias("v")
    )
    used = df.filter(F.col("v").isNotNull()).select("id", F.posexplode("v"))
    assert used._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_model_must_answer_every_text(spark):
    def make():
        return lambda texts: []

    with pytest.raises(Exception, match="gave 0 vectors"):
        spark.range(1).select(embed.embed_texts(F.lit("a"), make)).collect()


def test_build_vectors(spark):
    news = silver.silver_news(bronze_news(
        spark,
        {"url": "1", "title": "Chips rise", "kafka_partition": 2, "kafka_offset": 5},
        {"url": "2", "title": "", "description": "", "content": "[+9 chars]",
         "kafka_offset": 6},
        {"url": "3", "title": "...", "description": None, "content": None, "kafka_offset": 7},
    ))
    out = embed.build_vectors(news)
    assert out.schema == VECTORS or out.columns == VECTORS.fieldNames()
    rows = {r.url: r for r in out.collect()}
    assert set(rows) == {"1", "3"}
    assert rows["1"].vec_id == (2 << 44) + 5
    assert rows["1"].text == "Title: Chips rise | Description: d | Content: c"
    assert math.isclose(sum(x * x for x in rows["1"].embedding), 1, rel_tol=1e-5)


def test_index_stats(spark):
    df = frame(spark, [[1, 0]] * 5).withColumn("title", F.concat(F.lit("t"), "vec_id"))
    row = embed.index_stats(df, 3).first()
    assert (row.articles_indexed, row.embedding_dim) == (5, 2)
    assert row.sample_titles == ["t0", "t1", "t2"]
    empty = embed.index_stats(df.limit(0), 3).first()
    assert (empty.articles_indexed, empty.embedding_dim) == (0, None)
    assert column(df, "vec_id") == list(range(5))
