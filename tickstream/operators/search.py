"""Exact nearest-neighbour search by cosine, for many queries at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstream.constants import TOP_K
from tickstream.functions.text import citation
from tickstream.operators.dedup import top_per_group
from tickstream.session import ship_package, work_path
from tickstream.sources.tables import stored

# Query vectors are sent to the tasks in blocks of at most this size.
MAX_SENT_BYTES = 32 << 20
# Queries scored against a batch in one matrix product.
QUERY_SLICE = 512
# Scores are compared to this many digits, well below float32 resolution, so
# that equal vectors tie exactly and the lower id wins.
SCORE_DIGITS = 9

HITS = "query_id BIGINT, vec_id BIGINT, score DOUBLE"
_HITS_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()),
                         ("score", pa.float64())])


def knn_search(queries: DataFrame, vectors: DataFrame, k: int = TOP_K,
               max_bytes: int = MAX_SENT_BYTES) -> DataFrame:
    """The ``k`` stored vectors with the highest cosine for every query.

    ``queries`` holds (query_id BIGINT, embedding), ``vectors`` (vec_id BIGINT,
    embedding). Returns (query_id, rank, vec_id, score), rank from 1.

    The stored vectors are always scored where they are read. The queries come to them in
    blocks whose size is known before anything is collected, each in one pass over the
    vectors, and a task writes nothing but ``k`` hits per query. All vectors are
    compared. The hits of all blocks are stored before the best are picked, so each
    block's copies on the executors are released when its pass is done.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    # Stored, because they are measured before they are used and may come from a model.
    queries = stored(_with_vectors(queries, "query_id"), "queries")
    vectors = _with_vectors(vectors, "vec_id")
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    row_bytes = 16 + 8 * max(size.dim or 0, 1)
    blocks = max(1, -(-size.n * row_bytes // max_bytes))
    path = work_path(spark, "hits")
    for number in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number)
        _score_block(block.toArrow(), vectors, k, path)
    hits = spark.read.schema(HITS).parquet(path)
    best = top_per_group(
        hits, ["query_id"], [F.col("score").desc(), F.col("vec_id").asc()], k
    )
    return best.select("query_id", "rank", "vec_id", "score")


def _with_vectors(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint"), "embedding").filter(
        F.col("embedding").isNotNull()
    )


def _score_block(queries: pa.Table, vectors: DataFrame, k: int, path: str) -> None:
    """Add the best ``k`` hits of every task for these queries to the table at ``path``."""
    sent = vectors.sparkSession.sparkContext.broadcast(_ids_and_units(queries, "query_id"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_units = sent.value
        best = BestHits(len(query_ids), k)
        for batch in batches:
            ids, units = _ids_and_units(pa.Table.from_batches([batch]), "vec_id")
            best.offer(query_units, ids, units)
        yield from best.table(query_ids).to_batches()

    vectors.mapInArrow(score, HITS).write.mode("append").parquet(path)
    sent.destroy()


def _ids_and_units(table: pa.Table, id_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the rows scaled to unit length; zero vectors stay zero."""
    ids = table.column(id_col).to_numpy()
    column = table.column("embedding").combine_chunks()
    lengths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths.tolist()}")
    dim = int(lengths[0]) if len(lengths) else 0
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = rows.reshape(len(ids), dim)
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return ids, np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _comparable(scores: np.ndarray) -> np.ndarray:
    """Rounded, with a single zero."""
    return np.round(scores, SCORE_DIGITS) + 0.0


class BestHits:
    """The best ``k`` (score, id) pairs per query, kept up to date batch by batch."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.scores = np.full((n_queries, k), -np.inf)
        self.ids = np.full((n_queries, k), np.iinfo(np.int64).max)

    def offer(self, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        if not len(ids) or not len(queries):
            return
        if queries.shape[1] != vectors.shape[1]:
            raise ValueError(
                f"queries have {queries.shape[1]} dimensions, vectors {vectors.shape[1]}"
            )
        by_id = np.argsort(ids, kind="stable")
        ids, vectors = ids[by_id], vectors[by_id]
        for start in range(0, len(queries), QUERY_SLICE):
            rows = slice(start, start + QUERY_SLICE)
            scores = queries[rows] @ vectors.T
            # Only scores that reach the worst kept one can change anything.
            reach = scores >= self.scores[rows, -1:] - 10.0 ** -SCORE_DIGITS
            found = np.count_nonzero(reach)
            if found > self.k * len(scores):
                self._merge_dense(rows, scores, ids)
            elif found:
                self._merge_few(start, scores, ids, *np.nonzero(reach))

    def _merge_few(self, start: int, scores: np.ndarray, ids: np.ndarray,
                   at_query: np.ndarray, at_vector: np.ndarray) -> None:
        changed = np.unique(at_query)
        owner = np.concatenate([at_query, np.repeat(changed, self.k)])
        pool = np.concatenate([
            _comparable(scores[at_query, at_vector]), self.scores[start + changed].ravel()
        ])
        pool_ids = np.concatenate([ids[at_vector], self.ids[start + changed].ravel()])
        order = np.lexsort((pool_ids, -pool, owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        # Every changed query brings its k kept pairs, so k are left of each.
        kept = order[place < self.k].reshape(len(changed), self.k)
        self.scores[start + changed] = pool[kept]
        self.ids[start + changed] = pool_ids[kept]

    def _merge_dense(self, rows: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = _comparable(scores)
        scores = np.where(np.isnan(scores), -np.inf, scores)
        take = self._first_k(scores)
        pool = np.concatenate([self.scores[rows], np.take_along_axis(scores, take, 1)], axis=1)
        pool_ids = np.concatenate([self.ids[rows], ids[take]], axis=1)
        order = np.lexsort((pool_ids, -pool), axis=1)[:, :self.k]
        self.scores[rows] = np.take_along_axis(pool, order, 1)
        self.ids[rows] = np.take_along_axis(pool_ids, order, 1)

    def _first_k(self, scores: np.ndarray) -> np.ndarray:
        """Columns of the ``k`` best scores per row, the leftmost among equals."""
        n = scores.shape[1]
        if n <= self.k:
            return np.broadcast_to(np.arange(n), scores.shape)
        kth = np.partition(scores, n - self.k, axis=1)[:, n - self.k, None]
        above = scores > kth
        equal = scores == kth
        room = self.k - above.sum(axis=1, keepdims=True)
        chosen = above | (equal & (np.cumsum(equal, axis=1) <= room))
        return np.nonzero(chosen)[1].reshape(len(scores), self.k)

    def table(self, query_ids: np.ndarray) -> pa.Table:
        found = np.isfinite(self.scores)
        return pa.table(
            [
                np.repeat(query_ids, self.k)[found.ravel()],
                self.ids[found],
                self.scores[found],
            ],
            schema=_HITS_ARROW,
        )


def with_metadata(hits: DataFrame, metadata: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """Hits with the article columns of their vectors; unmatched hits stay.

    The hits are stored first: they are searched for once, and Spark sees how
    large they are when it picks the join. Metadata rows that were not hit are
    dropped by a semi join before anything else is done with them.
    """
    hits = stored(hits, "hits")
    wanted = hits.select(F.col("vec_id").alias(id_col))
    rows = metadata.join(wanted, id_col, "left_semi")
    return hits.join(rows.withColumnRenamed(id_col, "vec_id"), "vec_id", "left")


def citations(hits: DataFrame) -> DataFrame:
    """Hits with metadata as (query_id, rank, vec_id, citation)."""
    return hits.select(
        "query_id",
        "rank",
        "vec_id",
        citation(F.col("rank"), F.col("title"), F.col("source_name"),
                 F.col("published_at"), F.col("score"), F.col("text")).alias("citation"),
    )
