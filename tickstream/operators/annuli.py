"""Exact vector search that leaves out vectors which cannot be among the best.

Vectors are dealt to the nearest of some pivots and stored by pivot in blocks of about equal
angle from it. By the triangle inequality of angles, a query at angle ``a`` from the pivot is
at least ``a - high`` and ``low - a`` away from all vectors of a block whose angles lie in
[low, high]. A first pass over each query's nearest blocks gives the score its hits must
reach; a second one reads the pivots' partitions that may hold better ones and scores there
only the queries that a block may serve. All others are proven to be worse, so the hits are
those of a full search, ties included.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstream.constants import TOP_K
from tickstream.operators.dedup import top_per_group
from tickstream.operators.search import (
    HITS,
    MAX_SENT_BYTES,
    SCORE_DIGITS,
    BestHits,
    _ids_and_units,
    _with_vectors,
)
from tickstream.session import ship_package, work_path
from tickstream.sources.tables import stored

MAX_PIVOTS = 1024
# Pivots are sent to the tasks; their size is known from their number and length.
PIVOT_BYTES = 16 << 20
BLOCK_ROWS = 512
# Blocks looked at first, for each query, to learn which score its hits must reach.
FIRST_BLOCKS = 4
# More than what rounding in angles and scores can come to.
SLACK = 1e-6

_BLOCKS = "pivot int, low double, high double, rows int, ids binary, units binary"


@dataclass(frozen=True)
class AnnulusIndex:
    """Where the blocks lie, and the pivots' unit vectors by number."""

    path: str
    pivots: np.ndarray


def build_index(vectors: DataFrame, max_pivots: int = MAX_PIVOTS, block_rows: int = BLOCK_ROWS,
                path: str | None = None) -> AnnulusIndex:
    """Store ``vectors`` (vec_id, embedding) in blocks by pivot and angle.

    The pivots are vectors taken by a hash of their ids, so many that a pivot has some
    blocks; they only decide how much can be left out. A pivot with very many vectors is
    dealt to several tasks by angle. Zero vectors and such with NaN components are kept in
    blocks that are never left out.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    vectors = _with_vectors(vectors, "vec_id")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    room = PIVOT_BYTES // (8 * max(size.dim or 1, 1))
    count = int(min(max_pivots, max(1, room), max(1, (size.n or 0) // (4 * block_rows) + 1)))
    pointing = vectors.filter(
        F.exists("embedding", lambda x: x != 0) & F.forall("embedding", lambda x: F.abs(x) < float("inf")))
    _, pivots = _ids_and_units(
        pointing.orderBy(F.xxhash64("vec_id"), "vec_id").limit(count).toArrow(), "vec_id")
    path = path or work_path(spark, "annuli")
    sent = spark.sparkContext.broadcast(pivots)

    def deal(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids, units = _ids_and_units(pa.Table.from_batches([batch]), "vec_id")
            pivot, angle = np.full(len(ids), -1), np.zeros(len(ids))
            usable = np.flatnonzero(np.isfinite(units).all(axis=1) & units.any(axis=1))
            if len(sent.value) and len(usable):
                cosine = units[usable] @ sent.value.T
                pivot[usable] = cosine.argmax(axis=1)
                angle[usable] = np.arccos(np.clip(cosine.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pivot.astype(np.int32)), pa.array(angle), pa.array(ids),
                 pa.array([row.tobytes() for row in units], pa.binary())], ["pivot", "angle", "vec_id", "unit"])

    def pack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in source:
            table, start = pa.Table.from_batches([batch]), 0
            pivot = batch.column(0).to_numpy()
            cuts = [*(np.flatnonzero(pivot[1:] != pivot[:-1]) + 1).tolist(), len(pivot)]
            for cut in cuts:
                while start < cut:
                    if held and (rows >= block_rows or held[-1].column(0)[-1].as_py() != pivot[start]):
                        yield _block(held)
                        held, rows = [], 0
                    stop = min(cut, start + block_rows - rows)
                    held.append(table.slice(start, stop - start))
                    rows, start = rows + stop - start, stop
        if held:
            yield _block(held)

    dealt = vectors.mapInArrow(deal, "pivot int, angle double, vec_id bigint, unit binary")
    dealt = dealt.repartitionByRange("pivot", "angle").sortWithinPartitions("pivot", "angle")
    dealt.mapInArrow(pack, _BLOCKS).write.mode("overwrite").partitionBy("pivot").parquet(f"{path}/blocks")
    # Written last: an index without pivots is not finished.
    rows = [(k, row.tobytes()) for k, row in enumerate(pivots)]
    spark.createDataFrame(rows, "pivot int, unit binary").write.mode("overwrite").parquet(f"{path}/pivots")
    return AnnulusIndex(path, pivots)


def open_index(spark: SparkSession, path: str) -> AnnulusIndex:
    """An index that was built at this path before; its pivots have a size bound."""
    rows = spark.read.schema("pivot int, unit binary").parquet(f"{path}/pivots").orderBy("pivot").collect()
    pivots = [np.frombuffer(r["unit"], np.float64) for r in rows]
    return AnnulusIndex(path, np.array(pivots) if pivots else np.zeros((0, 1)))


def _block(held: list[pa.Table]) -> pa.RecordBatch:
    table = pa.concat_tables(held)
    angle = table.column(1).to_numpy()
    units = b"".join(table.column(3).to_pylist())
    return pa.RecordBatch.from_arrays(
        [table.column(0)[:1].combine_chunks(), pa.array([angle[0]]), pa.array([angle[-1]]),
         pa.array([len(angle)], pa.int32()), pa.array([table.column(2).to_numpy().tobytes()], pa.binary()),
         pa.array([units], pa.binary())], ["pivot", "low", "high", "rows", "ids", "units"])


def least_angle(angle: np.ndarray, low: float, high: float) -> np.ndarray:
    """A bound from below on the angle between queries and the vectors of a block."""
    return np.maximum(0.0, np.maximum(angle - high, low - angle))


def annulus_search(queries: DataFrame, index: AnnulusIndex, k: int = TOP_K,
                   max_bytes: int = MAX_SENT_BYTES) -> DataFrame:
    """What ``knn_search`` returns: (query_id, rank, vec_id, score), rank from 1."""
    return search_with_counts(queries, index, k, max_bytes)[0]


def search_with_counts(queries: DataFrame, index: AnnulusIndex, k: int = TOP_K,
                       max_bytes: int = MAX_SENT_BYTES) -> tuple[DataFrame, DataFrame]:
    """The hits, and one row (scored, pairs): pairs of query and vector scored, and all there are."""
    spark = queries.sparkSession
    ship_package(spark)
    queries = stored(_with_vectors(queries, "query_id"), "queries")
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    row_bytes = 16 + 8 * (max(size.dim or 0, 1) + len(index.pivots))
    blocks = max(1, -(-size.n * row_bytes // max_bytes))
    path = work_path(spark, "hits")
    for number in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number)
        _search_block(spark, part.toArrow(), index, k, path)
    found = spark.read.schema(HITS).parquet(path)
    best = top_per_group(found.filter("query_id IS NOT NULL"), ["query_id"],
                         [F.col("score").desc(), F.col("vec_id").asc()], k)
    stored_rows = _blocks_of(spark, index).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    scored = found.filter("query_id IS NULL").agg(F.coalesce(F.sum("vec_id"), F.lit(0)).alias("scored"))
    counts = scored.crossJoin(stored_rows).select("scored", (F.col("rows") * size.n).alias("pairs"))
    return best.select("query_id", "rank", "vec_id", "score"), counts


def _blocks_of(spark: SparkSession, index: AnnulusIndex) -> DataFrame:
    return spark.read.schema(_BLOCKS).parquet(f"{index.path}/blocks")


def _search_block(spark: SparkSession, queries: pa.Table, index: AnnulusIndex, k: int, path: str) -> None:
    """Add the best hits for these queries to the table at ``path``, and a row with the pairs scored."""
    ids, units = _ids_and_units(queries, "query_id")
    angles = np.zeros((len(ids), len(index.pivots)))
    if len(index.pivots) and len(ids):
        if units.shape[1] != index.pivots.shape[1]:
            raise ValueError(f"queries have {units.shape[1]} dimensions, vectors {index.pivots.shape[1]}")
        angles = np.arccos(np.clip(units @ index.pivots.T, -1, 1))
    # A query without direction is as near to all; one with NaN has no hits.
    angles[~(np.isfinite(units).all(axis=1) & units.any(axis=1))] = np.nan
    blocks = _blocks_of(spark, index)
    floor = _first_scores(blocks, units, angles, k) if len(ids) else np.zeros(0)
    most = np.arccos(np.clip(floor - 10.0 ** -SCORE_DIGITS, -1, 1)) + SLACK
    # Which pivots may serve a query: one pass over two numbers a block.
    ranges = blocks.groupBy("pivot").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    needed = [r["pivot"] for r in ranges if _serves(angles, most, r["pivot"], r["low"], r["high"]).any()]
    sent = spark.sparkContext.broadcast((ids, units, angles, most))

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units, angles, most = sent.value
        best, pairs = BestHits(len(ids), k), 0
        for pivot, low, high, count, vec_ids, rows in _unpacked(source):
            asked = np.flatnonzero(_serves(angles, most, pivot, low, high))
            if len(asked):
                # The kept hits of all queries, narrowed to those this block may serve.
                part = BestHits(len(asked), k)
                part.scores, part.ids = best.scores[asked], best.ids[asked]
                part.offer(units[asked], vec_ids, rows)
                best.scores[asked], best.ids[asked] = part.scores, part.ids
                pairs += len(asked) * count
        yield from best.table(ids).to_batches()
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.array([pairs]), pa.nulls(1, pa.float64())], ["query_id", "vec_id", "score"])

    # A filter on the partition column: other pivots' files are not opened.
    wanted = blocks.filter(F.col("pivot").isin(needed) if needed else F.lit(False))
    wanted.mapInArrow(score, HITS).write.mode("append").parquet(path)
    sent.destroy()


def _serves(angles: np.ndarray, most: np.ndarray, pivot: int, low: float, high: float) -> np.ndarray:
    """Which queries may find a hit in a block: those not farther from it than ``most``."""
    if pivot < 0:
        return np.ones(len(angles), bool)
    own = angles[:, pivot]
    return np.isnan(own) | (least_angle(own, low, high) <= most)


def _unpacked(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in source:
        names = ("pivot", "low", "high", "rows", "ids", "units")
        for pivot, low, high, count, ids, units in zip(*[batch.column(n) for n in names]):
            count = count.as_py()
            yield (pivot.as_py(), low.as_py(), high.as_py(), count, np.frombuffer(ids.as_buffer(), np.int64),
                   np.frombuffer(units.as_buffer(), np.float64).reshape(count, -1))


def _first_scores(blocks: DataFrame, units: np.ndarray, angles: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that ``k`` vectors reach, from the blocks nearest to it; -1 without."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast((units, angles))
    nearest = _nearest_blocks(blocks, angles)
    wanted = sorted({(p, low, high) for rows in nearest for p, low, high in rows})
    turn = {key: n for n, key in enumerate(wanted)}
    asks: dict[int, list[int]] = {}
    for q, rows in enumerate(nearest):
        for key in rows:
            asks.setdefault(turn[key], []).append(q)

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, _ = sent.value
        count = len(units)
        best = BestHits(count, k)
        for pivot, low, high, _, vec_ids, rows in _unpacked(source):
            asked = np.array(asks.get(turn.get((pivot, low, high), -1), []), np.int64)
            if len(asked):
                part = BestHits(len(asked), k)
                part.scores, part.ids = best.scores[asked], best.ids[asked]
                part.offer(units[asked], vec_ids, rows)
                best.scores[asked], best.ids[asked] = part.scores, part.ids
        yield from best.table(np.arange(count)).to_batches()

    pivots = sorted({p for p, _, _ in wanted})
    hits = blocks.filter(F.col("pivot").isin(pivots) if pivots else F.lit(False)).mapInArrow(score, HITS)
    best = top_per_group(hits, ["query_id"], [F.col("score").desc(), F.col("vec_id").asc()], k)
    reached = best.filter(F.col("rank") == k).select("query_id", "score").toArrow()
    floor = np.full(len(units), -1.0)
    floor[reached.column("query_id").to_numpy()] = reached.column("score").to_numpy()
    sent.destroy()
    return floor


def _nearest_blocks(blocks: DataFrame, angles: np.ndarray) -> list[list[tuple[int, float, float]]]:
    """The first blocks of each query by the bound on their angle, found where blocks are read."""
    sent = blocks.sparkSession.sparkContext.broadcast(angles)

    def pick(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        angles = sent.value
        bound = np.full((len(angles), FIRST_BLOCKS), np.inf)
        names = np.zeros((len(angles), FIRST_BLOCKS, 3))
        for batch in source:
            for pivot, low, high in zip(*[batch.column(n).to_pylist() for n in ("pivot", "low", "high")]):
                if pivot < 0:
                    continue
                own = np.nan_to_num(angles[:, pivot], nan=np.pi)
                # Of blocks that may be as near, the one around the query's own angle comes first.
                far = least_angle(own, low, high) + 1e-3 * own
                worst = bound.argmax(axis=1)
                rows = np.flatnonzero(far < bound[np.arange(len(bound)), worst])
                bound[rows, worst[rows]] = far[rows]
                names[rows, worst[rows]] = (pivot, low, high)
        some = np.isfinite(bound)
        query = np.repeat(np.arange(len(angles)), FIRST_BLOCKS).reshape(bound.shape)[some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(names[some][:, 0].astype(np.int32)), pa.array(names[some][:, 1]),
             pa.array(names[some][:, 2]), pa.array(bound[some])], ["q", "pivot", "low", "high", "bound"])

    found = blocks.select("pivot", "low", "high").mapInArrow(
        pick, "q bigint, pivot int, low double, high double, bound double")
    # At most FIRST_BLOCKS rows for each of the queries of one sent block.
    rows = top_per_group(found, ["q"], [F.col("bound"), F.col("pivot"), F.col("low")], FIRST_BLOCKS)
    out: list[list[tuple[int, float, float]]] = [[] for _ in range(len(angles))]
    for r in rows.collect():
        out[r["q"]].append((r["pivot"], r["low"], r["high"]))
    sent.destroy()
    return out
