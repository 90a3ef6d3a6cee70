"""Embedding near-duplicates by collision counting on one-dimensional projections.

Two unit vectors at distance d differ by a normal number of deviation d along a random
direction. So near vectors fall into each other's window, centred at the vector that asks,
in many of the sorted projections, and far ones in few. A pair whose collisions reach a
count is checked exactly; the count is the largest that keeps the wanted recall.

Counting over all vectors would be quadratic. Vectors are first dealt to cells, each the
grid place along some directions, in several independent tables. Their numbers follow from the
number of vectors: cells keep their mean size, and a pair at the similarity limit shares a cell
of some table with the wanted probability. A pair counts in the first table that
unites it, so links can be summed without listing pairs.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import components, consecutive, extended, forget, keep, session_of
from tickstream.llm.signature_tree import Groups
from tickstream.llm.textbatch import mix

MIN_COSINE = 0.95
# Wanted chance that a pair just at the limit meets in a cell, and then passes the count.
CELL_RECALL = 0.99
COUNT_RECALL = 0.999
# Mean vectors in a cell, projections counted in it, width of a grid step and of half a window
# as multiples of the distance at the limit.
CELL_VECTORS = 256
COUNTED = 24
GRID_STEP = 6.0
WINDOW = 1.5
# Cells above this size are compared as pairs of blocks.
BLOCK_VECTORS = 4_096
_STEP_ROWS = 256
SEED = 17


def _same_step(ratio: float) -> float:
    """Chance that two numbers with a normal difference fall into one step of that many deviations."""
    tail = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


@dataclass(frozen=True)
class Plan:
    """Directions per table, tables, and the collisions a pair needs."""

    distance: float
    directions: int
    tables: int
    needed: int

    @staticmethod
    def of(vectors: int, min_cosine: float = MIN_COSINE) -> Plan:
        distance = math.sqrt(2 - 2 * min_cosine)
        far = _same_step(GRID_STEP * distance / math.sqrt(2))
        near = _same_step(GRID_STEP)
        directions = max(1, math.ceil(math.log(max(vectors, 2) / CELL_VECTORS) / -math.log(far)))
        tables = max(1, math.ceil(math.log(1 - CELL_RECALL) / math.log(1 - near ** directions)))
        hit = math.erf(WINDOW / math.sqrt(2))
        chance, needed = 0.0, COUNTED + 1
        while needed > 0 and chance < COUNT_RECALL:
            needed -= 1
            chance += math.comb(COUNTED, needed) * hit ** needed * (1 - hit) ** (COUNTED - needed)
        return Plan(distance, directions, tables, needed)


@functools.lru_cache(maxsize=4)
def _directions(size: int, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random directions and offsets of the tables' grids, and directions that are counted."""
    rng = np.random.default_rng([SEED, size])
    grid = rng.standard_normal((size, plan.tables * plan.directions))
    offset = rng.uniform(0, 1, plan.tables * plan.directions)
    return grid, offset, rng.standard_normal((size, COUNTED))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cell_keys(vectors: np.ndarray, plan: Plan) -> np.ndarray:
    """For unit vectors the cell in each table, as 64-bit hashes."""
    grid, offset, _ = _directions(vectors.shape[1], plan)
    places = np.floor(vectors @ grid / (GRID_STEP * plan.distance) + offset).astype(np.int64)
    places = places.reshape(len(vectors), plan.tables, plan.directions).view(np.uint64)
    names = np.arange(plan.tables, dtype=np.uint64) + np.uint64(vectors.shape[1] << 16)
    keys = np.tile(mix(names), (len(vectors), 1))
    for k in range(plan.directions):
        keys = mix(keys + mix(places[:, :, k]))
    return keys.view(np.int64)


def near_pairs(left: np.ndarray, right: np.ndarray, plan: Plan, min_cosine: float,
               same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors at the limit or nearer, each once if both sides are the same.

    Collisions are counted in windows centred at each left vector; right vectors are
    sorted along each projection, so a window is a range of that order.
    """
    _, _, counted = _directions(left.shape[1], plan)
    asks, has = left @ counted, right @ counted
    order = np.argsort(has, axis=0)
    half = WINDOW * plan.distance
    for a in range(0, len(left), _STEP_ROWS):
        b = min(len(left), a + _STEP_ROWS)
        hits = np.zeros((b - a, len(right)), np.uint8)
        for k in range(COUNTED):
            ranked = has[order[:, k], k]
            low = np.searchsorted(ranked, asks[a:b, k] - half, "left")
            high = np.searchsorted(ranked, asks[a:b, k] + half, "right")
            edges = np.zeros((b - a, len(right) + 1), np.int8)
            np.add.at(edges, (np.arange(b - a), low), 1)
            np.add.at(edges, (np.arange(b - a), high), -1)
            inside = np.cumsum(edges[:, :-1], axis=1, dtype=np.int8)
            hits[:, order[:, k]] += inside.view(np.uint8)
        i, j = np.nonzero(hits >= plan.needed)
        i += a
        if same:
            i, j = i[i < j], j[i < j]
        for s in range(0, len(i), 1 << 16):
            x, y = i[s:s + (1 << 16)], j[s:s + (1 << 16)]
            near = np.einsum("nd,nd->n", left[x], right[y]) >= min_cosine
            if near.any():
                yield x[near], y[near]


def _valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def link_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, vec_id: str = "vec_id",
                 embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of the input.

    Vectors that are null, empty or zero or hold null or non-finite numbers link with
    nothing, nor do vectors of different sizes. Equal vectors form one class and
    are compared once; each counts as a link of the others. ``component_id`` is the least
    non-null id reachable by links; ``kept`` marks the row that has this id.
    """
    spark = session_of(vectors)
    # Floats stay floats where vectors are moved; all numbers are worked with in double.
    vector = F.col(embedding)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(_valid(vector), vector).alias("v"))
    rows = rows.select("vec_id", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("cls"), "v")
    rows = keep(rows, "vectors")
    classes = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("v").alias("v"))
    classes = keep(classes, "vector-classes")
    plan = Plan.of(classes.count(), min_cosine)

    def place(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            flat = batch.column(2).flatten().to_numpy().astype(np.float64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                keys = cell_keys(unit(flat[(bounds[at, None] + np.arange(size))]), plan)
                ends = np.arange(0, keys.size + 1, plan.tables, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(pa.array(at)) for c in batch.columns],
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))], ["cls", "copies", "v", "keys"])

    # Cells are computed once and stored, since rounding may differ where a class is with others.
    known = classes.select("cls", "copies", "v")
    placed = keep(known.mapInArrow(place, extended(known, {"keys": "array<long>"})), "placed")
    # Classes meet without their vectors, which only go where two share a cell.
    dealt = placed.select("cls", "copies", F.posexplode("keys").alias("t", "cell"))
    sizes = dealt.groupBy("cell").agg(F.count("*").alias("size")).where("size > 1")
    spread = (
        dealt.join(sizes, "cell").withColumn("blocks", F.ceil(F.col("size") / BLOCK_VECTORS).cast("long"))
        .withColumn("block", F.pmod(F.xxhash64("cls"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "cls", "copies", "t")
    )
    sent = spread.join(placed.select("cls", "v", "keys"), "cls").select(
        "cell", "i", "j", "block", "cls", "copies", "t", "v", "keys")

    def compare(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in consecutive(source, 3):
            if table.num_rows > 1:
                yield from _cell_links(table, plan, min_cosine)

    found = sent.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(
        compare, "a long, b long, links long")
    found = keep(found, "vector-links")
    forget(placed)
    counts = found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    named = classes.select("cls", "copies", "least").join(roots, F.col("cls") == F.col("id"), "left").withColumn(
        "root", F.coalesce("root", "cls"))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(names, "root").join(counts, F.col("cls") == F.col("a"), "left").select(
        "cls", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id", "cls").join(named, "cls", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _cell_links(table: pa.Table, plan: Plan, min_cosine: float) -> Iterator[pa.RecordBatch]:
    """Links of one cell, or of a pair of its blocks: sums per class, and a spanning forest."""
    cls, copies = table.column(4).to_numpy(), table.column(5).to_numpy()
    t = int(table.column(6)[0].as_py())
    flat = table.column(7).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    data = unit(flat.astype(np.float64).reshape(len(cls), -1))
    keys = table.column(8).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(cls), -1)
    same = table.column(1)[0].as_py() == table.column(2)[0].as_py()
    left = np.arange(len(cls)) if same else np.flatnonzero(table.column(3).to_numpy() == table.column(1)[0].as_py())
    right = left if same else np.setdiff1d(np.arange(len(cls)), left)
    if not len(right):
        return
    links = np.zeros(len(cls), np.int64)
    groups, forest = Groups(len(cls)), []
    for i, j in near_pairs(data[left], data[right], plan, min_cosine, same):
        i, j = left[i], right[j]
        new = ~(keys[i, :t] == keys[j, :t]).any(axis=1)
        i, j = i[new], j[new]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        apart = groups.roots(i) != groups.roots(j) if len(i) else np.zeros(0, bool)
        forest += [(x, y) for x, y in zip(i[apart].tolist(), j[apart].tolist()) if groups.join(x, y)]
    some = np.flatnonzero(links)
    yield pa.RecordBatch.from_arrays(
        [pa.array(cls[some]), pa.nulls(len(some), pa.int64()), pa.array(links[some])], ["a", "b", "links"])
    a = np.array([x for x, _ in forest], np.int64)
    b = np.array([y for _, y in forest], np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(cls[a]), pa.array(cls[b]), pa.nulls(len(a), pa.int64())], ["a", "b", "links"])
