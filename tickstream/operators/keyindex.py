"""An index of known keys beside a table: Bloom filters per day, then an exact check.

A filter never misses a key that it holds. Keys that no filter knows are new without a look
at the table; for the others only the days whose filters answered are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Filters and asked keys meet by shard, so each filter is read by one task.
SHARDS = 64
# A filter holds at most this many keys; a shard with more has several.
FILTER_KEYS = 500_000
# About one in 100,000 unknown keys is held for known.
BITS_PER_KEY = 24
PROBES = 16

FILTERS = "day date, shard int, bits binary"


def key_hashes(*keys: str | Column) -> list[Column]:
    """128 bits of a key as ``k1`` and ``k2``."""
    return [F.xxhash64(F.lit(seed), *keys).alias(f"k{seed}") for seed in (1, 2)]


def _shard() -> Column:
    return F.pmod("k1", F.lit(SHARDS)).cast("int").alias("shard")


def _places(k1: np.ndarray, k2: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The bits a key has in a filter of that size, by double hashing."""
    step = k2.view(np.uint64) | np.uint64(1)
    # The shard is in the low bits of k1.
    at = k1.view(np.uint64) >> np.uint64(6)
    for _ in range(PROBES):
        yield (at % np.uint64(size)).astype(np.int64)
        at = at + step


def _filled(k1: np.ndarray, k2: np.ndarray, bits_per_key: int) -> bytes:
    size = max(8, len(k1) * bits_per_key + 7 & ~7)
    flags = np.zeros(size, bool)
    for place in _places(k1, k2, size):
        flags[place] = True
    return np.packbits(flags).tobytes()


def _known(bits: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    known = np.ones(len(k1), bool)
    for place in _places(k1, k2, 8 * len(bits)):
        known &= (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
    return known


def build_filters(keys: DataFrame, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """Filters (day, shard, bits) over keys (day, k1, k2), of bounded size each."""
    dealt = keys.select("day", _shard(), "k1", "k2").repartition("day", "shard").sortWithinPartitions("day", "shard")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last, count = None, 0

        def close() -> pa.RecordBatch:
            table = pa.concat_tables(held)
            one, two = (table.column(k).to_numpy() for k in ("k1", "k2"))
            return pa.RecordBatch.from_arrays(
                [pa.array([last[0]], pa.date32()), pa.array([last[1]], pa.int32()),
                 pa.array([_filled(one, two, bits_per_key)], pa.binary())], ["day", "shard", "bits"])

        for batch in source:
            table = pa.Table.from_batches([batch])
            for group, a, b in _groups(batch, ("day", "shard")):
                if held and (group != last or count >= FILTER_KEYS):
                    yield close()
                    held, count = [], 0
                held.append(table.slice(a, b - a))
                last, count = group, count + b - a
        if held:
            yield close()

    return dealt.mapInArrow(run, FILTERS)


def _groups(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[tuple[tuple, int, int]]:
    """Stretches of equal values in the named columns."""
    if not batch.num_rows:
        return
    columns = [batch.column(n).to_pylist() for n in names]
    rows = list(zip(*columns))
    start = 0
    for k in range(1, len(rows) + 1):
        if k == len(rows) or rows[k] != rows[start]:
            yield rows[start], start, k
            start = k


def possible_days(keys: DataFrame, filters: DataFrame, count: int) -> DataFrame:
    """(k1, k2, day): the days whose filters may hold a key; ``count`` is the number of keys.

    Keys of a shard are looked up together while its filters pass by one at a time. With more
    keys than a task should hold, the filters are sent to several parts of the keys.
    """
    chunks = max(1, -(-count // (SHARDS * FILTER_KEYS)))
    asked = keys.select(
        _shard(), F.pmod("k2", F.lit(chunks)).alias("chunk"), F.lit(None).cast("date").alias("day"), "k1", "k2",
        F.lit(None).cast("binary").alias("bits"))
    known = filters.select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"),
        "day", F.lit(None).cast("long").alias("k1"), F.lit(None).cast("long").alias("k2"), "bits")
    # Keys have no bits and come first.
    dealt = asked.unionByName(known).repartition("shard", "chunk").sortWithinPartitions(
        "shard", "chunk", F.col("bits").isNotNull())

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one, two, table = None, [], [], None
        for batch in source:
            for group, a, b in _groups(batch, ("shard", "chunk")):
                if group != last:
                    last, one, two, table = group, [], [], None
                part = batch.slice(a, b - a)
                is_key = part.column("bits").is_null().to_numpy(zero_copy_only=False)
                if is_key.any():
                    mine = part.filter(pa.array(is_key))
                    one.append(mine.column("k1").to_numpy())
                    two.append(mine.column("k2").to_numpy())
                if is_key.all() or not one:
                    continue
                if table is None:
                    table = np.concatenate(one), np.concatenate(two)
                rest = part.filter(pa.array(~is_key))
                for day, bits in zip(rest.column("day"), rest.column("bits")):
                    hit = np.flatnonzero(_known(np.frombuffer(bits.as_buffer(), np.uint8), *table))
                    if len(hit):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(table[0][hit]), pa.array(table[1][hit]),
                             pa.array([day.as_py()] * len(hit), pa.date32())], ["k1", "k2", "day"])

    return dealt.mapInArrow(run, "k1 long, k2 long, day date")
