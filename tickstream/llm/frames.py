"""What the operators share on the Spark side: stored tables, sizes, links to groups."""

from __future__ import annotations

import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickstream.session import prepare, ship_package, work_path


def session_of(df: DataFrame) -> SparkSession:
    """The frame's session, set up as all sessions are, with this package on the workers."""
    spark = prepare(df.sparkSession)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEPT: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back; survives lost executors."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _KEPT[out] = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that ``keep`` returned, when all that reads it has been written."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(_KEPT.pop(df))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def extended(df: DataFrame, columns: dict[str, str]) -> T.StructType:
    """The frame's schema with more columns at its end, types given as DDL."""
    more = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in columns.items()]
    return T.StructType([*df.schema.fields, *more])


def own_prefix(df: DataFrame) -> str:
    """A prefix that none of the frame's columns has, whatever they are called."""
    prefix = "__"
    while any(name.lower().startswith(prefix) for name in df.columns):
        prefix += "_"
    return prefix


def text_key(text: str = "text") -> list[Column]:
    """128 bits that tell texts apart, as two longs; null counts as empty."""
    body = F.coalesce(F.col(text), F.lit("").cast("binary"))
    return [F.xxhash64(F.lit(1), body).alias("t1"), F.xxhash64(F.lit(2), body).alias("t2")]


def as_bytes(name: str) -> Column:
    return F.coalesce(F.col(name).cast("binary"), F.lit("").cast("binary"))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


# A bitmap of fixed size stands in for a set of keys: no key is missed, and a full
# bitmap only lets more rows pass.
BITMAP_BITS = 25


def key_bitmap(keys: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap over the top bits of a long column; 2**bits / 8 bytes for any input."""
    def mark(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, bool)
        for batch in source:
            seen[_cell(batch.column(0).to_numpy(zero_copy_only=False), bits)] = True
        if seen.any():
            yield _bits_row(np.packbits(seen))

    def join(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in source:
            for blob in batch.column(1).to_pylist():
                one = np.frombuffer(blob, np.uint8)
                total = one.copy() if total is None else total | one
        if total is not None:
            yield _bits_row(total)

    shape = "part int, bits binary"
    marks = keys.mapInArrow(mark, shape).repartition(16).mapInArrow(join, shape)
    rows = marks.repartition(1).mapInArrow(join, shape).collect()
    packed = np.zeros((1 << bits) // 8, np.uint8)
    for row in rows:
        packed |= np.frombuffer(row["bits"], np.uint8)
    return packed


def _bits_row(packed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int32()), pa.array([packed.tobytes()], pa.binary())], ["part", "bits"])


def _cell(values: np.ndarray, bits: int) -> np.ndarray:
    values = np.ascontiguousarray(values)
    return (values.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def in_bitmap(packed: np.ndarray, values: np.ndarray, bits: int = BITMAP_BITS) -> np.ndarray:
    cell = _cell(values, bits)
    return (packed[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1


def filter_by_bitmap(df: DataFrame, key: str, packed: np.ndarray) -> DataFrame:
    """Rows whose long key may be in the set; all columns stay."""
    sent = df.sparkSession.sparkContext.broadcast(packed)

    def pick(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(in_bitmap(sent.value, keys)))

    return df.mapInArrow(pick, df.schema)


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected groups of an undirected link table (a, b) of longs.

    Returns (id, root): every id that has a link to another, with the smallest id
    it can reach. Stars are merged in alternation (larger neighbours, then smaller
    ones, are pointed to the least neighbour), which takes a number of rounds that
    grows with the logarithm of the longest path. Each round is written to the
    shared folder. Minima are aggregated before the shuffle and joins may be split,
    so a node with very many links is no single task's work.
    """
    spark = links.sparkSession
    edges = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    edges, before = _observed(edges)
    if not before[0]:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        last = edges
        edges, after = _observed(small)
        forget(last)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _observed(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Store the edges; also their number and a checksum, taken while writing."""
    seen = Observation()
    out = keep(edges.observe(
        seen, F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("x")), "links")
    return out, (seen.get["n"], seen.get["x"])


def consecutive(source: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree in the first ``width`` columns (longs)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in source:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(width)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            key = tuple(keys[s])
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(s, e - s))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
