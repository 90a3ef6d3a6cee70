"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL = ("kafka_timestamp", "kafka_partition", "kafka_offset")

# Cells of the bitmaps that stand in for repeated keys: 4 MB in all, however many keys repeat.
REPEAT_CELLS = 1 << 25


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                keep: str = "first") -> DataFrame:
    """The first (or last) row of every key in the given order.

    The rank filter is pushed below the shuffle, so each task sends at most one
    row per key and a key that fills a third of the table does not pile up.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    by = [c.asc() for c in by] if keep == "first" else [c.desc() for c in by]
    ranked = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn")


def one_per_key_in_place(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                         keep: str = "first", cells: int = REPEAT_CELLS) -> DataFrame:
    """``one_per_key`` for wide rows, most of which have a key of their own.

    Hashes of the keys are counted first. Those found more than once set a cell of a bitmap that is
    sent to all tasks; rows whose cell is not set are alone with their key and stay where they are
    read, and only the others are moved and ranked. A cell that is set by another key, or a full
    bitmap, lets more rows be moved and changes no result. ``df`` is read three times, the first
    time for ``keys`` alone.
    """
    repeated = df.groupBy(F.xxhash64(*keys).alias("_hash")).count().filter("count > 1")
    cell = F.pmod("_hash", F.lit(cells))
    # Bitmap functions number their places from 1.
    placed = repeated.select(F.bitmap_bucket_number(cell + 1).alias("_bucket"),
                             F.bitmap_bit_position(cell + 1).alias("_place"))
    # Dealt by bucket before the bitmaps are made, so that none is moved.
    bitmaps = placed.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    found = df.withColumn("_hash", F.xxhash64(*keys)).withColumns({
        "_bucket": F.bitmap_bucket_number(cell + 1), "_place": F.bitmap_bit_position(cell + 1).cast("int"),
    }).join(F.broadcast(bitmaps), "_bucket", "left")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(F.col("_place") / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    is_set = F.coalesce(F.getbit(byte.cast("long"), F.col("_place") % 8) == 1, F.lit(False))
    alone, others = (found.filter(rows).select(*df.columns) for rows in (~is_set, is_set))
    return alone.unionAll(one_per_key(others, keys, order, keep))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                  rank: str = "rank") -> DataFrame:
    """The best ``n`` rows of every group, numbered from 1."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(ranked)).filter(F.col(rank) <= n)


def top_of_few_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                      spread: Sequence[str], rank: str = "rank",
                      salts: int = 64) -> DataFrame:
    """``top_per_group`` for a handful of large groups of wide rows.

    With few groups, the best rows of all tasks would meet in as few tasks. They
    are first narrowed down in ``salts`` parts per group, told apart by a hash of
    the ``spread`` columns, so that the last step sees at most ``salts * n`` rows.
    """
    part = F.pmod(F.xxhash64(*spread), F.lit(salts))
    narrowed = top_per_group(df.withColumn("_part", part), [*keys, "_part"], order, n, rank)
    return top_per_group(narrowed.drop("_part", rank), keys, order, n, rank)
