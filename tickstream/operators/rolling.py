"""Rolling row-frame statistics that do not need a whole series in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickstream.sources.tables import stored

# Spans as many and as large as the session's shuffle partitions, see ``_ranged``.
BY_SIZE = 0


def with_rolling(df: DataFrame, key: str, ts: str, rows: int,
                 stats: dict[str, Callable[[WindowSpec], Column]],
                 inputs: Sequence[str], ties: Sequence[str] = (),
                 split_rows: int | None = BY_SIZE) -> DataFrame:
    """Add statistics over each row and the ``rows - 1`` rows before it.

    ``stats`` maps an output column to a function of the window; ``inputs`` names
    the columns those functions read. ``ts`` must not be NULL.

    A window partitioned by ``key`` alone sorts a whole series in one task. The
    rows are therefore dealt by ranges of (key, time, ties) into spans, whatever a
    series' length, bursts or NULL key. A span that goes on with a series gets a copy of
    the ``rows - 1`` rows before it, so the frames are those of the uncut series. The
    dealt rows are stored once, since all that follows has to see the same ranges;
    ``df`` is read for that by a sample and the writing job. ``split_rows`` asks for spans
    of about that many rows; ``None`` uses the plain window instead.
    """
    order = [ts, *ties]
    if split_rows is None:
        return df.withColumns(_apply(stats, Window.partitionBy(key).orderBy(*order), rows))
    spans = stored(_ranged(df, [key, *order], split_rows), "spans")
    lead_in = _lead_in(spans, key, order, inputs, max(rows - 1, 1))
    both = spans.withColumn("_copy", F.lit(False)).unionByName(
        lead_in.withColumn("_copy", F.lit(True)), allowMissingColumns=True
    )
    window = Window.partitionBy(key, "_span").orderBy(*order)
    return (
        both.withColumns(_apply(stats, window, rows))
        .filter(~F.col("_copy"))
        .drop("_copy", "_span")
    )


def _apply(stats: dict[str, Callable[[WindowSpec], Column]], window: WindowSpec,
           rows: int) -> dict[str, Column]:
    frame = window.rowsBetween(-(rows - 1), Window.currentRow)
    return {name: stat(frame) for name, stat in stats.items()}


def _ranged(df: DataFrame, order: Sequence[str], split_rows: int) -> DataFrame:
    """The rows in ranges of about equal row count, numbered in order by ``_span``.

    By default there are as many ranges as shuffle partitions, which ``get_session`` sizes at
    512 MB each: some 100,000 for tens of terabytes. Adaptive execution merges neighbours
    where they are small, but leaves each core one. A window streams through its sorted
    span and spills, so a span's size does not bind memory.
    """
    if split_rows == BY_SIZE:
        dealt = df.repartitionByRange(*order)
    else:
        dealt = df.repartitionByRange(max(1, -(-df.count() // split_rows)), *order)
    return dealt.withColumn("_span", F.spark_partition_id())


def _lead_in(spans: DataFrame, key: str, order: Sequence[str], inputs: Sequence[str],
             carry: int) -> DataFrame:
    """Copies of the ``carry`` rows before each span, labelled with that span.

    Only the last series of a span can go on in the next, so a span gives up
    ``carry`` rows at most, taken by a rank filter before the shuffle. A series may
    have fewer of them than that in a span; the ``carry`` spans before hold enough.
    """
    fields = [key, *order, *[c for c in inputs if c not in order]]
    backwards = Window.partitionBy("_span").orderBy(*[F.col(c).desc() for c in (key, *order)])
    closing = (
        spans.select("_span", F.struct(*fields).alias("_row"), key, *order)
        .withColumn("_rn", F.row_number().over(backwards))
        .filter(F.col("_rn") <= carry)
        .groupBy("_span")
        .agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    )
    last = F.element_at("_rows", -1)[key]
    tails = closing.select(
        last.alias(key), "_span",
        F.filter("_rows", lambda r: r[key].eqNullSafe(last)).alias("_tail"),
    )
    # Structs, so that NULL counts as the lowest key instead of being left out.
    heads = spans.groupBy("_span").agg(F.min(F.struct(key)).alias("_first")).select(
        F.col(f"_first.{key}").alias(key), "_span", F.lit(None).alias("_tail")
    )
    ends = tails.unionByName(heads).groupBy(key, "_span").agg(
        F.first("_tail", ignorenulls=True).alias("_tail")
    )
    earlier = Window.partitionBy(key).orderBy("_span").rowsBetween(-carry, -1)
    gathered = F.flatten(F.collect_list("_tail").over(earlier))
    return (
        ends.select("_span", gathered.alias("_rows"))
        .select(
            "_span",
            F.explode(
                F.when(F.size("_rows") > carry, F.slice("_rows", -carry, carry))
                .otherwise(F.col("_rows"))
            ).alias("_row"),
        )
        .select("_span", *[F.col(f"_row.{c}").alias(c) for c in fields])
    )
