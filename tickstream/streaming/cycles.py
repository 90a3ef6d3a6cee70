"""Landed feed files to messages, one ingest cycle per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickstream.streaming.triggers import Trigger


def unseen(feed: DataFrame, delay: str, key: str = "url", at: Column | None = None) -> DataFrame:
    """A stream's rows whose key has not come within ``delay``, in any micro-batch or earlier run.

    ``at`` is when a row arrived (default: now). It has to be the arrival, not a time in the row's
    content: rows behind the watermark would be lost, and feeds hand out old articles too. The keys
    are state of the query that runs the stream, one small row each, kept in its checkpoint for
    ``delay`` and then forgotten. Of equal keys in one micro-batch any row may stay. Rows with a
    NULL key are equal to each other.
    """
    arrived = "_arrived"
    return (
        feed.withColumn(arrived, F.current_timestamp() if at is None else at)
        .withWatermark(arrived, delay)
        .dropDuplicatesWithinWatermark([key])
        .drop(arrived)
    )


def start_cycles(feed: DataFrame, to_messages: Callable[[DataFrame], DataFrame],
                 send: Callable[[DataFrame], object], checkpoint: str,
                 trigger: Trigger = Trigger(), name: str | None = None,
                 report: Callable[[int, object], None] | None = None) -> StreamingQuery:
    """Turn every micro-batch of landed rows into messages and send them.

    ``report`` is called after each cycle with its number and what ``send`` returned,
    which is the number of messages for ``publish``.

    Urls are made unique within a batch, as within a polling cycle; a feed that went through
    ``unseen`` has none that came before, either. A batch that fails is sent again as a
    whole after a restart, so messages can repeat, which the silver tables undo.
    """

    def cycle(batch: DataFrame, number: int) -> None:
        sent = send(to_messages(batch))
        if report is not None:
            report(number, sent)

    writer = feed.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return trigger.apply(writer).start()
