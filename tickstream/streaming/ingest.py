"""Topic to bronze, as append-only streaming queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickstream.operators.envelope import accepted, parse_messages, rejected, sort_messages
from tickstream.schemas import NEWS_PAYLOAD, PRICE_PAYLOAD
from tickstream.sources.tables import Lake, default_format, write_increment
from tickstream.streaming.triggers import Trigger


def start_bronze(envelope: DataFrame, payload: StructType, path: str, checkpoint: str,
                 fmt: str | None = None, trigger: Trigger = Trigger(),
                 name: str | None = None, keep_raw: bool = False,
                 as_of: Column | None = None) -> StreamingQuery:
    """Append parsed messages to a bronze table.

    Each query needs a checkpoint folder of its own. Restarting on the same folder
    goes on after the last committed batch and adds no row twice.
    """
    writer = (
        parse_messages(envelope, payload, as_of, keep_raw)
        .writeStream.format(fmt or default_format())
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return trigger.apply(writer).start(path)


def start_sorted(envelope: DataFrame, payload: StructType, bronze: str, rejects: str, checkpoint: str,
                 fmt: str | None = None, trigger: Trigger = Trigger(), name: str | None = None,
                 as_of: Column | None = None) -> StreamingQuery:
    """Messages to bronze, and those that cannot be read to a table of their own.

    Together the two tables hold every message once: a micro-batch is read and parsed once for
    both, and writes partitions of its own, which it replaces when it is repeated after a failure.
    """
    def one(batch: DataFrame, number: int) -> None:
        messages = sort_messages(batch, payload, as_of).persist()
        try:
            write_increment(accepted(messages), bronze, number, fmt)
            write_increment(rejected(messages), rejects, number, fmt)
        finally:
            messages.unpersist()

    writer = envelope.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return trigger.apply(writer).start()


def start_sorted_news(envelope: DataFrame, lake: Lake, **options) -> StreamingQuery:
    return start_sorted(envelope, NEWS_PAYLOAD, lake.bronze("news"), lake.rejects("news"),
                        lake.checkpoint("news_sorted"), **options)


def start_sorted_prices(envelope: DataFrame, lake: Lake, **options) -> StreamingQuery:
    return start_sorted(envelope, PRICE_PAYLOAD, lake.bronze("prices"), lake.rejects("prices"),
                        lake.checkpoint("prices_sorted"), **options)


def start_news(envelope: DataFrame, lake: Lake, **options) -> StreamingQuery:
    return start_bronze(envelope, NEWS_PAYLOAD, lake.bronze("news"),
                        lake.checkpoint("news_bronze"), **options)


def start_prices(envelope: DataFrame, lake: Lake, **options) -> StreamingQuery:
    return start_bronze(envelope, PRICE_PAYLOAD, lake.bronze("prices"),
                        lake.checkpoint("prices_bronze"), **options)


def run_until_one_ends(queries: list[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until any query ends, then stop the others; its error is raised here."""
    try:
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(poll_seconds)
        for query in queries:
            if query.exception():
                raise query.exception()
    finally:
        for query in queries:
            query.stop()


def run_to_end(queries: list[StreamingQuery]) -> None:
    """Wait for queries that end by themselves (``Trigger(available=True)``)."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def describe(query: StreamingQuery) -> dict:
    """Name, status and the row counts of the last micro-batch."""
    last = query.lastProgress
    return {
        "name": query.name,
        "active": query.isActive,
        "message": query.status["message"],
        "batch": last["batchId"] if last else None,
        "input_rows": last["numInputRows"] if last else 0,
    }
