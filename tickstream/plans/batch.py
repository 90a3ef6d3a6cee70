"""The batch stages: bronze to silver, then both gold tables, then vectors."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tickstream.functions.text import normal_ticker
from tickstream.operators.annuli import build_index
from tickstream.operators.embed import Embedder, build_vectors, hash_embedder, refresh_vectors
from tickstream.operators.gold import daily_sentiment, price_anomaly_flags
from tickstream.operators.silver import silver_news, silver_prices
from tickstream.sources.tables import (
    GOLD_TABLES,
    Lake,
    delete_folder,
    observed,
    read_table,
    table_exists,
    write_table,
)


def build_silver(spark: SparkSession, lake: Lake, fmt: str | None = None,
                 as_of: Column | None = None, keep: str = "first",
                 by_instant: bool = False) -> dict[str, int]:
    """Both silver tables; returns the rows read and written, counted in the same pass.

    ``keep`` and ``by_instant`` are those of ``silver_prices``. Prices are laid out by day and
    carry the normalised ticker, so that readers of few days and tickers skip the rest.
    """
    bronze_news, news_read = observed(read_table(spark, lake.bronze("news"), fmt))
    bronze_prices, prices_read = observed(read_table(spark, lake.bronze("prices"), fmt))
    news = silver_news(bronze_news, as_of)
    prices = silver_prices(bronze_prices, keep, by_instant, as_of).withColumns({
        "symbol": normal_ticker(F.col("ticker")), "bar_date": F.to_date("bar_time_ts"),
    })
    written = _write_all(spark, fmt, {
        "silver_news": (news, lake.silver("news"), ()),
        "silver_prices": (
            prices.hint("rebalance", F.col("bar_date")).sortWithinPartitions("bar_date", "symbol"),
            lake.silver("prices"), ("bar_date",),
        ),
    })
    return {"bronze_news": news_read.get["rows"], "bronze_prices": prices_read.get["rows"]} | written


def build_gold(spark: SparkSession, lake: Lake, fmt: str | None = None,
               as_of: Column | None = None) -> dict[str, int]:
    """Both gold tables from the written silver tables.

    Days are few and stored newest first. Flags are laid out by day, so that readers of
    few days skip the rest, and sorted by ticker and time within each file. Large days
    are split over several files.
    """
    flags = price_anomaly_flags(read_table(spark, lake.silver("prices"), fmt), as_of=as_of)
    days = daily_sentiment(read_table(spark, lake.silver("news"), fmt))
    return _write_all(spark, fmt, {
        "price_anomaly_flags": (
            flags.hint("rebalance", F.col("bar_date")).sortWithinPartitions(
                "bar_date", "ticker", "bar_time_ts"),
            lake.gold(GOLD_TABLES["price_anomaly_flags"]), ("bar_date",),
        ),
        "daily_sentiment": (
            days.orderBy(days.published_date.desc()),
            lake.gold(GOLD_TABLES["daily_sentiment"]), (),
        ),
    })


def build_vector_table(spark: SparkSession, lake: Lake, fmt: str | None = None,
                       make_embedder: Callable[[], Embedder] = hash_embedder,
                       index: bool = False, reuse: bool = False) -> int:
    """Embed all silver news; with ``index``, searches read only blocks that may hold hits.

    ``reuse`` takes over the stored vectors of texts that are there already, so the model, which
    must be the one that made them, is called for new and changed texts only.
    """
    news = read_table(spark, lake.silver("news"), fmt)
    if reuse and table_exists(spark, lake.vectors, fmt):
        vectors = refresh_vectors(news, read_table(spark, lake.vectors, fmt), make_embedder)
    else:
        vectors = build_vectors(news, make_embedder)
    # An index of other vectors must not be found beside the new ones.
    delete_folder(spark, lake.vector_index)
    rows = write_table(vectors, lake.vectors, fmt)
    if index:
        build_index(read_table(spark, lake.vectors, fmt), path=lake.vector_index)
    return rows


def run_batch(spark: SparkSession, lake: Lake, fmt: str | None = None,
              as_of: Column | None = None, keep: str = "first",
              by_instant: bool = False) -> dict[str, int]:
    """All stages in order; returns the rows read from bronze and written to every table."""
    counts = build_silver(spark, lake, fmt, as_of, keep, by_instant)
    return counts | build_gold(spark, lake, fmt, as_of)


def _write_all(spark: SparkSession, fmt: str | None, writes: dict) -> dict[str, int]:
    """Write independent tables side by side, so neither waits for the other's tail."""
    with ThreadPoolExecutor(len(writes)) as pool:
        target = inheritable_thread_target(spark)(write_table)
        jobs = {name: pool.submit(target, df, path, fmt, partition_by)
                for name, (df, path, partition_by) in writes.items()}
        return {name: job.result() for name, job in jobs.items()}
