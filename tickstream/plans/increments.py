"""Silver and gold kept up to date from new bronze rows only.

An increment is a batch of bronze rows with a number, as a stream of the bronze table gives
them. What an increment costs follows from its own rows and the days they touch:

- silver gets the rows whose key is new. Prices are compared with the days in the batch, since
  a bar's time is in its key; news asks the key index, and reads the days that may hold a url.
- anomaly flags of bars behind a ticker's last one need the last rows of each ticker, which are
  kept as a table. Late bars re-open the days they change, and only those are computed again
  from the days around them.
- daily attention adds up sources per day, and only the days with new articles.

An increment may be done again after a failure at any point: every step writes partitions of
its own, or replaces days from rows that were stored completely before. A table that is
maintained like this holds the same rows as ``run_batch`` over all of bronze, if the rows of
one key come in arrival order, as those of one topic partition do. A key that is in silver
stays as it is (the first one wins).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickstream.constants import ROLLING_BARS
from tickstream.functions.text import normal_ticker
from tickstream.operators.gold import day_sources, merged_sentiment, price_anomaly_flags
from tickstream.operators.keyindex import build_filters, key_hashes, possible_days
from tickstream.operators.reopen import BAR, reopened_days, series_tails
from tickstream.operators.silver import silver_news, silver_prices
from tickstream.schemas import GOLD_ANOMALY_COLUMNS
from tickstream.sources.tables import (
    GOLD_TABLES,
    Lake,
    delete_folder,
    finished,
    numbered_folders,
    read_table,
    replace_parts,
    stored,
    table_exists,
    write_increment,
    write_table,
)
from tickstream.streaming.triggers import Trigger

CARRY = ROLLING_BARS - 1


def _before(spark: SparkSession, path: str, increment: int, fmt: str | None) -> DataFrame | None:
    """The rows that earlier increments wrote; None where there are none."""
    if not table_exists(spark, path, fmt):
        return None
    table = read_table(spark, path, fmt)
    if "increment" not in table.columns:
        raise ValueError(f"{path} was not written by increments; start them in a lake of their own")
    return table.filter(F.col("increment") < increment)


def _on_days(table: DataFrame, day: str, days: list) -> DataFrame:
    """The rows of some days, a filter on partitions; None stands for rows without a day."""
    named = [d for d in days if d is not None]
    wanted = F.col(day).isin(named) if named else F.lit(False)
    return table.filter(wanted | F.col(day).isNull() if None in days else wanted)


def _days_of(rows: DataFrame, day: str) -> list:
    """The distinct days of rows; the calendar bounds their number."""
    return [r[0] for r in rows.select(day).distinct().collect()]


# Prices --------------------------------------------------------------------


def apply_prices(spark: SparkSession, lake: Lake, batch: DataFrame, increment: int,
                 fmt: str | None = None, as_of: Column | None = None) -> dict[str, int]:
    """Bring silver prices and anomaly flags up to date with a batch of bronze prices.

    Returns the rows added to silver and the flag rows written, which include those of
    re-opened days and of other tickers on the days that were touched.
    """
    tails_path, staged = lake.state("price_tails"), lake.state(f"flags/{increment}")
    done = numbered_folders(spark, tails_path)
    if done and done[-1] > increment:
        raise ValueError(f"increment {done[-1]} was applied already; {increment} comes too late")
    added = _add_prices(spark, lake, batch, increment, fmt, as_of)
    path = lake.silver("prices")
    if not added and not table_exists(spark, path, fmt):
        return {"silver_prices": 0, "price_anomaly_flags": 0}
    silver = read_table(spark, path, fmt).filter(F.col("bar_time_ts").isNotNull())
    new = silver.filter(F.col("increment") == increment)
    earlier = [k for k in done if k < increment]
    tails = (read_table(spark, f"{tails_path}/{earlier[-1]}", "parquet") if earlier
             else new.select(*BAR).limit(0))
    if not finished(spark, staged):
        flags = _new_flags(spark, lake, silver, new, tails, increment, fmt, as_of)
        flags.write.mode("overwrite").parquet(staged)
    series_tails(tails.unionByName(new.select(*BAR)), CARRY).write.mode("overwrite").parquet(
        f"{tails_path}/{increment}")
    # From here on the days are replaced from what is stored, as often as it takes.
    days = spark.read.parquet(staged).hint("rebalance", F.col("bar_date")).sortWithinPartitions(
        "bar_date", "ticker", "bar_time_ts")
    written = replace_parts(days, lake.gold(GOLD_TABLES["price_anomaly_flags"]), ("bar_date",), fmt)
    for old in earlier[:-1]:
        delete_folder(spark, f"{tails_path}/{old}")
        delete_folder(spark, lake.state(f"flags/{old}"))
    return {"silver_prices": added, "price_anomaly_flags": written}


def _add_prices(spark: SparkSession, lake: Lake, batch: DataFrame, increment: int,
                fmt: str | None, as_of: Column | None) -> int:
    fresh = stored(silver_prices(batch, as_of=as_of).withColumns({
        "symbol": normal_ticker(F.col("ticker")), "bar_date": F.to_date("bar_time_ts"),
    }), "fresh-prices")
    known = _before(spark, lake.silver("prices"), increment, fmt)
    if known is not None:
        # One spelling of a time is always on one day.
        known = _on_days(known, "bar_date", _days_of(fresh, "bar_date")).select("ticker", "bar_time")
        fresh = fresh.join(known, ["ticker", "bar_time"], "left_anti")
    fresh = fresh.hint("rebalance", F.col("bar_date")).sortWithinPartitions("bar_date", "symbol")
    return write_increment(fresh, lake.silver("prices"), increment, fmt, ("bar_date",))


def _new_flags(spark: SparkSession, lake: Lake, silver: DataFrame, new: DataFrame, tails: DataFrame,
               increment: int, fmt: str | None, as_of: Column | None) -> DataFrame:
    """All flag rows of the days that the new bars touch or re-open."""
    last = tails.groupBy("ticker").agg(F.max("bar_time_ts").alias("last_ts"))
    tickers = new.groupBy("ticker").agg(F.min("bar_time_ts").alias("first_ts")).join(last, "ticker", "left")
    # A bar at the last instant may belong before bars that are there.
    tickers = stored(tickers.withColumn(
        "late", F.coalesce(F.col("first_ts") <= F.col("last_ts"), F.lit(False))), "tickers")
    late = tickers.filter("late").select("ticker")
    on_time = tickers.filter("NOT late").select("ticker", "last_ts")

    behind = new.join(on_time.select("ticker"), "ticker", "left_semi").select(*BAR)
    carried = tails.join(on_time.select("ticker"), "ticker", "left_semi").select(*BAR)
    rows = carried.withColumn("_new", F.lit(False)).unionByName(behind.withColumn("_new", F.lit(True)))
    needed = None
    if not late.isEmpty():
        needed, rows_again = _reopened(silver, new, late, increment)
        rows = rows.unionByName(rows_again)
    flags = stored(price_anomaly_flags(rows, as_of=as_of, extra=["_new"]).filter("_new").drop("_new"), "new-flags")

    gold_path = lake.gold(GOLD_TABLES["price_anomaly_flags"])
    if not table_exists(spark, gold_path, fmt):
        return flags
    there = _on_days(read_table(spark, gold_path, fmt), "bar_date", _days_of(flags, "bar_date"))
    # Rows of tickers on time go on after their last one, so a repeated increment adds none twice.
    kept = there.join(on_time.withColumn("_hit", F.lit(True)), "ticker", "left").filter(
        F.col("_hit").isNull() | (F.col("bar_time_ts") <= F.col("last_ts")))
    if needed is not None:
        again = needed.filter("reopen").select("ticker", "bar_date")
        kept = kept.join(again, ["ticker", "bar_date"], "left_anti")
    return flags.unionByName(kept.select(*GOLD_ANOMALY_COLUMNS))


def _reopened(silver: DataFrame, new: DataFrame, late: DataFrame, increment: int) -> tuple[DataFrame, DataFrame]:
    """The days needed for late tickers, and their bars; ``_new`` where flags change."""
    # Counts of days read the ticker column alone.
    days = silver.join(late, "ticker", "left_semi").groupBy("ticker", "bar_date").agg(F.count("*").alias("rows"))
    touched = new.select("ticker", "bar_date").distinct().withColumn("touched", F.lit(True))
    days = days.join(touched, ["ticker", "bar_date"], "left").withColumn(
        "touched", F.coalesce("touched", F.lit(False)))
    needed = stored(reopened_days(days, CARRY), "reopened")
    bars = _on_days(silver, "bar_date", _days_of(needed, "bar_date"))
    return needed, bars.join(needed, ["ticker", "bar_date"]).select(*BAR, F.col("reopen").alias("_new"))


# News ----------------------------------------------------------------------


def apply_news(spark: SparkSession, lake: Lake, batch: DataFrame, increment: int,
               fmt: str | None = None, as_of: Column | None = None) -> dict[str, int]:
    """Bring silver news and daily attention up to date with a batch of bronze news.

    Returns the rows added to silver, the urls that the index could not rule out, and the
    days that were counted again.
    """
    added, asked = _add_news(spark, lake, batch, increment, fmt, as_of)
    if not added:
        return {"silver_news": 0, "possible_urls": asked, "days": 0}
    new = read_table(spark, lake.silver("news"), fmt).filter(F.col("increment") == increment)
    sources_path = lake.state("day_sources")
    write_increment(day_sources(new), sources_path, increment, "parquet", ("published_date",))
    sources = read_table(spark, sources_path, "parquet")
    days = _days_of(sources.filter(F.col("increment") == increment), "published_date")
    changed = merged_sentiment(_on_days(sources, "published_date", days))
    path = lake.gold(GOLD_TABLES["daily_sentiment"])
    if table_exists(spark, path, fmt):
        same = read_table(spark, path, fmt).filter(~F.col("published_date").isin(days))
        changed = changed.unionByName(same)
    # One row a day; stored first, since the table is read and replaced.
    changed = stored(changed, "days")
    write_table(changed.orderBy(F.col("published_date").desc()), path, fmt)
    return {"silver_news": added, "possible_urls": asked, "days": len(days)}


def _add_news(spark: SparkSession, lake: Lake, batch: DataFrame, increment: int,
              fmt: str | None, as_of: Column | None) -> tuple[int, int]:
    found = silver_news(batch, as_of).withColumns({
        "seen_date": F.to_date("kafka_timestamp"),
    }).select("*", *key_hashes("url"))
    fresh = stored(found, "fresh-news")
    known = _before(spark, lake.silver("news"), increment, fmt)
    asked = 0
    if known is not None:
        filters = _before(spark, lake.state("news_keys"), increment, "parquet")
        possible = stored(possible_days(fresh.select("k1", "k2"), filters, fresh.count()), "possible")
        days = _days_of(possible, "day")
        asked = possible.select("k1", "k2").distinct().count() if days else 0
        # Only the url column of the days that answered; whether a url is there is exact.
        seen = _on_days(known, "seen_date", days).select("url")
        fresh = fresh.join(seen, "url", "left_anti")
    fresh = stored(fresh, "new-news")
    added = write_increment(fresh.drop("k1", "k2"), lake.silver("news"), increment, fmt, ("seen_date",))
    keys = fresh.select(F.col("seen_date").alias("day"), "k1", "k2")
    write_increment(build_filters(keys), lake.state("news_keys"), increment, "parquet")
    return added, asked


# As a stream ---------------------------------------------------------------


def start_increments(spark: SparkSession, lake: Lake, name: str, fmt: str | None = None,
                     trigger: Trigger = Trigger(), as_of: Column | None = None,
                     report: Callable[[int, dict[str, int]], None] | None = None) -> StreamingQuery:
    """Apply new bronze rows of ``news`` or ``prices`` as they are appended.

    The checkpoint remembers which files were applied; a batch that failed comes again with
    the same rows and the same number, and replaces what it had written.
    """
    apply = {"news": apply_news, "prices": apply_prices}[name]
    path = lake.bronze(name)
    table = read_table(spark, path, fmt)

    def one(batch: DataFrame, number: int) -> None:
        # A micro-batch belongs to a session of its own.
        counts = apply(batch.sparkSession, lake, batch, number, fmt, as_of)
        if report is not None:
            report(number, counts)

    stream = spark.readStream.schema(table.schema).format(fmt) if fmt else spark.readStream.format("delta")
    writer = stream.load(path).writeStream.foreachBatch(one).option(
        "checkpointLocation", lake.checkpoint(f"{name}_increments"))
    return trigger.apply(writer).start()
