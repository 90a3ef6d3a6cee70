"""Bronze to silver: validity, one row per key, typed times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.constants import REMOVED_TITLE
from tickstream.functions.times import iso_instant, lenient_timestamp, stamp
from tickstream.operators.dedup import ARRIVAL, one_per_key, one_per_key_in_place


def valid_news(bronze: DataFrame) -> DataFrame:
    return bronze.filter(
        F.col("title").isNotNull()
        & F.col("url").isNotNull()
        & (F.col("title") != REMOVED_TITLE)
    )


def valid_prices(bronze: DataFrame) -> DataFrame:
    return bronze.dropna(subset=["close", "ticker", "bar_time"])


def silver_news(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The first-seen valid article of every url, with parsed times.

    Whole articles are moved only where a url repeats.
    """
    return one_per_key_in_place(valid_news(bronze), ["url"], ARRIVAL).withColumns({
        "published_at_ts": iso_instant(F.col("published_at")),
        "ingested_at_ts": iso_instant(F.col("ingested_at")),
        "silver_processed_at": stamp(as_of),
    })


def silver_prices(bronze: DataFrame, keep: str = "first", by_instant: bool = False,
                  as_of: Column | None = None) -> DataFrame:
    """One valid bar per ticker and bar time, with parsed times and price range.

    ``keep="last"`` lets a later poll replace the first snapshot of a bar.
    ``by_instant`` treats two spellings of the same instant as one bar; times
    that cannot be parsed are still told apart by their text.
    """
    valid = valid_prices(bronze).withColumn(
        "bar_time_ts", lenient_timestamp(F.col("bar_time"))
    )
    if by_instant:
        unparsed = F.when(F.col("bar_time_ts").isNull(), F.col("bar_time"))
        kept = one_per_key(
            valid.withColumn("_unparsed", unparsed),
            ["ticker", "bar_time_ts", "_unparsed"], ARRIVAL, keep,
        ).drop("_unparsed")
    else:
        kept = one_per_key(valid, ["ticker", "bar_time"], ARRIVAL, keep)
    return kept.withColumns({
        "ingested_at_ts": iso_instant(F.col("ingested_at")),
        "price_range": F.col("high") - F.col("low"),
        "silver_processed_at": stamp(as_of),
    })
