"""One ingest cycle: landed feeds to keyed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tickstream.constants import (
    FEED_LANGUAGE,
    HEADLINE_CATEGORY,
    NEWS_TOPIC,
    PRICES_TOPIC,
    SEARCH_PHRASES,
    SEARCHES_PER_CYCLE,
    TICKERS,
)
from tickstream.functions.times import stamp
from tickstream.operators.articles import cycle_feeds, normalise_articles, page
from tickstream.operators.bars import normalise_bars
from tickstream.operators.envelope import news_key, price_key, to_messages
from tickstream.schemas import NEWS_PAYLOAD, PRICE_PAYLOAD


def news_messages(articles: DataFrame, as_of: Column | None = None,
                  phrases: Sequence[str] = SEARCH_PHRASES[:SEARCHES_PER_CYCLE],
                  category: str = HEADLINE_CATEGORY, language: str = FEED_LANGUAGE,
                  paged: bool = False) -> DataFrame:
    """Headlines and search hits as messages keyed by url, each url once.

    ``paged`` keeps only the page every feed hands out per call.
    """
    feeds = cycle_feeds(articles, stamp(as_of), phrases, category, language)
    shaped = normalise_articles(page(feeds) if paged else feeds, as_of)
    return to_messages(shaped, NEWS_PAYLOAD, news_key(), NEWS_TOPIC)


def price_messages(bars: DataFrame, as_of: Column | None = None,
                   tickers: Sequence[str] | None = TICKERS) -> DataFrame:
    """Bars of the tracked tickers as messages keyed by ticker and bar time."""
    shaped = normalise_bars(bars, tickers, as_of)
    return to_messages(shaped, PRICE_PAYLOAD, price_key(), PRICES_TOPIC)
