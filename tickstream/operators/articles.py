"""From landed article feeds to the news payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.constants import (
    FEED_LANGUAGE,
    HEADLINE_CATEGORY,
    HEADLINES_PAGE,
    LOOKBACK_HOURS,
    REMOVED_TITLE,
    SEARCH_PAGE,
    SEARCH_PHRASES,
    SEARCHES_PER_CYCLE,
)
from tickstream.functions.text import has_all_words, words
from tickstream.functions.times import iso_instant, iso_string, lookback_start, stamp
from tickstream.operators.dedup import one_per_key, top_of_few_groups
from tickstream.schemas import NEWS_PAYLOAD


def is_headline(category: str = HEADLINE_CATEGORY, language: str = FEED_LANGUAGE) -> Column:
    return (F.col("category") == category) & (F.col("language") == language)


def is_recent(as_of: Column, hours: int = LOOKBACK_HOURS) -> Column:
    """Published on or after the day ``hours`` before ``as_of``."""
    return iso_instant(F.col("publishedAt")) >= lookback_start(as_of, hours)


def cycle_feeds(articles: DataFrame, as_of: Column,
                phrases: Sequence[str] = SEARCH_PHRASES[:SEARCHES_PER_CYCLE],
                category: str = HEADLINE_CATEGORY, language: str = FEED_LANGUAGE,
                hours: int = LOOKBACK_HOURS) -> DataFrame:
    """The headline feed and one search feed per phrase, in one table.

    Feed 0 holds the headlines; feed n the recent articles with all words of
    phrase n in title or description. An article has one row per feed it is in.
    All feeds come out of a single pass over the articles.
    """
    searchable = (F.col("language") == language) & is_recent(as_of, hours)
    text = F.concat_ws(" ", "title", "description")
    tokens = articles.withColumn("_words", F.when(searchable, words(text)))
    feeds = [F.when(is_headline(category, language), F.lit(0))] + [
        F.when(has_all_words(F.col("_words"), phrase), F.lit(number))
        for number, phrase in enumerate(phrases, start=1)
    ]
    return tokens.withColumn("feed", F.explode(F.array_compact(F.array(*feeds)))).drop("_words")


def page(feeds: DataFrame, headlines_page: int = HEADLINES_PAGE,
         search_page: int = SEARCH_PAGE) -> DataFrame:
    """What the feeds hand out in one call.

    The headline feed gives its first articles, a search its newest ones.
    """
    newest = iso_instant(F.col("publishedAt"))
    first = [
        F.when(F.col("feed") > 0, newest).desc_nulls_last(),
        F.col("position").asc(),
    ]
    size = F.when(F.col("feed") == 0, headlines_page).otherwise(search_page)
    most = max(headlines_page, search_page)
    ranked = top_of_few_groups(feeds, ["feed"], first, most, ["position"], "_rn")
    return ranked.filter(F.col("_rn") <= size).drop("_rn")


def normalise_articles(feeds: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Usable articles in payload form, each url once.

    Articles without title, withdrawn ones and those without url, which could not
    be keyed, are dropped. Of repeated urls the first in feed order stays.
    """
    usable = feeds.filter(
        F.col("title").isNotNull()
        & (F.col("title") != "")
        & (F.col("title") != REMOVED_TITLE)
        & F.col("url").isNotNull()
    )
    shaped = one_per_key(usable, ["url"], ["feed", "position"]).select(
        iso_string(stamp(as_of), micros=True).alias("ingested_at"),
        F.col("source.name").alias("source_name"),
        "author",
        "title",
        "description",
        "url",
        F.col("publishedAt").alias("published_at"),
        "content",
    )
    return shaped.select(*NEWS_PAYLOAD.fieldNames())
