"""Questions to the stored tables: search, gold tables, prices and index state."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstream.constants import (
    CITATION_SEPARATOR,
    EMPTY_TABLE_FORMAT,
    LATEST_ANOMALIES,
    NO_ARTICLES,
    SAMPLE_TITLES,
    TOP_K,
    YEAR_RANGE_DAYS,
)
from tickstream.operators.annuli import AnnulusIndex, annulus_search, open_index
from tickstream.operators.bars import daily_bars
from tickstream.operators.dedup import top_per_group
from tickstream.operators.embed import Embedder, embed_texts, hash_embedder, index_stats
from tickstream.operators.search import citations, knn_search, with_metadata
from tickstream.operators.serving import (
    latest_anomalies,
    latest_attention,
    newest_anomalies,
    price_answers,
    price_snapshot,
    render,
)
from tickstream.sources.tables import (
    GOLD_TABLES,
    Lake,
    TableNotFound,
    finished,
    partition_days,
    read_gold,
    read_table,
    table_exists,
)

LATEST = {"price_anomaly_flags": latest_anomalies, "daily_sentiment": latest_attention}
assert LATEST.keys() == GOLD_TABLES.keys()

def search_news(questions: DataFrame, vectors: DataFrame, k: int = TOP_K,
                make_embedder: Callable[[], Embedder] = hash_embedder,
                index: AnnulusIndex | None = None) -> DataFrame:
    """The nearest articles to every question as (query_id, rank, vec_id, citation).

    ``questions`` holds (query_id, text); the embedder must be the one that built
    the vector table. An ``index`` of the same vectors gives the same hits.
    """
    asked = questions.select(
        "query_id", embed_texts(F.col("text"), make_embedder).alias("embedding")
    )
    hits = knn_search(asked, vectors, k) if index is None else annulus_search(asked, index, k)
    return citations(with_metadata(hits, vectors.drop("embedding")))


def search_answers(questions: DataFrame, vectors: DataFrame, k: int = TOP_K,
                   make_embedder: Callable[[], Embedder] = hash_embedder,
                   index: AnnulusIndex | None = None) -> DataFrame:
    """One text per question: its citations, or a note that there are none."""
    found = search_news(questions, vectors, k, make_embedder, index).groupBy("query_id").agg(
        # At most k rows a question.
        F.sort_array(F.collect_list(F.struct("rank", "citation"))).alias("_hits")
    )
    text = F.array_join(F.col("_hits.citation"), CITATION_SEPARATOR)
    return questions.join(found, "query_id", "left").select(
        "query_id", F.coalesce(text, F.lit(NO_ARTICLES)).alias("answer")
    )


def lake_vectors(spark: SparkSession, lake: Lake, fmt: str | None = None) -> DataFrame:
    """The vector table of a lake; says how to build it where there is none."""
    try:
        return read_table(spark, lake.vectors, fmt)
    except TableNotFound as error:
        raise TableNotFound(
            f"no vector table at {lake.vectors}; run build_vector_table first") from error


def search_lake(spark: SparkSession, lake: Lake, questions: DataFrame, k: int = TOP_K,
                make_embedder: Callable[[], Embedder] = hash_embedder,
                fmt: str | None = None) -> DataFrame:
    """``search_answers`` over the lake's own vector table, by its index where it has one."""
    index = None
    if finished(spark, f"{lake.vector_index}/pivots"):
        index = open_index(spark, lake.vector_index)
    return search_answers(questions, lake_vectors(spark, lake, fmt), k, make_embedder, index)


def latest_rows(spark: SparkSession, lake: Lake, name: str,
                fmt: str | None = None) -> DataFrame:
    """The latest rows of a gold table; unknown names raise with the known ones."""
    table = read_gold(spark, lake, name, fmt)
    if name == "price_anomaly_flags":
        days = partition_days(spark, lake.gold(GOLD_TABLES[name]), "bar_date")
        if days:
            return newest_anomalies(table, days)
    return LATEST[name](table)


def latest_rows_text(spark: SparkSession, lake: Lake, name: str,
                     fmt: str | None = None) -> str:
    rows = latest_rows(spark, lake, name, fmt)
    return render(rows, LATEST_ANOMALIES, EMPTY_TABLE_FORMAT % name)


def live_prices(spark: SparkSession, lake: Lake, tickers: Sequence[str],
                as_of: Column | None = None, fmt: str | None = None) -> DataFrame:
    """The latest price of every named ticker as (ticker, answer).

    Of silver only the named tickers' rows are read, and only days up to ``as_of`` and back to
    what the snapshot looks at: the last two days of each ticker and a year before the last.
    """
    names = [t.strip().upper() for t in tickers]
    prices = read_table(spark, lake.silver("prices"), fmt).filter(F.col("symbol").isin(names))
    if as_of is not None:
        prices = prices.filter(F.col("bar_date") <= F.to_date(as_of))
    daily = daily_bars(prices.filter(F.col("bar_date") >= F.lit(_first_day(prices))))
    requested = spark.createDataFrame([(t,) for t in tickers], "ticker string")
    return price_answers(requested, price_snapshot(daily, tickers, as_of))


def _first_day(prices: DataFrame) -> date | None:
    """The first day that a snapshot of these bars needs; reads symbols and days only."""
    last_two = top_per_group(prices.select("symbol", "bar_date").distinct(), ["symbol"],
                             [F.col("bar_date").desc_nulls_last()], 2)
    needed = last_two.groupBy("symbol").agg(
        F.min("bar_date").alias("second"), F.date_sub(F.max("bar_date"), YEAR_RANGE_DAYS).alias("year"))
    return needed.agg(F.min(F.least("second", "year")).alias("day")).first()["day"]


def index_report(spark: SparkSession, lake: Lake, fmt: str | None = None) -> dict:
    """State of the vector table; "degraded" while there is none."""
    if not table_exists(spark, lake.vectors, fmt):
        return {"status": "degraded", "articles_indexed": 0}
    stats = index_stats(read_table(spark, lake.vectors, fmt), SAMPLE_TITLES).first()
    return {"status": "healthy"} | stats.asDict()
