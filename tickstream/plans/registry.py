"""Every query by name: (spark, folder of test tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from tickstream import fixtures as fx
from tickstream.constants import SAMPLE_TITLES
from tickstream.functions.vectors import l2_normalise
from tickstream.operators import annuli
from tickstream.operators import articles as art
from tickstream.operators import bars as brs
from tickstream.operators import embed, gold, phrases, search, serving, silver
from tickstream.operators.envelope import parse_messages
from tickstream.plans.batch import build_vector_table, run_batch
from tickstream.plans.increments import apply_news, apply_prices
from tickstream.plans.ingest import news_messages, price_messages
from tickstream.plans.reports import latest_rows, search_answers, search_lake, search_news
from tickstream.schemas import NEWS_PAYLOAD, PRICE_PAYLOAD
from tickstream.session import prepare, work_path
from tickstream.sources.kafka import read_envelope_files
from tickstream.sources.landing import read_articles, read_bars, stream_articles
from tickstream.sources.tables import (
    Lake,
    counted,
    observed,
    read_gold,
    read_table,
    sql_path,
    stored,
    table_exists,
    write_table,
)
from tickstream.streaming.cycles import start_cycles, unseen
from tickstream.streaming.ingest import run_to_end, start_news, start_prices, start_sorted_news
from tickstream.streaming.triggers import Trigger

Query = Callable[[SparkSession, str], DataFrame]

CLOCK_COLUMNS = ("spark_written_at", "silver_processed_at", "gold_processed_at", "last_updated")
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query. Columns that hold the time of the run are left out."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fn(prepare(spark), sf_dir).drop(*CLOCK_COLUMNS)
        return out.select(*[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in out.schema.fields
        ])

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# Inputs ------------------------------------------------------------------


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    return fx.hourly_bars(fx.load(spark, d, "events"))


def _bronze_prices(spark: SparkSession, d: str) -> DataFrame:
    return fx.bronze_prices(_hourly(spark, d))


def _bronze_news(spark: SparkSession, d: str) -> DataFrame:
    return fx.bronze_news(fx.load(spark, d, "documents"))


def _feeds(articles: DataFrame) -> DataFrame:
    return art.cycle_feeds(articles, fx.instant(fx.CYCLE_TIME), fx.PHRASES)


def _news_vectors(spark: SparkSession, d: str) -> DataFrame:
    return stored(embed.build_vectors(silver.silver_news(_bronze_news(spark, d))), "vectors")


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return fx.load(spark, d, "benchmark").withColumnRenamed("item_id", "query_id")


def _label_centres(vectors: DataFrame) -> DataFrame:
    """One query per label: the mean of all its vectors."""
    means = (
        vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    # One group per label holds as many rows as a vector has components.
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("c")
    ).select("query_id", F.col("c.x").alias("embedding"))


# Gold and its readers ----------------------------------------------------


@query
def price_anomaly_flags(spark, d):
    return gold.price_anomaly_flags(stored(_hourly(spark, d), "bars"))


@query
def part_anomaly_flags(spark, d):
    """The same model on the largest table, with many short series."""
    return gold.price_anomaly_flags(
        stored(fx.part_bars(fx.load(spark, d, "lineitem")), "bars")
    )


@query
def split_anomaly_flags(spark, d):
    """Series cut into short spans, as happens to very long ones."""
    return gold.price_anomaly_flags(stored(_hourly(spark, d), "bars"), split_rows=50)


@query
def rolling_stats(spark, d):
    rows = gold.rolling_stats(stored(_hourly(spark, d), "bars"))
    stats = ("avg_volume", "stddev_volume", "avg_range", "stddev_range")
    return rows.select(
        "ticker", "bar_time_ts", *[F.round(c, 6).alias(c) for c in stats]
    )


@query
def latest_anomalies(spark, d):
    return serving.latest_anomalies(
        gold.price_anomaly_flags(stored(_hourly(spark, d), "bars"))
    )


@query
def daily_sentiment(spark, d):
    return _with_double_proxy(gold.daily_sentiment(silver.silver_news(_bronze_news(spark, d))))


@query
def latest_attention(spark, d):
    days = gold.daily_sentiment(silver.silver_news(_bronze_news(spark, d)))
    return _with_double_proxy(serving.latest_attention(days))


def _with_double_proxy(days: DataFrame) -> DataFrame:
    return days.withColumn(
        "attention_score_proxy", F.col("attention_score_proxy").cast("double")
    )


# Silver ------------------------------------------------------------------


@query
def silver_news(spark, d):
    return silver.silver_news(_bronze_news(spark, d))


@query
def silver_prices(spark, d):
    return silver.silver_prices(_bronze_prices(spark, d))


@query
def silver_prices_latest(spark, d):
    """The last poll of a bar wins, whatever way its time is spelled."""
    return silver.silver_prices(_bronze_prices(spark, d), keep="last", by_instant=True)


@query
def stage_counts(spark, d):
    """Rows before and after each stage, counted while it runs: every table is read once."""
    rows = []
    for name, bronze, refine in (
        ("news", _bronze_news(spark, d), silver.silver_news),
        ("prices", _bronze_prices(spark, d), silver.silver_prices),
    ):
        bronze, read = observed(bronze)
        written = counted(refine(bronze), lambda df: df.write.format("noop").mode("overwrite").save())
        rows += [(f"bronze_{name}", read.get["rows"]), (f"silver_{name}", written)]
    return spark.createDataFrame(rows, "stage string, n_rows bigint")


# Ingest ------------------------------------------------------------------


def _opened(messages: DataFrame, payload: StructType) -> DataFrame:
    """Messages as columns, since a value's exact JSON spelling is not fixed."""
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), payload).alias("p"),
        "topic",
    ).select("key", "topic", "p.*")


@query
def envelope_prices(spark, d):
    messages = price_messages(
        _hourly(spark, d), fx.instant(fx.CYCLE_TIME), fx.EVENT_TICKERS
    )
    return _opened(messages, PRICE_PAYLOAD)


@query
def envelope_news(spark, d):
    messages = news_messages(
        fx.raw_articles(fx.load(spark, d, "documents")), fx.instant(fx.CYCLE_TIME), fx.PHRASES
    )
    return _opened(messages, NEWS_PAYLOAD)


@query
def normalise_articles(spark, d):
    """Headlines and searches over all documents, each url once."""
    feeds = _feeds(fx.raw_articles(fx.load(spark, d, "documents")))
    return art.normalise_articles(feeds, fx.instant(fx.CYCLE_TIME))


@query
def feed_pages(spark, d):
    """The page each feed hands out: its first headlines, the newest search hits."""
    feeds = art.page(_feeds(fx.raw_articles(fx.load(spark, d, "documents"))))
    return feeds.select("feed", "position", "url", "publishedAt", "category")


def _phrases_of_titles(documents: DataFrame) -> DataFrame:
    """The second and third word of every document as a phrase."""
    # A limit leaves the rest of the text uncut.
    found = F.slice(F.split("text", "[^\\p{L}\\p{N}]+", 4), 2, 2)
    return documents.select(F.array_join(found, " ").alias("phrase"))


@query
def phrase_matches(spark, d):
    """Articles by the phrases they hold, with as many phrases as there are documents."""
    documents = fx.load(spark, d, "documents")
    articles = fx.raw_articles(documents).select("position", "url", "title", "description")
    text = F.concat_ws(" ", "title", "description")
    return phrases.match_phrases(articles, _phrases_of_titles(documents), text).select("phrase", "position", "url")


@query
def landed_articles(spark, d):
    """The feeds read back from landed JSON files."""
    path = work_path(spark, "landing-articles")
    fx.raw_articles(fx.load(spark, d, "documents")).write.json(path)
    return art.normalise_articles(
        _feeds(read_articles(spark, path)), fx.instant(fx.CYCLE_TIME)
    )


@query
def landed_bars(spark, d):
    """Bars landed with volumes spelled as decimals, as feeds deliver them."""
    path = work_path(spark, "landing-bars")
    _hourly(spark, d).drop("price_range").withColumn(
        "volume", F.col("volume").cast("double")).write.json(path)
    return brs.normalise_bars(
        read_bars(spark, path), fx.EVENT_TICKERS, fx.instant(fx.CYCLE_TIME)
    )


@query
def bronze_parse_prices(spark, d):
    return parse_messages(fx.price_envelope(_hourly(spark, d)), PRICE_PAYLOAD)


@query
def bronze_parse_news(spark, d):
    return parse_messages(fx.news_envelope(fx.load(spark, d, "documents")), NEWS_PAYLOAD)


# Streaming ---------------------------------------------------------------


@query
def stream_bronze_prices(spark, d):
    """Landed price messages streamed into bronze, then read as a table."""
    lake = Lake(work_path(spark, "lake"))
    landing = work_path(spark, "landing-prices")
    fx.price_envelope(_hourly(spark, d)).write.parquet(landing)
    run_to_end([
        start_prices(read_envelope_files(spark, landing), lake, fmt="parquet",
                     trigger=Trigger(available=True))
    ])
    return read_table(spark, lake.bronze("prices"), "parquet")


@query
def stream_news_cycle(spark, d):
    """Landed article files streamed into messages, all files in one cycle."""
    landing, sent = work_path(spark, "landing-articles"), work_path(spark, "messages")
    fx.raw_articles(fx.load(spark, d, "documents")).write.json(landing)
    run_to_end([
        start_cycles(
            stream_articles(spark, landing),
            lambda batch: news_messages(batch, fx.instant(fx.CYCLE_TIME), fx.PHRASES),
            lambda messages: messages.write.mode("append").parquet(sent),
            work_path(spark, "checkpoint"), Trigger(available=True),
        )
    ])
    return _opened(spark.read.parquet(sent), NEWS_PAYLOAD)


@query
def stream_unseen_urls(spark, d):
    """Urls of articles that land twice, in two runs of one streaming query."""
    landing, sent, checkpoint = (work_path(spark, x) for x in ("landing-articles", "sent", "checkpoint"))
    articles = fx.raw_articles(fx.load(spark, d, "documents"))
    for _ in range(2):
        articles.write.mode("append").json(landing)
        run_to_end([
            start_cycles(
                unseen(stream_articles(spark, landing).filter(F.col("url").isNotNull()), "7 days"),
                lambda batch: batch.select("url"),
                lambda batch: batch.write.mode("append").parquet(sent),
                checkpoint, Trigger(available=True),
            )
        ])
    return read_table(spark, sent, "parquet")


@query
def stream_bronze_news(spark, d):
    """The document table itself as a stream of messages, appended to bronze."""
    lake = Lake(work_path(spark, "lake"))
    schema = fx.load(spark, d, "documents").schema
    # The pattern lets the table be a single file as well as a folder of files.
    documents = spark.readStream.schema(schema).parquet(f"{d}/documents.parquet*")
    run_to_end([
        start_news(fx.news_envelope(documents), lake, fmt="parquet",
                   trigger=Trigger(available=True))
    ])
    return read_table(spark, lake.bronze("news"), "parquet")


@query
def sorted_messages(spark, d):
    """Every streamed message once: in bronze, or beside it with the reason."""
    lake = Lake(work_path(spark, "lake"))
    landing = work_path(spark, "landing-news")
    fx.broken_news_envelope(fx.load(spark, d, "documents")).write.parquet(landing)
    run_to_end([start_sorted_news(read_envelope_files(spark, landing), lake, fmt="parquet",
                                  trigger=Trigger(available=True))])
    bronze = read_table(spark, lake.bronze("news"), "parquet").select(
        "kafka_offset", "title", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("raw_value"))
    beside = read_table(spark, lake.rejects("news"), "parquet").select(
        "kafka_offset", F.lit(None).cast("string").alias("title"), "reason", "raw_value")
    return bronze.unionByName(beside)


# Vectors -----------------------------------------------------------------


@query
def compose_text(spark, d):
    return embed.article_texts(silver.silver_news(_bronze_news(spark, d))).select("url", "text")


@query
def vector_normalise(spark, d):
    vectors = fx.load(spark, d, "embeddings")
    return vectors.select(
        "vec_id", F.posexplode(l2_normalise(F.col("embedding"))).alias("pos", "component")
    ).withColumn("component", F.round("component", 6))


@query
def embed_documents(spark, d):
    """Vector table of all silver news, one row per component."""
    vectors = embed.build_vectors(silver.silver_news(_bronze_news(spark, d)))
    return vectors.select(
        "vec_id", F.posexplode("embedding").alias("pos", "component")
    ).withColumn("component", F.round(F.col("component").cast("double"), 5))


@query
def refreshed_vectors(spark, d):
    """The vector table again, with half of its texts' vectors taken from an earlier one."""
    news = stored(silver.silver_news(_bronze_news(spark, d)), "silver")
    earlier = stored(embed.build_vectors(news.filter(F.col("kafka_offset") % 2 == 0)), "vectors")
    return embed.refresh_vectors(news, earlier).select(
        "vec_id", F.posexplode("embedding").alias("pos", "component")
    ).withColumn("component", F.round(F.col("component").cast("double"), 5))


@query
def knn_search(spark, d):
    """The stored vectors nearest to the mean vector of every label."""
    vectors = fx.load(spark, d, "embeddings")
    return search.knn_search(_label_centres(vectors), vectors).withColumn(
        "score", F.round("score", 6)
    )


@query
def knn_citations(spark, d):
    """Hits as text, with the documents of the same id as their articles."""
    vectors = fx.load(spark, d, "embeddings")
    articles = fx.bronze_news(fx.load(spark, d, "documents")).withColumnRenamed(
        "kafka_offset", "vec_id"
    )
    hits = search.knn_search(_label_centres(vectors), vectors)
    text = embed.compose_text(F.col("title"), F.col("description"), F.col("content"))
    return search.citations(search.with_metadata(hits, articles).withColumn("text", text))


@query
def news_search(spark, d):
    """Benchmark texts as questions to the index of all silver news."""
    return search_news(_questions(spark, d), _news_vectors(spark, d))


@query
def news_answers(spark, d):
    """All hits of a question in one text."""
    return search_answers(_questions(spark, d), _news_vectors(spark, d))


@query
def index_stats(spark, d):
    vectors = fx.load(spark, d, "embeddings").withColumn(
        "title", F.concat(F.lit("vector "), "vec_id")
    )
    return embed.index_stats(vectors, SAMPLE_TITLES).withColumn(
        "sample_titles", F.array_join("sample_titles", " | ")
    )


# Daily bars --------------------------------------------------------------


@query
def daily_bars(spark, d):
    return brs.daily_bars(_hourly(spark, d))


@query
def daily_part_bars(spark, d):
    return brs.daily_bars(fx.part_bars(fx.load(spark, d, "lineitem")))


@query
def recent_daily_bars(spark, d):
    return brs.recent_daily_bars(brs.daily_bars(_hourly(spark, d)))


@query
def bar_year_ranges(spark, d):
    """52-week high and low at every hourly bar."""
    return serving.year_ranges(stored(_hourly(spark, d), "bars")).select(
        "ticker", "bar_time_ts", "high", "low", "year_high", "year_low")


@query
def part_week_ranges(spark, d):
    """High and low of the last seven days at every bar of the largest table, with gaps."""
    bars = stored(fx.part_bars(fx.load(spark, d, "lineitem")), "bars")
    return serving.year_ranges(bars, days=7).select("ticker", "bar_time_ts", "year_high", "year_low")


@query
def price_snapshot(spark, d):
    daily = brs.daily_bars(fx.part_bars(fx.load(spark, d, "lineitem")))
    return serving.price_snapshot(daily)


@query
def price_snapshot_text(spark, d):
    return serving.snapshot_text(serving.price_snapshot(brs.daily_bars(_hourly(spark, d))))


@query
def price_answers(spark, d):
    """Price texts for every event type and every event user's name as tickers.

    No bars exist under a user's name, so those get the note instead.
    """
    snapshot = serving.price_snapshot(brs.daily_bars(_hourly(spark, d)))
    return serving.price_answers(_tickers(spark, d), snapshot)


def _tickers(spark: SparkSession, d: str) -> DataFrame:
    events = fx.load(spark, d, "events")
    users = events.select(F.concat(F.lit("user"), "user_id").alias("ticker"))
    return users.unionAll(events.select(F.col("event_type").alias("ticker")))


# Whole batch -------------------------------------------------------------


_LAKES: dict[tuple, Lake] = {}


def _input_files(spark: SparkSession, d: str) -> tuple:
    """Path, size and time of each file of the tables that a lake is built from."""
    paths = [f"{d}/{table}.parquet" for table in ("documents", "events")]
    files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    return tuple(sorted(tuple(row) for row in files.collect()))


def _lake_after_batch(spark: SparkSession, d: str, **options) -> Lake:
    """A lake after one batch run, shared by the queries of a session while the tables' files stay."""
    key = (spark.sparkContext.applicationId, d, _input_files(spark, d), *sorted(options.items()))
    lake = _LAKES.get(key)
    if lake is None or not table_exists(spark, lake.gold("gold_daily_sentiment"), "parquet"):
        lake = Lake(work_path(spark, "lake"))
        write_table(_bronze_news(spark, d), lake.bronze("news"), "parquet")
        write_table(_bronze_prices(spark, d), lake.bronze("prices"), "parquet")
        run_batch(spark, lake, "parquet", **options)
        _LAKES[key] = lake
    return lake


@query
def run_batch_anomalies(spark, d):
    lake = _lake_after_batch(spark, d)
    return read_gold(spark, lake, "price_anomaly_flags", "parquet")


@query
def run_batch_sentiment(spark, d):
    lake = _lake_after_batch(spark, d)
    return _with_double_proxy(read_gold(spark, lake, "daily_sentiment", "parquet"))


@query
def batch_daily_bars(spark, d):
    """Daily bars from the written silver table, in which some bars are there twice."""
    lake = _lake_after_batch(spark, d, keep="last")
    return brs.daily_bars(read_table(spark, lake.silver("prices"), "parquet"))


@query
def batch_price_answers(spark, d):
    """Price texts from the written silver table for all event types and users as tickers."""
    lake = _lake_after_batch(spark, d, keep="last")
    daily = brs.daily_bars(read_table(spark, lake.silver("prices"), "parquet"))
    return serving.price_answers(_tickers(spark, d), serving.price_snapshot(daily))


@query
def batch_latest_anomalies(spark, d):
    """Latest rows of the written gold table, with one row per instant, the last poll's."""
    lake = _lake_after_batch(spark, d, keep="last", by_instant=True)
    return serving.latest_anomalies(read_gold(spark, lake, "price_anomaly_flags", "parquet"))


@query
def batch_newest_anomalies(spark, d):
    """The same latest rows from the newest days of the gold table alone."""
    lake = _lake_after_batch(spark, d, keep="last", by_instant=True)
    return latest_rows(spark, lake, "price_anomaly_flags", "parquet")


@query
def lake_search(spark, d):
    """Benchmark texts as questions to the lake's own vector table."""
    lake = _lake_after_batch(spark, d)
    if not table_exists(spark, lake.vectors, "parquet"):
        build_vector_table(spark, lake, "parquet")
    return search_lake(spark, lake, _questions(spark, d), fmt="parquet")


@query
def indexed_lake_search(spark, d):
    """The lake's answers by the index of its vectors."""
    lake = _lake_after_batch(spark, d, keep="last")
    build_vector_table(spark, lake, "parquet", index=True)
    return search_lake(spark, lake, _questions(spark, d), fmt="parquet")


@query
def blocked_search(spark, d):
    """The same hits when the questions come in several blocks."""
    vectors = fx.load(spark, d, "embeddings")
    centres = _label_centres(vectors)
    return search.knn_search(centres, vectors, max_bytes=2_000).withColumn(
        "score", F.round("score", 6)
    )


@query
def pruned_search(spark, d):
    """The same hits from blocks that cannot be left out."""
    vectors = fx.load(spark, d, "embeddings")
    index = annuli.build_index(vectors)
    return annuli.annulus_search(_label_centres(vectors), index).withColumn("score", F.round("score", 6))


@query
def sql_over_path(spark, d):
    """A table addressed by its path in SQL."""
    path = work_path(spark, "silver-news")
    silver.silver_news(_bronze_news(spark, d)).write.parquet(path)
    return spark.sql(
        f"""SELECT source_name, count(*) AS n_articles, max(published_at_ts) AS newest
            FROM {sql_path(path, "parquet")} GROUP BY source_name"""
    )


# Increments --------------------------------------------------------------


def _by_arrival(bronze: DataFrame, parts: int = 3) -> list[DataFrame]:
    """Bronze rows in order of arrival, cut into stretches of equal time."""
    bounds = bronze.agg(F.min("kafka_timestamp").alias("a"), F.max("kafka_timestamp").alias("b")).first()
    step = (bounds["b"] - bounds["a"]) / parts
    cuts = [bounds["a"] + step * k for k in range(1, parts)]
    number = sum((F.when(F.col("kafka_timestamp") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    return [bronze.filter(number == k) for k in range(parts)]


def _by_key(bronze: DataFrame, *key: str, parts: int = 3) -> list[DataFrame]:
    """Bronze rows by a hash of their key, so that most rows of later parts come late."""
    return [bronze.filter(F.pmod(F.xxhash64(*key), F.lit(parts)) == k) for k in range(parts)]


def _flags_of_increments(spark: SparkSession, batches: list[DataFrame]) -> DataFrame:
    lake = Lake(work_path(spark, "lake"))
    for number, batch in enumerate(batches):
        apply_prices(spark, lake, batch, number, "parquet")
    return read_gold(spark, lake, "price_anomaly_flags", "parquet")


@query
def increment_anomalies(spark, d):
    """Flags after three increments in order of arrival."""
    return _flags_of_increments(spark, _by_arrival(stored(_bronze_prices(spark, d), "bronze")))


@query
def late_increment_anomalies(spark, d):
    """Flags after three increments that re-open nearly every day."""
    return _flags_of_increments(spark, _by_key(stored(_bronze_prices(spark, d), "bronze"), "ticker", "bar_time"))


def _lake_of_news_increments(spark: SparkSession, d: str) -> Lake:
    lake = Lake(work_path(spark, "lake"))
    for number, batch in enumerate(_by_arrival(stored(_bronze_news(spark, d), "bronze"))):
        apply_news(spark, lake, batch, number, "parquet")
    return lake


@query
def increment_silver_news(spark, d):
    """Silver news after three increments that asked the key index."""
    news = read_table(spark, _lake_of_news_increments(spark, d).silver("news"), "parquet")
    return news.drop("seen_date", "increment")


@query
def increment_sentiment(spark, d):
    """Daily attention added up over three increments."""
    lake = _lake_of_news_increments(spark, d)
    return _with_double_proxy(read_gold(spark, lake, "daily_sentiment", "parquet"))
