"""Streaming ingest, the batch run and the session."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from helpers import bronze_news, bronze_prices, column, price_rows, ts
from pyspark.sql import functions as F

from tickstream import fixtures as fx
from tickstream.constants import NO_ARTICLES
from tickstream.operators.bars import daily_bars
from tickstream.operators.embed import build_vectors
from tickstream.operators.envelope import parse_messages
from tickstream.operators.gold import daily_sentiment, price_anomaly_flags
from tickstream.operators.silver import silver_news, silver_prices
from tickstream.plans.batch import build_vector_table, run_batch
from tickstream.plans.ingest import price_messages
from tickstream.plans.reports import (
    index_report,
    latest_rows,
    latest_rows_text,
    live_prices,
    search_answers,
    search_lake,
)
from tickstream.schemas import ENVELOPE, NEWS_PAYLOAD, PRICE_PAYLOAD, VECTORS
from tickstream.session import ARROW_BYTES, shared_dir, shuffle_partitions, work_path
from tickstream.sources.kafka import read_envelope_files
from tickstream.sources.landing import stream_bars
from tickstream.sources.tables import (
    Lake,
    TableNotFound,
    read_gold,
    read_table,
    register_views,
    write_table,
)
from tickstream.streaming.cycles import start_cycles
from tickstream.streaming.ingest import (
    describe,
    run_to_end,
    run_until_one_ends,
    start_news,
    start_prices,
)
from tickstream.streaming.triggers import Trigger

ONCE = {"fmt": "parquet", "trigger": Trigger(available=True)}


def land(spark, path, values, first_offset=0):
    rows = [(b"k", v.encode(), "t", 0, first_offset + i, ts("2026-04-24T09:30:00"), 0)
            for i, v in enumerate(values)]
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.mode("append").parquet(path)


def test_restart_adds_each_message_once(spark, tmp_path):
    lake, landing = Lake(str(tmp_path / "lake")), str(tmp_path / "landing")
    land(spark, landing, ['{"ticker":"A","volume":1}', "broken"])

    def ingest():
        run_to_end([start_prices(read_envelope_files(spark, landing), lake, **ONCE)])
        return read_table(spark, lake.bronze("prices"), "parquet")

    assert sorted(column(ingest(), "kafka_offset")) == [0, 1]
    assert sorted(column(ingest(), "kafka_offset")) == [0, 1]
    land(spark, landing, ['{"ticker":"B"}'], first_offset=2)
    out = ingest()
    assert sorted(column(out, "kafka_offset")) == [0, 1, 2]
    assert sorted(column(out, "ticker"), key=str) == ["A", "B", None]


def test_two_streams_side_by_side(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    land(spark, str(tmp_path / "p"), ['{"ticker":"A"}'] * 3)
    land(spark, str(tmp_path / "n"), ['{"title":"t","url":"u"}'] * 2)
    queries = [
        start_prices(read_envelope_files(spark, str(tmp_path / "p"), 1), lake,
                     name="prices", **ONCE),
        start_news(read_envelope_files(spark, str(tmp_path / "n")), lake, name="news",
                   keep_raw=True, **ONCE),
    ]
    run_to_end(queries)
    assert [describe(q)["name"] for q in queries] == ["prices", "news"]
    assert describe(queries[0])["input_rows"] == 3
    assert not describe(queries[0])["active"]
    assert read_table(spark, lake.bronze("prices"), "parquet").count() == 3
    news = read_table(spark, lake.bronze("news"), "parquet")
    assert column(news, "raw_value") == ['{"title":"t","url":"u"}'] * 2


def test_all_stop_when_one_fails(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    land(spark, str(tmp_path / "p"), ['{"ticker":"A"}'])
    land(spark, str(tmp_path / "n"), ['{"title":"t"}'])
    broken = read_envelope_files(spark, str(tmp_path / "n")).withColumn(
        "value", F.raise_error(F.lit("boom")).cast("binary")
    )
    queries = [
        start_prices(read_envelope_files(spark, str(tmp_path / "p")), lake, fmt="parquet",
                     trigger=Trigger(every="1 second")),
        start_news(broken, lake, fmt="parquet"),
    ]
    with pytest.raises(Exception, match="boom"):
        run_until_one_ends(queries)
    assert not any(q.isActive for q in queries)


def test_cycles_send_every_landed_file_once(spark, tmp_path):
    landing, sent = tmp_path / "landing", str(tmp_path / "sent")
    landing.mkdir()
    line = ('{"ticker":"%s","bar_time_ts":"2026-04-24T03:00:00.000Z","open":1.0,"high":2.0,'
            '"low":0.5,"close":1.5,"volume":2}\n')

    def cycle():
        run_to_end([start_cycles(
            stream_bars(spark, str(landing)), price_messages,
            lambda messages: messages.write.mode("append").parquet(sent),
            str(tmp_path / "checkpoint"), Trigger(available=True), "cycles",
        )])
        keys = spark.read.parquet(sent).select(F.col("key").cast("string").alias("k"))
        return sorted(column(keys, "k"))

    (landing / "1.json").write_text(line % "NVDA" + line % "other")
    assert cycle() == ["NVDA|2026-04-24T03:00:00+00:00"]
    (landing / "2.json").write_text(line % "AMD")
    assert cycle() == ["AMD|2026-04-24T03:00:00+00:00", "NVDA|2026-04-24T03:00:00+00:00"]


def test_cycles_report_what_was_sent(spark, tmp_path):
    landing, counts = tmp_path / "landing", {}
    landing.mkdir()
    (landing / "1.json").write_text(
        '{"ticker":"NVDA","bar_time_ts":"2026-04-24T03:00:00.000Z","close":1.5,"volume":1234.0}\n')

    def send(messages):
        return write_table(messages, str(tmp_path / "sent"), "parquet")

    run_to_end([start_cycles(
        stream_bars(spark, str(landing), 1), price_messages, send, str(tmp_path / "checkpoint"),
        Trigger(available=True), report=lambda number, sent: counts.update({number: sent}),
    )])
    assert counts == {0: 1}
    value = spark.read.parquet(str(tmp_path / "sent")).select(F.col("value").cast("string")).first()[0]
    assert '"volume":1234' in value and "1234.0" not in value


def test_polled_twice_counts_once(spark, tmp_path):
    """Two polls of one bar, its time and ticker spelled in two ways."""
    lake = Lake(str(tmp_path))
    bronze_prices(
        spark,
        {"ticker": "nv", "volume": 10, "close": 2.0},
        {"ticker": "NV", "volume": 30, "close": 3.0, "bar_time": "2026-04-24T05:00:00+02:00",
         "kafka_timestamp": ts("2026-04-24T05:00:00")},
        {"ticker": "NV", "volume": 5, "close": 4.0, "bar_time": "2026-04-24T04:00:00Z"},
    ).write.parquet(lake.bronze("prices"))
    bronze_news(spark, {}).write.parquet(lake.bronze("news"))
    counts = run_batch(spark, lake, "parquet")
    assert (counts["bronze_prices"], counts["silver_prices"]) == (3, 3)
    (day,) = daily_bars(read_table(spark, lake.silver("prices"), "parquet")).collect()
    assert (day.ticker, day.volume, day.close) == ("NV", 35, 4.0)
    (answer,) = live_prices(spark, lake, ["nv"], fmt="parquet").collect()
    assert answer.ticker == "NV" and "Volume: 35" in answer.answer


def test_latest_anomalies_can_have_one_row_per_bar(spark, tmp_path):
    lake = Lake(str(tmp_path))
    fx.bronze_news(fx.load(spark, SF_DIR, "documents")).limit(5).write.parquet(lake.bronze("news"))
    bars = fx.hourly_bars(fx.load(spark, SF_DIR, "events"))
    fx.bronze_prices(bars).write.parquet(lake.bronze("prices"))
    run_batch(spark, lake, "parquet", keep="last", by_instant=True)
    top = latest_rows(spark, lake, "price_anomaly_flags", "parquet")
    assert top.count() == top.select("ticker", "bar_time_ts").distinct().count() == 20


def test_live_prices_skip_other_days_and_tickers(spark, tmp_path):
    lake = Lake(str(tmp_path))
    bronze_prices(spark, {}, {"bar_time": "2026-04-25T03:00:00Z"}).write.parquet(lake.bronze("prices"))
    bronze_news(spark, {}).write.parquet(lake.bronze("news"))
    run_batch(spark, lake, "parquet")
    as_of = F.lit(ts("2026-04-24T10:00:00"))
    plan = live_prices(spark, lake, ["a"], as_of, "parquet")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "symbol" in line)
    assert "PartitionFilters: [isnotnull(bar_date" in scan and "2026-04-24" in scan
    assert "PushedFilters: [IsNotNull(bar_time_ts), IsNotNull(symbol), EqualTo(symbol,A)" in scan or (
        "EqualTo(symbol,A)" in scan)
    flags = read_gold(spark, lake, "price_anomaly_flags", "parquet").filter("bar_date = DATE '2026-04-24'")
    assert "PartitionFilters: [isnotnull(bar_date" in flags._jdf.queryExecution().executedPlan().toString()


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    assert write_table(spark.range(4), path, "parquet") == 4
    broken = spark.range(4).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        write_table(broken, path, "parquet")
    assert read_table(spark, path, "parquet").count() == 4
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["table"]


def test_search_without_an_index_says_what_to_do(spark, tmp_path):
    questions = spark.createDataFrame([(1, "x")], "query_id bigint, text string")
    with pytest.raises(TableNotFound, match="build_vector_table"):
        search_lake(spark, Lake(str(tmp_path)), questions, fmt="parquet")


def test_run_batch(spark, tmp_path):
    lake = Lake(str(tmp_path))
    fx.bronze_news(fx.load(spark, SF_DIR, "documents")).write.parquet(lake.bronze("news"))
    bars = fx.hourly_bars(fx.load(spark, SF_DIR, "events"))
    fx.bronze_prices(bars).write.parquet(lake.bronze("prices"))

    first = run_batch(spark, lake, "parquet")
    assert first == run_batch(spark, lake, "parquet")
    for name in ("news", "prices"):
        silver = read_table(spark, lake.silver(name), "parquet")
        assert silver.count() == first[f"silver_{name}"]
        assert "silver_processed_at" in silver.columns
    flags = read_gold(spark, lake, "price_anomaly_flags", "parquet")
    assert flags.count() == first["price_anomaly_flags"] == first["silver_prices"]
    days = read_gold(spark, lake, "daily_sentiment", "parquet")
    dated = read_table(spark, lake.silver("news"), "parquet").filter("published_at_ts IS NOT NULL")
    assert days.agg(F.sum("article_count")).first()[0] == dated.count()

    # Within a file, rows are stored by ticker and time.
    files: dict[str, list] = {}
    for r in flags.select("ticker", "bar_time_ts", F.input_file_name().alias("f")).collect():
        files.setdefault(r.f, []).append((r.ticker, r.bar_time_ts))
    assert all(rows == sorted(rows) for rows in files.values())

    n = build_vector_table(spark, lake, "parquet")
    vectors = read_table(spark, lake.vectors, "parquet")
    assert vectors.columns == VECTORS.fieldNames()
    assert vectors.count() == n == first["silver_news"]
    assert vectors.select("vec_id").distinct().count() == n

    # What users ask.
    views = register_views(spark, lake, "parquet")
    assert views == [
        "bronze_news", "bronze_prices", "silver_news", "silver_prices",
        "gold_price_anomaly_flags", "gold_daily_sentiment", "news_vectors",
    ]
    (top,) = spark.sql(
        "SELECT ticker, count(*) AS n FROM gold_price_anomaly_flags WHERE is_anomaly "
        "GROUP BY ticker ORDER BY n DESC, ticker LIMIT 1"
    ).collect()
    assert top.n == flags.filter("is_anomaly").groupBy("ticker").count().agg(
        F.max("count")).first()[0]
    assert latest_rows(spark, lake, "price_anomaly_flags", "parquet").count() == 20
    assert "attention_score_proxy" in latest_rows_text(spark, lake, "daily_sentiment", "parquet")
    prices = live_prices(spark, lake, ["Click ", "none"], fmt="parquet").collect()
    answers = {p.ticker: p.answer for p in prices}
    assert answers["CLICK"].startswith("Ticker: CLICK\nLatest Close: USD ")
    assert answers["NONE"] == "No price data available for NONE. Market may be closed."
    report = index_report(spark, lake, "parquet")
    assert (report["status"], report["articles_indexed"]) == ("healthy", n)
    assert len(report["sample_titles"]) == 3
    some = vectors.orderBy("vec_id").first()
    questions = spark.createDataFrame([(1, some.text)], "query_id bigint, text string")
    (answer,) = search_answers(questions, vectors).collect()
    assert answer.answer.startswith("[1] ") and answer.answer.count("Relevance: ") == 5
    assert "Relevance: 1.000" in answer.answer
    (nothing,) = search_answers(questions, vectors.limit(0)).collect()
    assert nothing.answer == NO_ARTICLES


def test_reports_before_anything_is_stored(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert index_report(spark, lake, "parquet")["status"] == "degraded"
    assert register_views(spark, lake, "parquet") == []
    flags = price_anomaly_flags(price_rows(spark, []))
    write_table(flags, lake.gold("gold_price_anomaly_flags"), "parquet")
    text = latest_rows_text(spark, lake, "price_anomaly_flags", "parquet")
    assert text == "Table 'price_anomaly_flags' exists but contains no data yet."


def test_flags_are_written_without_a_total_order(spark):
    flags = price_anomaly_flags(price_rows(spark, [1, 2]))
    plan = flags.sortWithinPartitions("ticker", "bar_time_ts")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "rangepartitioning" not in text
    # Rows without the lead-in of their span meet in one shuffle, for the window.
    assert text.count("hashpartitioning(ticker") <= 3


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions(10 << 20) == 200
    assert shuffle_partitions(1 << 40) == 2048
    assert shuffle_partitions(100 << 40) == 204_800
    assert shuffle_partitions(100 << 40, 1 << 30) == 102_400


def test_arrow_batches_are_bounded_in_every_session(spark):
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(ARROW_BYTES)


CONTRACT = {
    "bronze_prices": (
        "ingested_at string, ticker string, bar_time string, open double, high double, "
        "low double, close double, volume bigint, kafka_timestamp timestamp, "
        "kafka_partition int, kafka_offset bigint, spark_written_at timestamp"
    ),
    "bronze_news": (
        "ingested_at string, source_name string, author string, title string, "
        "description string, url string, published_at string, content string, "
        "kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint, "
        "spark_written_at timestamp"
    ),
}
CONTRACT["silver_prices"] = CONTRACT["bronze_prices"] + (
    ", bar_time_ts timestamp, ingested_at_ts timestamp, price_range double, "
    "silver_processed_at timestamp"
)
CONTRACT["silver_news"] = CONTRACT["bronze_news"] + (
    ", published_at_ts timestamp, ingested_at_ts timestamp, silver_processed_at timestamp"
)
CONTRACT["gold_price_anomaly_flags"] = (
    "ticker string, bar_time_ts timestamp, bar_date date, open double, high double, "
    "low double, close double, volume bigint, price_range double, volume_zscore double, "
    "range_zscore double, is_anomaly boolean, gold_processed_at timestamp"
)
CONTRACT["gold_daily_sentiment"] = (
    "published_date date, article_count bigint, source_diversity bigint, "
    "attention_score_proxy decimal(24,2), last_updated timestamp"
)
CONTRACT["news_vectors"] = (
    "vec_id bigint, embedding array<float>, title string, url string, source_name string, "
    "published_at string, text string"
)


def test_table_contracts(spark):
    events, documents = (fx.load(spark, SF_DIR, t) for t in ("events", "documents"))
    tables = {
        "bronze_prices": parse_messages(fx.price_envelope(fx.hourly_bars(events)), PRICE_PAYLOAD),
        "bronze_news": parse_messages(fx.news_envelope(documents), NEWS_PAYLOAD),
    }
    tables["silver_prices"] = silver_prices(tables["bronze_prices"])
    tables["silver_news"] = silver_news(tables["bronze_news"])
    tables["gold_price_anomaly_flags"] = price_anomaly_flags(
        tables["silver_prices"], split_rows=None
    )
    tables["gold_daily_sentiment"] = daily_sentiment(tables["silver_news"])
    tables["news_vectors"] = build_vectors(tables["silver_news"])
    for name, ddl in CONTRACT.items():
        got = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tables[name].schema)
        assert got == ddl, name


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert work_path(spark, "x") != work_path(spark, "x")
