"""DuckDB SQL giving the same rows as the queries in ``registry``."""

from __future__ import annotations

# Named subqueries, in dependency order. Each text may use those before it.
PARTS = {
    "bars": """
        SELECT event_type AS ticker, date_trunc('hour', ts) AS bar_time_ts,
               arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
               arg_max(value, (ts, event_id)) AS close, count(*) AS volume,
               max(value) - min(value) AS price_range
        FROM events GROUP BY ALL""",
    "part_bars": """
        SELECT 'P' || l_partkey AS ticker, l_shipdate AS bar_time_ts,
               arg_min(price, line) AS open, max(price) AS high, min(price) AS low,
               arg_max(price, line) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume,
               max(price) - min(price) AS price_range
        FROM (SELECT *, l_extendedprice / l_quantity AS price,
                     l_orderkey * 8 + l_linenumber AS line FROM lineitem)
        GROUP BY l_partkey, l_shipdate""",
    "bronze_prices": """
        SELECT strftime(arrival, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingested_at, ticker,
               CASE WHEN poll = 3
                    THEN strftime(bar_time_ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S+01:00')
                    ELSE strftime(bar_time_ts, '%Y-%m-%dT%H:%M:%SZ') END AS bar_time,
               open, high, low,
               CASE WHEN poll > 1 OR volume > 1 THEN close END AS close,
               volume - CASE WHEN poll = 1 THEN 1 ELSE 0 END AS volume,
               arrival AS kafka_timestamp, CAST(poll AS INTEGER) AS kafka_partition,
               CAST(epoch(bar_time_ts) / 3600 AS BIGINT) AS kafka_offset,
               bar_time_ts
        FROM (SELECT *, bar_time_ts + to_hours(poll) AS arrival
              FROM bars, (VALUES (1), (2), (3)) AS polls(poll)
              WHERE poll < 3 OR volume >= 4)""",
    "silver_prices": """
        SELECT * EXCLUDE (rn, bar_time_ts), bar_time_ts, kafka_timestamp AS ingested_at_ts,
               high - low AS price_range
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker, bar_time ORDER BY
                        kafka_timestamp, kafka_partition, kafka_offset) AS rn
              FROM bronze_prices
              WHERE close IS NOT NULL AND ticker IS NOT NULL AND bar_time IS NOT NULL)
        WHERE rn = 1""",
    "articles": """
        SELECT strftime(arrival, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingested_at,
               nullif(source, 'src0') AS source_name, lang || ' desk' AS author,
               CASE WHEN n_chars < 40 THEN '[Removed]'
                    WHEN n_lines > 1 OR n_chars < 400 THEN split_part(text, chr(10), 1)
               END AS title,
               nullif(split_part(text, chr(10), 2), '') AS description,
               CASE WHEN source <> 'src2' OR n_lines > 1
                    THEN 'https://news.example/' || md5(text) END AS url,
               CASE WHEN n_lines = 1 THEN 'n/a'
                    WHEN lang = 'de' THEN strftime(published + INTERVAL 1 HOUR,
                                                   '%Y-%m-%dT%H:%M:%S+01:00')
                    WHEN lang = 'fr' THEN strftime(published, '%Y-%m-%dT%H:%M:%S.000000+00:00')
                    ELSE strftime(published, '%Y-%m-%dT%H:%M:%SZ') END AS published_at,
               CASE WHEN source <> 'src1' THEN text || ' [+' || n_chars || ' chars]' END
                    AS content,
               arrival, CASE WHEN n_lines > 1 THEN published END AS published_at_ts,
               CASE WHEN n_lines > 3 THEN 'business' ELSE 'general' END AS category,
               lang AS language, doc_id AS position
        FROM (SELECT *, len(string_split(text, chr(10))) AS n_lines,
                     TIMESTAMP '2024-01-01' + to_minutes(n_chars) AS published,
                     TIMESTAMP '2024-04-01'
                     + to_minutes(n_chars + CAST(substr(source, 4) AS INTEGER)) AS arrival
              FROM documents)""",
    "bronze_news": """
        SELECT ingested_at, source_name, author, title, description, url, published_at,
               content, arrival AS kafka_timestamp, 0 AS kafka_partition,
               position AS kafka_offset, published_at_ts
        FROM articles""",
    "silver_news": """
        SELECT * EXCLUDE (rn), kafka_timestamp AS ingested_at_ts
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY
                        kafka_timestamp, kafka_partition, kafka_offset) AS rn
              FROM bronze_news
              WHERE title IS NOT NULL AND url IS NOT NULL AND title <> '[Removed]')
        WHERE rn = 1""",
    "sentiment": """
        SELECT CAST(published_at_ts AS DATE) AS published_date, count(*) AS article_count,
               count(DISTINCT source_name) AS source_diversity,
               round(count(*) / 10.0, 2) AS attention_score_proxy
        FROM silver_news WHERE published_at_ts IS NOT NULL GROUP BY 1""",
    "searched": """
        SELECT *, string_split_regex(lower(concat_ws(' ', title, description)),
                                     '[^\\p{L}\\p{N}]+') AS tokens
        FROM articles
        WHERE language = 'en' AND published_at_ts >= TIMESTAMP '2024-01-02'""",
    "feeds": """
        SELECT 0 AS feed, * FROM articles WHERE category = 'business' AND language = 'en'
        UNION ALL
        SELECT 1, * EXCLUDE (tokens) FROM searched WHERE list_has_all(tokens, ['the', 'and'])
        UNION ALL
        SELECT 2, * EXCLUDE (tokens) FROM searched WHERE list_has_all(tokens, ['that', 'of'])""",
    "payload": """
        SELECT '2024-01-03T12:00:00.000000+00:00' AS ingested_at, source_name, author, title,
               description, url, published_at, content
        FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY feed, position) AS rn
              FROM feeds
              WHERE title <> '' AND title <> '[Removed]' AND url IS NOT NULL)
        WHERE rn = 1""",
    "bar_payload": """
        SELECT '2024-01-03T12:00:00.000000+00:00' AS ingested_at, ticker,
               strftime(bar_time_ts, '%Y-%m-%dT%H:%M:%S+00:00') AS bar_time,
               round(open, 4) AS open, round(high, 4) AS high, round(low, 4) AS low,
               round(close, 4) AS close, volume
        FROM bars""",
    "texts": """
        SELECT kafka_offset AS vec_id, title, url, source_name, published_at,
               concat_ws(' | ', 'Title: ' || nullif(title, ''),
                         'Description: ' || nullif(description, ''),
                         'Content: ' || nullif(trim(split_part(content, '[+', 1),
                                                    ' ' || chr(9) || chr(10) || chr(13)), ''))
               AS text
        FROM {news}""",
    "daily": """
        SELECT ticker, CAST(bar_time_ts AS DATE) AS bar_date,
               arg_min(open, bar_time_ts) AS open, max(high) AS high, min(low) AS low,
               arg_max(close, bar_time_ts) AS close, CAST(sum(volume) AS BIGINT) AS volume
        FROM {bars} GROUP BY 1, 2""",
    "snapshot": """
        SELECT ticker, bar_date, close, prev_close, close - prev_close AS change,
               CASE WHEN prev_close <> 0 THEN (close - prev_close) / prev_close * 100 END
                   AS change_pct,
               volume, high, low, year_high, year_low
        FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY bar_date) AS prev_close,
                     max(high) OVER y AS year_high, min(low) OVER y AS year_low,
                     row_number() OVER (PARTITION BY ticker ORDER BY bar_date DESC) AS rn
              FROM daily
              WINDOW y AS (PARTITION BY ticker ORDER BY bar_date
                           RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW))
        WHERE rn = 1""",
    "display": """
        SELECT upper(ticker) AS ticker, 'USD ' || printf('%.2f', close) AS latest_close,
               CASE WHEN change IS NULL THEN ''
                    WHEN change_pct IS NULL THEN sign || printf('%.2f', change)
                    ELSE sign || printf('%.2f', change) || ' (' || sign
                         || printf('%.2f', change_pct) || '%)' END AS daily_change,
               format('{:,}', volume) AS volume, 'USD ' || printf('%.2f', high) AS high,
               'USD ' || printf('%.2f', low) AS low,
               'USD ' || printf('%.2f', year_high) AS year_high,
               'USD ' || printf('%.2f', year_low) AS year_low
        FROM (SELECT *, CASE WHEN change >= 0 THEN '+' ELSE '' END AS sign FROM snapshot)""",
    "rolled": """
        SELECT *, avg(volume) OVER w AS avg_volume, stddev_samp(volume) OVER w AS stddev_volume,
               avg(price_range) OVER w AS avg_range,
               stddev_samp(price_range) OVER w AS stddev_range
        FROM {bars}
        WINDOW w AS (PARTITION BY ticker ORDER BY bar_time_ts, open, high, low, close, volume
                     ROWS 19 PRECEDING)""",
    "flags": """
        SELECT ticker, bar_time_ts, CAST(bar_time_ts AS DATE) AS bar_date, open, high, low,
               close, volume, price_range, round(zv, 3) + 0.0 AS volume_zscore,
               round(zr, 3) + 0.0 AS range_zscore, abs(zv) > 2 OR abs(zr) > 2 AS is_anomaly
        FROM (SELECT *,
                     CASE WHEN stddev_volume > 0
                          THEN (volume - avg_volume) / stddev_volume ELSE 0.0 END AS zv,
                     CASE WHEN stddev_range > 0
                          THEN (price_range - avg_range) / stddev_range ELSE 0.0 END AS zr
              FROM rolled)""",
    "slots": """
        SELECT id, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % 64 AS pos,
               sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1.0 ELSE -1.0 END) AS w
        FROM (SELECT kind || ':' || id AS id, md5(unnest(
                         regexp_extract_all(lower(text), '[0-9A-Za-zÀ-ɏ]+'))) AS h
              FROM (SELECT 'n' AS kind, vec_id AS id, text FROM texts
                    UNION ALL SELECT 'q', item_id, text FROM benchmark))
        GROUP BY ALL""",
    "dense": """
        SELECT id, pos, coalesce(w, 0.0) AS w,
               sqrt(sum(coalesce(w, 0.0) ** 2) OVER (PARTITION BY id)) AS norm
        FROM (SELECT 'n:' || vec_id AS id FROM texts
              UNION ALL SELECT 'q:' || item_id FROM benchmark)
        CROSS JOIN (SELECT range AS pos FROM range(64))
        LEFT JOIN slots USING (id, pos)""",
    "news_vectors": """
        SELECT CAST(substr(id, 3) AS BIGINT) AS vec_id, pos,
               CAST(CASE WHEN norm > 0 THEN w / norm ELSE 0 END AS FLOAT) AS component
        FROM dense WHERE id[1] = 'n'""",
    "unit_vectors": """
        SELECT vec_id, list(CAST(x AS DOUBLE) / n ORDER BY pos) AS v
        FROM (SELECT vec_id, pos, x, sqrt(sum(CAST(x AS DOUBLE) ** 2)
                     OVER (PARTITION BY vec_id)) AS n
              FROM ({components}))
        GROUP BY vec_id""",
    "unit_queries": """
        SELECT query_id, list(x / n ORDER BY pos) AS v
        FROM (SELECT query_id, pos, x, sqrt(sum(x ** 2) OVER (PARTITION BY query_id)) AS n
              FROM ({questions}))
        GROUP BY query_id""",
    "hits": """
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id
                                                 ORDER BY score DESC, vec_id) AS INTEGER)
                             AS rank,
               vec_id, score
        FROM (SELECT query_id, vec_id, round(list_inner_product(q.v, s.v), 9) AS score
              FROM unit_queries q CROSS JOIN unit_vectors s)
        QUALIFY rank <= 5""",
}

STORED_COMPONENTS = (
    "SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos "
    "FROM embeddings"
)
LABEL_CENTRES = (
    "SELECT CAST(label AS BIGINT) AS query_id, pos, avg(CAST(x AS DOUBLE)) AS x "
    "FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos "
    "FROM embeddings) GROUP BY ALL"
)
NEWS_COMPONENTS = "SELECT vec_id, pos, component AS x FROM news_vectors"
QUESTION_COMPONENTS = (
    "SELECT CAST(substr(id, 3) AS BIGINT) AS query_id, pos, w AS x FROM dense WHERE id[1] = 'q'"
)
CITATION = """
    SELECT query_id, rank, vec_id,
           '[' || rank || '] ' || coalesce(title, 'Unknown') || chr(10)
           || '    Source: ' || coalesce(source_name, 'Unknown')
           || ' | Published: ' || coalesce(published_at, 'Unknown')
           || ' | Relevance: ' || printf('%.3f', score) || chr(10)
           || '    ' || substr(coalesce(text, ''), 1, 200) || '...' AS citation
    FROM hits LEFT JOIN texts USING (vec_id)"""

SILVER_PRICE_COLUMNS = (
    "ingested_at, ticker, bar_time, open, high, low, close, volume, kafka_timestamp, "
    "kafka_partition, kafka_offset, bar_time_ts, ingested_at_ts, price_range"
)


def sql(names: str, body: str, **slots: str) -> str:
    """A statement with the named parts in front; slots fill the parts' blanks."""

    def fill(text: str) -> str:
        for slot, value in slots.items():
            text = text.replace("{" + slot + "}", value)
        return text

    parts = [f"{name} AS ({fill(PARTS[name])})" for name in names.split()]
    return "WITH " + ",\n".join(parts) + "\n" + body


FLAGS = "SELECT * FROM flags"
TOP_FLAGS = (
    "SELECT * FROM flags ORDER BY is_anomaly DESC, bar_time_ts DESC, ticker LIMIT 20"
)
NEWS = "articles bronze_news silver_news"
PRICES = "bars bronze_prices silver_prices"
FEEDS = "articles searched feeds"
KNN = "unit_vectors unit_queries hits"

PARSED_NEWS = """
    SELECT value->>'$.ingested_at' AS ingested_at, value->>'$.source_name' AS source_name,
           value->>'$.author' AS author, value->>'$.title' AS title,
           value->>'$.description' AS description, value->>'$.url' AS url,
           value->>'$.published_at' AS published_at, value->>'$.content' AS content,
           kafka_timestamp, kafka_partition, kafka_offset
    FROM (SELECT *, to_json(struct_pack(ingested_at, source_name, author, title, description,
                                        url, published_at, content)) AS value
          FROM bronze_news)"""
PARSED_PRICES = """
    SELECT value->>'$.ingested_at' AS ingested_at, value->>'$.ticker' AS ticker,
           value->>'$.bar_time' AS bar_time, CAST(value->>'$.open' AS DOUBLE) AS open,
           CAST(value->>'$.high' AS DOUBLE) AS high, CAST(value->>'$.low' AS DOUBLE) AS low,
           CAST(value->>'$.close' AS DOUBLE) AS close,
           CAST(value->>'$.volume' AS BIGINT) AS volume,
           kafka_timestamp, kafka_partition, kafka_offset
    FROM (SELECT *, to_json(struct_pack(ingested_at, ticker, bar_time, open, high, low, close,
                                        volume)) AS value
          FROM bronze_prices)"""

PRICE_ANSWERS = sql(
    "bars daily snapshot display",
    """SELECT ticker, CASE WHEN latest_close IS NULL
                   THEN 'No price data available for ' || ticker || '. Market may be closed.'
                   ELSE concat('Ticker: ', ticker, chr(10), 'Latest Close: ', latest_close,
                               chr(10), 'Daily Change: ', daily_change, chr(10), 'Volume: ',
                               volume, chr(10), 'High: ', high, ' | Low: ', low, chr(10),
                               '52-Week High: ', year_high, ' | Low: ', year_low, chr(10))
                   END AS answer
       FROM (SELECT DISTINCT upper(unnest(['user' || user_id, event_type])) AS ticker
             FROM events)
       LEFT JOIN display USING (ticker)""",
    bars="bars",
)

KNN_SEARCH = sql(
    KNN, "SELECT query_id, rank, vec_id, round(score, 6) AS score FROM hits",
    components=STORED_COMPONENTS, questions=LABEL_CENTRES,
)
NEWS_ANSWERS = sql(
    f"{NEWS} texts slots dense news_vectors {KNN}",
    f"""SELECT query_id, string_agg(citation, chr(10) || chr(10) ORDER BY rank) AS answer
        FROM ({CITATION}) GROUP BY query_id""",
    news="silver_news", components=NEWS_COMPONENTS, questions=QUESTION_COMPONENTS,
)

EMBEDDED = sql(
    f"{NEWS} texts slots dense news_vectors",
    """SELECT vec_id, CAST(pos AS INTEGER) AS pos,
              round(CAST(component AS DOUBLE), 5) + 0.0 AS component
       FROM news_vectors""",
    news="silver_news",
)

ORACLE = {
    "price_anomaly_flags": sql("bars rolled flags", FLAGS, bars="bars"),
    "part_anomaly_flags": sql("part_bars rolled flags", FLAGS, bars="part_bars"),
    "split_anomaly_flags": sql("bars rolled flags", FLAGS, bars="bars"),
    "rolling_stats": sql(
        "bars rolled",
        """SELECT ticker, bar_time_ts, round(avg_volume, 6) AS avg_volume,
                  round(stddev_volume, 6) AS stddev_volume, round(avg_range, 6) AS avg_range,
                  round(stddev_range, 6) AS stddev_range FROM rolled""",
        bars="bars",
    ),
    "latest_anomalies": sql("bars rolled flags", TOP_FLAGS, bars="bars"),
    "daily_sentiment": sql(f"{NEWS} sentiment", "SELECT * FROM sentiment"),
    "latest_attention": sql(
        f"{NEWS} sentiment", "SELECT * FROM sentiment ORDER BY published_date DESC LIMIT 10"
    ),
    "silver_news": sql(NEWS, "SELECT * FROM silver_news"),
    "silver_prices": sql(PRICES, f"SELECT {SILVER_PRICE_COLUMNS} FROM silver_prices"),
    "silver_prices_latest": sql(
        "bars bronze_prices",
        f"""SELECT {SILVER_PRICE_COLUMNS}
            FROM (SELECT *, kafka_timestamp AS ingested_at_ts, high - low AS price_range
                  FROM bronze_prices WHERE close IS NOT NULL
                  QUALIFY row_number() OVER (PARTITION BY ticker, bar_time_ts
                                             ORDER BY kafka_timestamp DESC) = 1)""",
    ),
    "stage_counts": sql(
        f"{NEWS} {PRICES}",
        """SELECT 'bronze_news' AS stage, count(*) AS n_rows FROM bronze_news
           UNION ALL SELECT 'silver_news', count(*) FROM silver_news
           UNION ALL SELECT 'bronze_prices', count(*) FROM bronze_prices
           UNION ALL SELECT 'silver_prices', count(*) FROM silver_prices""",
    ),
    "envelope_prices": sql(
        "bars bar_payload",
        "SELECT ticker || '|' || bar_time AS key, 'prices-raw' AS topic, * FROM bar_payload",
    ),
    "envelope_news": sql(
        f"{FEEDS} payload", "SELECT url AS key, 'news-raw' AS topic, * FROM payload"
    ),
    "stream_news_cycle": sql(
        f"{FEEDS} payload", "SELECT url AS key, 'news-raw' AS topic, * FROM payload"
    ),
    "normalise_articles": sql(f"{FEEDS} payload", "SELECT * FROM payload"),
    "landed_articles": sql(f"{FEEDS} payload", "SELECT * FROM payload"),
    "landed_bars": sql("bars bar_payload", "SELECT * FROM bar_payload"),
    "feed_pages": sql(
        FEEDS,
        """SELECT feed, position, url, published_at AS "publishedAt", category FROM feeds
           QUALIFY row_number() OVER (
               PARTITION BY feed
               ORDER BY CASE WHEN feed > 0 THEN published_at_ts END DESC NULLS LAST, position
           ) <= CASE WHEN feed = 0 THEN 20 ELSE 10 END""",
    ),
    "bronze_parse_prices": sql("bars bronze_prices", PARSED_PRICES),
    "bronze_parse_news": sql("articles bronze_news", PARSED_NEWS),
    "stream_bronze_prices": sql("bars bronze_prices", PARSED_PRICES),
    "stream_bronze_news": sql("articles bronze_news", PARSED_NEWS),
    "compose_text": sql(
        f"{NEWS} texts", "SELECT url, text FROM texts WHERE text <> ''", news="silver_news"
    ),
    "vector_normalise": f"""
        SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(
                   CASE WHEN n > 0 THEN CAST(x AS DOUBLE) / n ELSE 0 END, 6) + 0.0 AS component
        FROM (SELECT *, sqrt(sum(CAST(x AS DOUBLE) ** 2) OVER (PARTITION BY vec_id)) AS n
              FROM ({STORED_COMPONENTS}))""",
    "embed_documents": EMBEDDED,
    "refreshed_vectors": EMBEDDED,
    "knn_search": KNN_SEARCH,
    "pruned_search": KNN_SEARCH,
    "knn_citations": sql(
        f"articles bronze_news texts {KNN}", CITATION,
        news="bronze_news", components=STORED_COMPONENTS, questions=LABEL_CENTRES,
    ),
    "news_search": sql(
        f"{NEWS} texts slots dense news_vectors {KNN}", CITATION,
        news="silver_news", components=NEWS_COMPONENTS, questions=QUESTION_COMPONENTS,
    ),
    "news_answers": NEWS_ANSWERS,
    "index_stats": """
        SELECT count(*) AS articles_indexed, CAST(max(len(embedding)) AS INTEGER) AS embedding_dim,
               (SELECT string_agg(title, ' | ' ORDER BY vec_id)
                FROM (SELECT vec_id, 'vector ' || vec_id AS title FROM embeddings
                      ORDER BY vec_id LIMIT 3)) AS sample_titles
        FROM embeddings""",
    "daily_bars": sql("bars daily", "SELECT * FROM daily", bars="bars"),
    "daily_part_bars": sql("part_bars daily", "SELECT * FROM daily", bars="part_bars"),
    "recent_daily_bars": sql(
        "bars daily",
        """SELECT *, CAST(row_number() OVER (PARTITION BY ticker ORDER BY bar_date DESC)
                          AS INTEGER) AS rank
           FROM daily QUALIFY rank <= 5""",
        bars="bars",
    ),
    "price_snapshot": sql(
        "part_bars daily snapshot",
        "SELECT * FROM snapshot",
        bars="part_bars",
    ),
    "price_snapshot_text": sql(
        "bars daily snapshot display", "SELECT * FROM display", bars="bars"
    ),
    "price_answers": PRICE_ANSWERS,
    "run_batch_anomalies": sql(
        f"{PRICES} rolled flags", FLAGS,
        bars="(SELECT ticker, bar_time_ts, open, high, low, close, volume, price_range "
             "FROM silver_prices)",
    ),
    "stream_unseen_urls": sql("articles", "SELECT DISTINCT url FROM articles WHERE url IS NOT NULL"),
    "sorted_messages": sql("articles", """
        SELECT doc_id AS kafka_offset, CASE WHEN reason IS NULL THEN title END AS title, reason,
               CASE WHEN reason = 'not a JSON object' THEN text
                    WHEN reason = 'no known field' THEN to_json({'other': text})::VARCHAR
                    WHEN lang = 'fr' THEN text END AS raw_value
        FROM (SELECT *, CASE WHEN lang = 'fr' AND trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 'no value'
                             WHEN lang = 'fr' THEN 'not a JSON object'
                             WHEN lang = 'de' AND length(text) % 2 = 0 THEN 'no value'
                             WHEN lang = 'de' THEN 'no known field' END AS reason FROM documents) d
        JOIN articles ON position = doc_id"""),
    "phrase_matches": sql("articles", """
        SELECT phrase, position, url
        FROM (SELECT position, url, string_split_regex(lower(concat_ws(' ', title, description)),
                                                       '[^\\p{L}\\p{N}]+') AS tokens FROM articles) a
        JOIN (SELECT DISTINCT array_to_string(
                         string_split_regex(text, '[^\\p{L}\\p{N}]+')[2:3], ' ') AS phrase FROM documents) p
          ON list_has_all(tokens, list_filter(
                 string_split_regex(lower(phrase), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''))
         AND phrase <> ''"""),
    "bar_year_ranges": sql("bars", """
        SELECT ticker, bar_time_ts, high, low, max(high) OVER y AS year_high, min(low) OVER y AS year_low
        FROM bars WINDOW y AS (PARTITION BY ticker ORDER BY bar_time_ts
                               RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW)"""),
    "part_week_ranges": sql("part_bars", """
        SELECT ticker, bar_time_ts, max(high) OVER y AS year_high, min(low) OVER y AS year_low
        FROM part_bars WINDOW y AS (PARTITION BY ticker ORDER BY bar_time_ts
                                    RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)"""),
    "increment_anomalies": sql(
        f"{PRICES} rolled flags", FLAGS,
        bars="(SELECT ticker, bar_time_ts, open, high, low, close, volume, price_range "
             "FROM silver_prices)",
    ),
    "late_increment_anomalies": sql(
        f"{PRICES} rolled flags", FLAGS,
        bars="(SELECT ticker, bar_time_ts, open, high, low, close, volume, price_range "
             "FROM silver_prices)",
    ),
    "increment_silver_news": sql(NEWS, "SELECT * FROM silver_news"),
    "increment_sentiment": sql(f"{NEWS} sentiment", "SELECT * FROM sentiment"),
    "run_batch_sentiment": sql(f"{NEWS} sentiment", "SELECT * FROM sentiment"),
    # The lake's tables hold what the bars really were, however often they were polled.
    "batch_daily_bars": sql(
        "bars daily", "SELECT * REPLACE (upper(ticker) AS ticker) FROM daily", bars="bars"
    ),
    "batch_price_answers": PRICE_ANSWERS,
    "batch_latest_anomalies": sql("bars rolled flags", TOP_FLAGS, bars="bars"),
    "batch_newest_anomalies": sql("bars rolled flags", TOP_FLAGS, bars="bars"),
    "lake_search": NEWS_ANSWERS,
    "indexed_lake_search": NEWS_ANSWERS,
    "blocked_search": KNN_SEARCH,
    "sql_over_path": sql(
        NEWS,
        """SELECT source_name, count(*) AS n_articles, max(published_at_ts) AS newest
           FROM silver_news GROUP BY source_name""",
    ),
}
