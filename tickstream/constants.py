"""Fixed values that results depend on."""

# Topics, tickers, search phrases and feed sizes of the ingest side.
NEWS_TOPIC = "news-raw"
PRICES_TOPIC = "prices-raw"
TICKERS = ("NVDA", "AAPL", "MSFT", "GOOGL", "AMZN", "TSLA", "META", "AMD")
SEARCH_PHRASES = ("NVIDIA stock", "Apple earnings", "Microsoft AI", "stock market")
SEARCHES_PER_CYCLE = 2
HEADLINE_CATEGORY = "business"
FEED_LANGUAGE = "en"
HEADLINES_PAGE = 20
SEARCH_PAGE = 10
LOOKBACK_HOURS = 24

# Placeholder title of a withdrawn article.
REMOVED_TITLE = "[Removed]"
# Start of the marker that ends a shortened article body, as in "[+120 chars]".
BODY_TAIL = "[+"

# Rolling anomaly model.
ROLLING_BARS = 20
ANOMALY_THRESHOLD = 2.0
ARTICLES_PER_ATTENTION_POINT = 10.0

# Readers.
LATEST_ANOMALIES = 20
LATEST_DAYS = 10
TOP_K = 5
EXCERPT_CHARS = 200
SAMPLE_TITLES = 3
RECENT_DAILY_BARS = 5
YEAR_RANGE_DAYS = 364

# Texts handed to the embedding model per call.
EMBED_BATCH = 50

# Fixed text formats, with %s, %d and %f places.
PART_LABELS = ("Title: ", "Description: ", "Content: ")
PART_SEPARATOR = " | "
CITATION_FORMAT = (
    "[%d] %s\n"
    "    Source: %s | Published: %s | Relevance: %.3f\n"
    "    %s"
)
CITATION_SEPARATOR = "\n\n"
EXCERPT_END = "..."
UNKNOWN = "Unknown"
NO_ARTICLES = "No relevant articles found."
MONEY_FORMAT = "USD %.2f"
PRICE_FORMAT = (
    "Ticker: %s\n"
    "Latest Close: %s\n"
    "Daily Change: %s\n"
    "Volume: %s\n"
    "High: %s | Low: %s\n"
    "52-Week High: %s | Low: %s\n"
)
NO_PRICE_FORMAT = "No price data available for %s. Market may be closed."
EMPTY_TABLE_FORMAT = "Table '%s' exists but contains no data yet."

# Every character that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
