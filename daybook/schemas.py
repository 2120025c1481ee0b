"""Column layouts of the stored tables, and fixed values they carry."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw quote files: one folder per asset, header row, one line per trading day.
QUOTES = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)

PRICES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("asset", T.StringType()),
        T.StructField("daily_return", T.DoubleType()),
        T.StructField("cum_return", T.DoubleType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("asset", T.StringType()),
        T.StructField("cagr", T.DoubleType()),
        T.StructField("max_drawdown", T.DoubleType()),
        T.StructField("avg_volatility_30d", T.DoubleType()),
    ]
)

FEAR_GREED = T.StructType(
    [
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("fng_value", T.IntegerType()),
        T.StructField("fng_classification", T.StringType()),
    ]
)

VIX = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("vix_close", T.DoubleType()),
    ]
)

KEY_EVENTS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("anomaly_types", T.StringType()),
        T.StructField("severity_score", T.DoubleType()),
        T.StructField("total_score", T.DoubleType()),
    ]
)

KEY_EVENTS_NEWS = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("pub_date", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("link", T.StringType()),
    ]
)

# Sentiment payload: an object whose ``data`` array has one element per day.
SENTIMENT_PAYLOAD = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("value", T.StringType()),
                        T.StructField("value_classification", T.StringType()),
                        T.StructField("timestamp", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

_FEED_ITEMS = T.ArrayType(
    T.StructType(
        [
            T.StructField("title", T.ArrayType(T.StringType())),
            T.StructField("pubDate", T.ArrayType(T.StringType())),
            T.StructField("source", T.ArrayType(T.StringType())),
            T.StructField("link", T.ArrayType(T.StringType())),
        ]
    )
)

# News feed: items sit under ``channel`` elements and directly under the root; of a
# child that is repeated the first counts.
FEED = T.StructType(
    [
        T.StructField("channel", T.ArrayType(T.StructType([T.StructField("item", _FEED_ITEMS)]))),
        T.StructField("item", _FEED_ITEMS),
        T.StructField("_malformed", T.StringType()),
    ]
)

# Names of the three signals as they appear in the output.
PRICE_SIGNAL = "價格異常"
SENTIMENT_SIGNAL = "情緒異常"
VOLATILITY_SIGNAL = "VIX異常"

# Separators of the two concatenated output columns.
SIGNAL_SEPARATOR = " + "
HEADLINE_SEPARATOR = " | "

# Fixed value: search request; first %s is the day before, second the day after.
NEWS_REQUEST = (
    "https://news.google.com/rss/search?q=bitcoin+after:%s+before:%s&hl=en-US&gl=US&ceid=US:en"
)
