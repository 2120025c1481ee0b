"""The registered queries as plain SQL over the same tables, for comparison."""

from __future__ import annotations

from daybook.schemas import NEWS_REQUEST, PRICE_SIGNAL, SENTIMENT_SIGNAL, VOLATILITY_SIGNAL

# Named subqueries; each may use those above it.
PARTS = {
    "px": """
        SELECT o_orderpriority AS asset, CAST(o_orderdate AS DATE) AS date,
               max_by(o_totalprice, o_orderkey) AS close
        FROM orders GROUP BY 1, 2""",
    "moves": """
        SELECT asset, date, close,
               close / lag(close) OVER (PARTITION BY asset ORDER BY date) - 1 AS daily_return
        FROM px""",
    "risk": """
        SELECT asset, date, close, daily_return,
               CASE WHEN daily_return IS NULL THEN 1.0
                    ELSE product(1 + daily_return) OVER past END AS cum_return,
               CASE WHEN count(daily_return) OVER month_of_rows = 30
                    THEN stddev_samp(daily_return) OVER month_of_rows END AS volatility_30d,
               close / lag(close, 30) OVER by_day - 1 AS rolling_return_30d,
               close / lag(close, 90) OVER by_day - 1 AS rolling_return_90d,
               max(close) OVER past AS rolling_max
        FROM moves
        WINDOW by_day AS (PARTITION BY asset ORDER BY date),
               past AS (PARTITION BY asset ORDER BY date
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               month_of_rows AS (PARTITION BY asset ORDER BY date
                                 ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "feat": "SELECT *, close / rolling_max - 1 AS drawdown FROM risk",
    "peaks": """
        SELECT *, max(cum_return) OVER (PARTITION BY asset ORDER BY date
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS growth_peak
        FROM risk""",
    "metric": """
        SELECT asset,
               pow(arg_max(close, date) / arg_min(close, date),
                   365.0 / date_diff('day', min(date), max(date))) - 1 AS cagr,
               min((cum_return - growth_peak) / growth_peak) AS max_drawdown,
               avg(volatility_30d) AS avg_volatility_30d
        FROM peaks GROUP BY asset""",
    "line_moves": """
        SELECT l_returnflag AS asset, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS close,
               l_extendedprice / lag(l_extendedprice) OVER by_place - 1 AS daily_return,
               row_number() OVER by_place AS place
        FROM lineitem
        WINDOW by_place AS (PARTITION BY l_returnflag ORDER BY CAST(l_shipdate AS DATE), l_extendedprice)""",
    "line_growth": """
        SELECT *, CASE WHEN daily_return IS NULL THEN 1.0
                       ELSE product(1 + daily_return) OVER (PARTITION BY asset ORDER BY place
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS growth
        FROM line_moves""",
    "mood": """
        SELECT CAST(l_shipdate AS DATE) AS date,
               CAST(CAST(sum(l_quantity) AS BIGINT) % 101 AS INTEGER) AS fng_value
        FROM lineitem GROUP BY 1""",
    "implied": """
        SELECT CAST(l_shipdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS vix_close
        FROM lineitem GROUP BY 1""",
    "moment": """
        SELECT asset, avg(daily_return) AS m, stddev_samp(daily_return) AS sd
        FROM moves GROUP BY asset""",
    "scored": """
        SELECT asset, date, daily_return, (daily_return - m) / sd AS z,
               abs(daily_return - m) > 2 * sd AS far
        FROM moves JOIN moment USING (asset) WHERE daily_return IS NOT NULL""",
    "price_days": f"""
        SELECT date, '{PRICE_SIGNAL}' AS anomaly_type, max(abs(z)) AS severity
        FROM scored WHERE far GROUP BY date""",
    "mood_days": f"""
        SELECT date, '{SENTIMENT_SIGNAL}' AS anomaly_type, step / 10.0 AS severity
        FROM (SELECT date, CAST(abs(fng_value - lag(fng_value) OVER (ORDER BY date)) AS DOUBLE) AS step
              FROM mood) WHERE step > 10""",
    "implied_days": f"""
        SELECT date, '{VOLATILITY_SIGNAL}' AS anomaly_type, pct / 20.0 AS severity
        FROM (SELECT date, (vix_close / lag(vix_close) OVER (ORDER BY date) - 1) * 100.0 AS pct
              FROM implied) WHERE pct > 20""",
    "signals": """
        FROM price_days UNION ALL FROM mood_days UNION ALL FROM implied_days""",
    "scores": """
        SELECT date, CAST(year(date) AS INTEGER) AS year,
               count(DISTINCT anomaly_type) AS anomaly_count,
               sum(severity) AS severity_score,
               2 * count(DISTINCT anomaly_type) + sum(severity) AS total_score,
               string_agg(anomaly_type, ' + ' ORDER BY anomaly_type) AS anomaly_types
        FROM signals GROUP BY date""",
    "best": """
        SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY total_score DESC, date) AS INTEGER) AS rank
        FROM scores QUALIFY rank <= 10""",
    "events_of_year": """
        SELECT date, year, rank, anomaly_count, anomaly_types,
               round(severity_score, 2) AS severity_score, round(total_score, 2) AS total_score
        FROM best""",
    "headlines": """
        SELECT DATE '1995-01-01' + CAST(doc_id * 7 % 2400 AS INTEGER) AS day, text AS title, source
        FROM documents
        QUALIFY row_number() OVER (PARTITION BY day ORDER BY doc_id) <= 3""",
    "link": """
        SELECT page_id, url, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS link,
               unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS title,
               unnest(range(len(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)))) AS pos
        FROM pages""",
    "usable": """
        SELECT *, sum(CASE WHEN regexp_matches(title, '[.,]$') THEN 1 ELSE 0 END)
                  OVER (PARTITION BY page_id ORDER BY pos) AS bad_so_far
        FROM link""",
}

NEEDS = {
    "px": [],
    "moves": ["px"],
    "risk": ["moves"],
    "feat": ["risk"],
    "peaks": ["risk"],
    "metric": ["peaks"],
    "line_moves": [],
    "line_growth": ["line_moves"],
    "mood": [],
    "implied": [],
    "moment": ["moves"],
    "scored": ["moves", "moment"],
    "price_days": ["scored"],
    "mood_days": ["mood"],
    "implied_days": ["implied"],
    "signals": ["price_days", "mood_days", "implied_days"],
    "scores": ["signals"],
    "best": ["scores"],
    "events_of_year": ["best"],
    "headlines": [],
    "link": [],
    "usable": ["link"],
}


def _sql(body: str, *parts: str) -> str:
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in NEEDS[name]:
                need(other)

    for part in parts:
        need(part)
    named = ",\n".join(f"{name} AS ({PARTS[name].strip()})" for name in PARTS if name in wanted)
    return f"WITH {named}\n{body.strip()}" if named else body.strip()


def _rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_ALL_FEATURES = (
    "daily_return",
    "cum_return",
    "volatility_30d",
    "rolling_return_30d",
    "rolling_return_90d",
    "rolling_max",
    "drawdown",
)
_REQUEST = NEWS_REQUEST.replace("%s", "{}")

ORACLE: dict[str, str] = {
    "src_prices": _sql("SELECT date, close, asset FROM px", "px"),
    "src_quotes_bad_rows": _sql(
        """SELECT asset, strftime(date, '%d/%m/%Y') AS "Date" FROM px WHERE day(date) = 13""", "px"
    ),
    "src_volatility_series": _sql("SELECT date, vix_close FROM implied", "implied"),
    "src_sentiment_payload": _sql(
        """SELECT CAST(date AS TIMESTAMP) AS date, fng_value, CASE WHEN fng_value < 50 THEN 'Fear' ELSE 'Greed' END AS fng_classification
           FROM mood""",
        "mood",
    ),
    "src_feed_items": _sql(
        """SELECT page_id, strftime(DATE '1995-01-01' + CAST(page_id % 365 AS INTEGER), '%Y-%m-%d') AS event_date,
                  CAST(pos AS INTEGER) AS position, title,
                  strftime(DATE '1995-01-01' + CAST(page_id % 365 AS INTEGER), '%Y-%m-%d') AS pub_date,
                  CASE WHEN length(title) % 2 = 0
                       THEN regexp_extract(url, '^https?://([^/]+)', 1) END AS source,
                  link
           FROM usable WHERE bad_so_far = 0 AND pos < 3""",
        "usable",
    ),
    "src_feed_broken": _sql(
        """SELECT page_id, strftime(DATE '1995-01-01' + CAST(page_id % 365 AS INTEGER), '%Y-%m-%d') AS event_date,
                  CAST(pos AS INTEGER) AS position, title,
                  strftime(DATE '1995-01-01' + CAST(page_id % 365 AS INTEGER), '%Y-%m-%d') AS pub_date,
                  CASE WHEN length(title) % 2 = 0
                       THEN regexp_extract(url, '^https?://([^/]+)', 1) END AS source,
                  link
           FROM (SELECT *, count(*) OVER (PARTITION BY page_id) AS items FROM usable)
           WHERE bad_so_far = 0 AND pos < 3 AND (items <= page_id % 4 OR pos < page_id % 4)""",
        "usable",
    ),
    "src_feed_elements": _sql(
        """SELECT strftime(day, '%Y-%m-%d') AS event_date, CAST(nth - 1 AS INTEGER) AS position, title,
                  strftime(day, '%Y-%m-%d') AS pub_date,
                  CASE WHEN length(title) % 2 = 0 THEN regexp_extract(url, '^https?://([^/]+)', 1) END AS source, link
           FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY page_id, pos) AS nth,
                        sum(CASE WHEN regexp_matches(title, '[.,]$') THEN 1 ELSE 0 END) OVER (PARTITION BY day ORDER BY page_id, pos) AS bad
                 FROM (SELECT *, DATE '1995-01-01' + CAST(page_id % 365 AS INTEGER) AS day FROM link))
           WHERE bad = 0 AND nth <= 20""",
        "link",
    ),
    "src_sentiment_elements": _sql(
        """SELECT CAST(date AS TIMESTAMP) AS date, fng_value, CASE WHEN fng_value < 50 THEN 'Fear' ELSE 'Greed' END AS fng_classification
           FROM mood""",
        "mood",
    ),
    "src_feed_bad_docs": "SELECT doc_id FROM documents WHERE lang = 'de'",
    "feed_item_counts": _sql(
        """SELECT page_id, strftime(DATE '1995-01-01' + CAST(page_id % 365 AS INTEGER), '%Y-%m-%d') AS event_date,
                  CAST(count(*) AS INTEGER) AS found,
                  CAST(least(3, count(*) FILTER (WHERE bad_so_far = 0)) AS INTEGER) AS kept
           FROM usable GROUP BY page_id""",
        "usable",
    ),
    "src_csv_roundtrip": "SELECT * FROM documents",
    "src_csv_inferred": """
        SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "sink_overwrite_idempotent": _sql("SELECT date, vix_close FROM implied", "implied"),
    "sink_snapshot": _sql(
        "SELECT asset, px.date, close, vix_close FROM px LEFT JOIN implied USING (date)", "px", "implied"
    ),
    "export_tables": _sql(
        """SELECT 'prices' AS table_name, count(*) AS row_count, 5 AS column_count FROM px
           UNION ALL SELECT 'metrics', count(DISTINCT asset), 4 FROM px
           UNION ALL SELECT 'key_events', count(*), 7 FROM events_of_year
           UNION ALL SELECT 'key_events_news', count(*), 5
                     FROM headlines WHERE day IN (SELECT date FROM events_of_year)
           UNION ALL SELECT 'key_events_with_news', count(*), 9 FROM events_of_year""",
        "px",
        "events_of_year",
        "headlines",
    ),
    "filter_date_range": _sql(
        """SELECT CAST(date AS TIMESTAMP) AS date, fng_value FROM mood
           WHERE date >= DATE '1996-01-01' AND date <= DATE '1999-12-30'""",
        "mood",
    ),
    "filter_date_halfopen": _sql(
        "SELECT asset, date, close FROM px WHERE date >= DATE '1996-01-01' AND date < DATE '1999-12-31'",
        "px",
    ),
    "scalar_math": """
        SELECT l_orderkey, l_linenumber,
               abs(l_quantity - 25) AS distance,
               round(l_quantity / 8, 2) AS eighths,
               round(-l_quantity / 8, 2) AS minus_eighths,
               round(pow(l_quantity, 0.5), 6) AS root,
               l_extendedprice / nullif(l_discount, 0) AS per_discount,
               round((l_quantity + 1) * 100 / 20.0, 6) AS scaled
        FROM lineitem""",
    "scalar_date": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
               CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
               strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS day_before,
               strftime(CAST(o_orderdate AS DATE) + 1, '%Y-%m-%d') AS day_after
        FROM orders""",
    "scalar_json": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               DATE '1970-01-01' + CAST(json_extract_string(props, '$.k') AS INTEGER) AS day
        FROM events""",
    "daily_return": _sql(f"SELECT asset, date, close, {_rounded('daily_return')} FROM moves", "moves"),
    "rolling_return": _sql(
        f"SELECT asset, date, close, {_rounded('rolling_return_30d', 'rolling_return_90d')} FROM feat", "feat"
    ),
    "cumulative_return": _sql(
        f"SELECT asset, date, close, {_rounded('daily_return', 'cum_return')} FROM feat", "feat"
    ),
    "rolling_volatility": _sql(
        f"SELECT asset, date, close, {_rounded('daily_return', 'volatility_30d')} FROM feat", "feat"
    ),
    "drawdown_series": _sql(
        """SELECT asset, date, close, round(cum_return, 6) AS cum_return, round(growth_peak, 6) AS rolling_max,
                  round((cum_return - growth_peak) / growth_peak, 6) AS drawdown FROM peaks""",
        "peaks",
    ),
    "price_features": _sql(f"SELECT asset, date, close, {_rounded(*_ALL_FEATURES)} FROM feat", "feat"),
    "cagr": _sql(f"SELECT asset, {_rounded('cagr')} FROM metric", "metric"),
    "max_drawdown": _sql(f"SELECT asset, {_rounded('max_drawdown')} FROM metric", "metric"),
    "portfolio_metrics": _sql(
        f"SELECT asset, {_rounded('cagr', 'max_drawdown', 'avg_volatility_30d')} FROM metric", "metric"
    ),
    "metrics_join_chain": _sql(
        f"SELECT asset, {_rounded('cagr', 'max_drawdown', 'avg_volatility_30d')} FROM metric", "metric"
    ),
    "asset_summary": _sql(
        """SELECT asset, round(arg_max(cum_return, date), 6) AS final_cum_return,
                  round(avg(volatility_30d), 6) AS avg_volatility_30d,
                  round(min(drawdown), 6) AS max_drawdown,
                  round(arg_max(rolling_return_30d, date), 6) AS latest_30d_return,
                  round(arg_max(rolling_return_90d, date), 6) AS latest_90d_return
           FROM feat GROUP BY asset""",
        "feat",
    ),
    "group_metric_apply": _sql(f"SELECT asset, {_rounded('cagr')} FROM metric", "metric"),
    "return_stats": _sql(
        "SELECT asset, round(m, 6) AS mean_return, round(sd, 6) AS std_return FROM moment", "moment"
    ),
    "return_zscore": _sql(
        f"SELECT asset, date, {_rounded('daily_return')}, round(z, 6) AS zscore FROM scored", "scored"
    ),
    "price_anomaly": _sql(f"SELECT date, anomaly_type, {_rounded('severity')} FROM price_days", "price_days"),
    "sentiment_anomaly": _sql(f"SELECT date, anomaly_type, {_rounded('severity')} FROM mood_days", "mood_days"),
    "volatility_anomaly": _sql(
        f"SELECT date, anomaly_type, {_rounded('severity')} FROM implied_days", "implied_days"
    ),
    "all_anomalies": _sql(f"SELECT date, anomaly_type, {_rounded('severity')} FROM signals", "signals"),
    "daily_score": _sql(
        f"""SELECT date, year, anomaly_count, anomaly_types, {_rounded('severity_score', 'total_score')}
            FROM scores""",
        "scores",
    ),
    "topn_per_group": _sql(
        f"""SELECT date, year, rank, anomaly_count, anomaly_types,
                   {_rounded('severity_score', 'total_score')} FROM best""",
        "best",
    ),
    "key_events": _sql("SELECT * FROM events_of_year ORDER BY year, rank", "events_of_year"),
    "key_events_table": _sql("SELECT * FROM events_of_year", "events_of_year"),
    "lag_repeated_positions": """
        SELECT asset, date, close, round(close / lag(close) OVER (PARTITION BY asset ORDER BY date, close) - 1, 6) AS daily_return
        FROM (SELECT l_returnflag AS asset, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS close FROM lineitem)""",
    "event_changes": """
        SELECT event_type, ts, value,
               round(value / nullif(lag(value) OVER (PARTITION BY event_type ORDER BY ts, value), 0) - 1, 6) AS daily_return
        FROM events""",
    "range_cut_features": _sql(
        """SELECT asset, date, close, round(daily_return, 6) AS daily_return,
                  round(CASE WHEN count(daily_return) OVER month = 30 THEN stddev_samp(daily_return) OVER month END, 6) AS volatility_30d
           FROM line_moves WINDOW month AS (PARTITION BY asset ORDER BY place ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
        "line_moves",
    ),
    "range_cut_drawdown": _sql(
        """SELECT asset, round(min(growth / peak - 1), 6) AS max_drawdown
           FROM (SELECT asset, growth, max(growth) OVER (PARTITION BY asset ORDER BY place
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM line_growth)
           GROUP BY asset""",
        "line_growth",
    ),
    "long_volatility": _sql(
        """SELECT asset, date, close, round(daily_return, 6) AS daily_return,
                  round(CASE WHEN count(daily_return) OVER rows_250 = 250 THEN stddev_samp(daily_return) OVER rows_250 END, 6) AS volatility_250d
           FROM moves WINDOW rows_250 AS (PARTITION BY asset ORDER BY date ROWS BETWEEN 249 PRECEDING AND CURRENT ROW)""",
        "moves",
    ),
    "exponential_mean": """
        WITH RECURSIVE px AS (SELECT * FROM (""" + PARTS["px"] + """)),
        nth AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY date) AS i FROM px),
        mean AS (
            SELECT asset, date, close, i, close AS ewm FROM nth WHERE i = 1
            UNION ALL
            SELECT n.asset, n.date, n.close, n.i, m.ewm + (n.close - m.ewm) * 2 / 31.0
            FROM mean m JOIN nth n ON n.asset = m.asset AND n.i = m.i + 1)
        SELECT asset, date, close, round(ewm, 3) AS ewm FROM mean""",
    "stored_range_features": _sql(
        f"""SELECT asset, date, close, {_rounded(*_ALL_FEATURES)} FROM feat
            WHERE date >= DATE '1996-06-01' AND date < DATE '1997-06-01'""",
        "feat",
    ),
    "ordered_titles": """
        SELECT lang, length(joined) AS n_chars, md5(joined) AS digest
        FROM (SELECT lang, string_agg(text, ' | ' ORDER BY text) AS joined FROM documents GROUP BY lang)""",
    "global_lag_bucketed": _sql(
        """SELECT date, vix_close, abs(vix_close - lag(vix_close) OVER (ORDER BY date)) AS daily_change
           FROM implied""",
        "implied",
    ),
    "news_request_plan": _sql(
        f"""SELECT strftime(date, '%Y-%m-%d') AS event_date, strftime(date - 1, '%Y-%m-%d') AS after,
                   strftime(date + 1, '%Y-%m-%d') AS before,
                   format('{_REQUEST}', strftime(date - 1, '%Y-%m-%d'), strftime(date + 1, '%Y-%m-%d')) AS url
            FROM events_of_year""",
        "events_of_year",
    ),
    "key_events_with_news": _sql(
        """SELECT e.*, h.news_titles, h.news_sources
           FROM events_of_year e LEFT JOIN (
               SELECT day, string_agg(title, ' | ' ORDER BY title) AS news_titles,
                      string_agg(source, ' | ' ORDER BY source) AS news_sources
               FROM headlines GROUP BY day) h ON e.date = h.day
           ORDER BY year, rank""",
        "events_of_year",
        "headlines",
    ),
    "profile_date_span": _sql(
        """SELECT 'prices' AS table_name, min(date) AS first_date, max(date) AS last_date FROM px
           UNION ALL SELECT 'fear_greed', min(date), max(date) FROM mood""",
        "px",
        "mood",
    ),
    "profile_null_counts": _sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM feat"
            for c in ("asset", "date", "close", *_ALL_FEATURES)
        ),
        "feat",
    ),
    "profile_head_tail": _sql(
        """(SELECT asset, date, close, 'head' AS side FROM px ORDER BY date, asset LIMIT 10)
           UNION ALL
           (SELECT asset, date, close, 'tail' AS side FROM px ORDER BY date DESC, asset DESC LIMIT 5)""",
        "px",
    ),
    "profile_schema": """
        SELECT 1 AS position, 'o_orderkey' AS column_name, 'bigint' AS data_type, count(o_orderkey) AS present FROM orders
        UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM orders
        UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
        UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM orders
        UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
        UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""",
    "profile_shape": """
        SELECT 'orders' AS table_name, count(*) AS row_count, 6 AS column_count FROM orders
        UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem
        UNION ALL SELECT 'documents', count(*), 5 FROM documents
        UNION ALL SELECT 'pages', count(*), 3 FROM pages""",
}
