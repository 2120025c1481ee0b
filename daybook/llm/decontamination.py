"""Benchmark passages in documents, by a prefix-filtered set join (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import lower_ascii, split_words, stored, whole_row

#: What separates words after A-Z is lower-cased: ASCII other than digits and a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Up to this many distinct benchmark words (some 100 bytes each in memory) the
#: documents' words meet them by broadcast; above, both sides are shuffled.
BROADCAST_ROWS = 100_000


def item_words(text: Column) -> Column:
    return split_words(lower_ascii(text), SEPARATORS)


def _small(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(item_id, words): every run of ten words of an item, or all of a shorter one."""
    words = benchmark.select(F.col(item).cast("string").alias("item_id"), item_words(F.col(text)).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - WINDOW + 1, F.lit(1)))
    return words.where(F.size("all") > 0).select("item_id", "all", F.explode(starts).alias("at")).select(
        "item_id", F.slice("all", F.col("at"), F.lit(WINDOW)).alias("words")
    )


def _token_counts(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """(token, n): how often each benchmark word occurs in all documents."""
    words = docs.select(F.explode("words").alias("token"))
    if _small(tokens):
        tokens = F.broadcast(tokens)
    else:
        words = words.groupBy("token").count()
        return words.join(tokens, "token", "left_semi").select("token", F.col("count").alias("n"))
    return words.join(tokens, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def found_windows(documents: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """(text_key, start, stop, window_key) of every occurrence, and (window_key, item_id).

    A window can only occur around its rarest word, so that word is the prefix of the
    window that a join on exact containment needs. Words are ordered by their count
    in all documents. Occurrences of the prefix words are joined, those too close to
    an end of the text are dropped by the word's position in the window, and the whole
    window is compared. Texts are told apart by their MD5.
    """
    docs = documents.select(F.md5(F.col(text)).alias("text_key"), item_words(F.col(text)).alias("words")).where(F.size("words") > 0)
    items = _windows(benchmark, item, item_text).withColumn("window_key", F.md5(F.array_join("words", " ")))
    items = stored(items, "windows")
    windows = items.dropDuplicates(["window_key"]).select("window_key", "words")
    tokens = stored(windows.select(F.explode("words").alias("token")).distinct(), "tokens")
    counts = _token_counts(docs, tokens)
    places = windows.select("window_key", F.posexplode("words").alias("before", "token"))
    ranked = places.join(counts, "token", "left").groupBy("window_key").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "before")).alias("first")
    )
    # a word that no document has keeps its windows out of the join
    prefixes = stored(
        ranked.where("first.n > 0").select("window_key", "first.token", "first.before").join(windows, "window_key")
        .select("token", "before", "window_key", F.col("words").alias("window")),
        "prefixes",
    )
    at, size = F.col("at") - F.col("before"), F.size("window")
    placed = docs.select("text_key", "words", F.posexplode("words").alias("at", "token"))
    if _small(prefixes):
        met = placed.join(F.broadcast(prefixes), "token").where((at >= 0) & (at + size <= F.size("words")))
        same = F.slice("words", at + 1, size) == F.col("window")
    else:
        left = F.least(F.col("at"), F.lit(WINDOW - 1))
        near = F.slice("words", F.col("at") - left + 1, F.lit(2 * WINDOW - 1))
        met = placed.select("text_key", "at", "token", F.size("words").alias("n"), left.alias("left"), near.alias("near"))
        met = met.join(prefixes, "token").where((at >= 0) & (at + size <= F.col("n")))
        same = F.slice("near", F.col("left") - F.col("before") + 1, size) == F.col("window")
    hits = met.where(same).select("text_key", at.alias("start"), (at + size).alias("stop"), "window_key").distinct()
    return stored(hits, "hits"), items.select("window_key", "item_id").distinct()


def _covered(hits: DataFrame) -> DataFrame:
    """(text_key, n_hit): words inside any occurrence, each once."""
    spans = hits.select("text_key", "start", "stop").distinct()
    before = Window.partitionBy("text_key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(before), F.lit(0))))
    return spans.select("text_key", new.alias("new")).groupBy("text_key").agg(F.sum("new").cast("bigint").alias("n_hit"))


def contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, contaminated) per row of ``documents``.

    Words are runs of characters other than ASCII without digits and letters, A-Z
    lower-cased. A window is ten consecutive words of an item, or all words of a
    shorter item; ``n_hit`` counts document words inside occurrences of windows,
    ``item_ids`` lists the items with occurring windows, sorted as strings.

    Defined cases: NULL or empty texts have no words and no hits; NULL or empty
    items have no window. An item without id makes hits but is in no list. Repeated
    rows are kept, each with its own result; items that share an id are one. Either
    table may be empty. A NULL ``key`` stays NULL. Other columns are not looked at.
    """
    hits, of_item = found_windows(documents, benchmark, text, item, item_text)
    found = (
        hits.select("text_key", "window_key").distinct().join(of_item.where("item_id is not null"), "window_key")
        .groupBy("text_key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    result = _covered(hits).join(found, "text_key", "left")
    rows = documents.select(
        F.col(key).alias("doc_id"), F.md5(F.col(text)).alias("text_key"), F.size(item_words(F.col(text))).cast("bigint").alias("n_words")
    )
    none = F.array().cast("array<string>")
    return rows.join(result, "text_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def without_benchmark(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``documents``, all columns, in which no window occurs."""
    hits, _ = found_windows(documents, benchmark, text, item, item_text)
    bad = stored(hits.select("text_key").distinct(), "contaminated")
    rows = documents.select(whole_row(documents).alias("row"), F.md5(F.col(f"`{text}`")).alias("text_key"))
    return rows.join(bad, "text_key", "left_anti").select("row.*")
