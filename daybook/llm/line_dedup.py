"""Near-duplicate lines removed by an exact set-similarity join (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import setjoin
from daybook.llm.arrowtext import buffers, mix, signed, slices, spans, word_hashes
from daybook.llm.setjoin import prefix_length
from daybook.llm.tables import filter_slot, member_filter, noted, removed, stored, whole_row

_SIGN = np.int64(-(1 << 63))
_TOP = np.uint64(1 << 63)
#: Bits of a hash that lead to the common words that start with them.
LEADING = 20
#: Bytes of text that are worked on together; the arrays of so many stay in a core's cache.
TOGETHER = 1 << 19
#: Texts with a wanted line are found by their broadcast keys, if these are so many at most.
FEW = 1 << 20
#: Distinct words that a task adds up before it hands them on.
ADDED = 1 << 20
_SLOTS = 1 << 22
#: Smaller sets are similar to no other: of sets of three and four words, three are shared at most.
LEAST = 4
#: A token in the prefixes of more sets is compared in cells of two blocks of so many.
CELL = 1 << 14
#: Rows that are compared at once, if they are whole cells.
CHUNK = 1 << 18


def _line_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, line of each word counted over the slice, (row, line number) of each line)."""
    data, offsets = buffers(column)
    starts, ends = spans(data, offsets)
    words = signed(word_hashes(data, starts, ends, lower=True))
    # a line starts at each row's start and after each line break; a break at the end
    # of a row opens an empty line there, which gets no word
    breaks = np.flatnonzero(data == 10)
    line_rows = np.concatenate((np.arange(len(column)), np.searchsorted(offsets, breaks, side="right") - 1))
    line_starts = np.concatenate((offsets[:-1], breaks + 1))
    order = np.lexsort((line_starts, line_rows))
    line_rows, line_starts = line_rows[order], line_starts[order]
    first = np.searchsorted(line_rows, np.arange(len(column)))
    numbers = np.arange(len(line_rows)) - first[line_rows]
    row_of_word = np.repeat(np.arange(len(column)), np.diff(np.searchsorted(starts, offsets)))
    # lines are in text order, so a word's line is the last that starts at or before it in its row
    line_of_word = np.searchsorted(line_starts, starts, side="right") - 1
    line_of_word = np.maximum(line_of_word, first[row_of_word]) if len(starts) else line_of_word
    return words, line_of_word, np.stack((line_rows, numbers))


class _Ranks:
    """Ranks of the common words, found from the leading bits of their hashes."""

    def __init__(self, common: tuple[np.ndarray, np.ndarray]) -> None:
        self.known, self.rank = common
        edges = np.arange(1 << LEADING, dtype=np.uint64) << np.uint64(64 - LEADING)
        first = np.searchsorted(self.known.view(np.uint64) ^ _TOP, edges)
        self.first = np.append(first, len(self.known)).astype(np.int32)

    def tokens(self, words: np.ndarray) -> np.ndarray:
        """A word's hash with the sign set, or the rank of a common word, so that
        plain order of the numbers puts rare words first."""
        out = words | _SIGN
        lead = ((words.view(np.uint64) ^ _TOP) >> np.uint64(64 - LEADING)).astype(np.int64)
        at, end = self.first[lead], self.first[lead + 1]
        open_ = np.flatnonzero(at < end)
        while len(open_):
            here = at[open_]
            hit = self.known[here] == words[open_]
            out[open_[hit]] = self.rank[here[hit]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return out


def _by_line(lines: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The order by line, then token. Sorts one number of the line and what leads the
    token; where that ties for different tokens, by both columns."""
    if len(lines) == 0:
        return np.zeros(0, dtype=np.int64)
    bits = max(1, int(lines.max()).bit_length())
    lead = np.where(tokens < 0, (tokens & ~_SIGN) >> 1, (1 << 62) | (tokens << 42)).view(np.uint64)  # ranks are below 2^20
    number = (lines.astype(np.uint64) << np.uint64(64 - bits)) | (lead >> np.uint64(bits - 1))
    order = np.argsort(number)
    number, found = number[order], tokens[order]
    if ((number[1:] == number[:-1]) & (found[1:] != found[:-1])).any():
        return np.lexsort((tokens, lines))
    return order


def _tokens(words: np.ndarray, lines: np.ndarray, ranks: _Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(line, token) of the distinct words of each line, in the global order."""
    tokens = ranks.tokens(words)
    order = _by_line(lines, tokens)
    lines, tokens = lines[order], tokens[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = (lines[1:] != lines[:-1]) | (tokens[1:] != tokens[:-1])
    return lines[new], tokens[new]


def _keys(tokens: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    u = mix(tokens.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    return signed(mix(np.add.reduceat(u, starts) + n.astype(np.uint64) * np.uint64(0x14057B7EF767814F)))


def _added(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of several (token, n)."""
    token, n = (np.concatenate(side) for side in zip(*counts, strict=True))
    order = np.argsort(token)
    token, n = token[order], n[order]
    first = np.flatnonzero(np.concatenate((token[:1] == token[:1], token[1:] != token[:-1])))
    return token[first], np.add.reduceat(n, first) if len(first) else n


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in slices(batches, most=TOGETHER):
        data, offsets = buffers(batch.column(0))
        starts, ends = spans(data, offsets)
        held.append(np.unique(signed(word_hashes(data, starts, ends, lower=True)), return_counts=True))
        size += len(held[-1][0])
        if size > ADDED:
            held = [_added(held)]
            size = len(held[0][0])
            if 2 * size > ADDED:
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in held[0]], names=["token", "n"])
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in _added(held)], names=["token", "n"])


def _bitmaps(tokens: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """128 parity bits per set, in two numbers: each token flips one bit.

    Tokens that two sets share cancel out, so the bits in which their bitmaps differ
    are at most as many as the tokens that only one of them has.
    """
    place = mix(tokens.view(np.uint64) ^ np.uint64(0x9FB21C651E98DF25)) & np.uint64(127)
    bit = np.uint64(1) << (place & np.uint64(63))
    halves = (np.where(place < 64, bit, np.uint64(0)), np.where(place < 64, np.uint64(0), bit))
    return [signed(np.bitwise_xor.reduceat(half, starts)) for half in halves]


def _lists(tokens: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens))


def _line_sets(common):
    """Per line with a word: its place, lines of its text, set key, size, bitmaps and prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _Ranks(common.value)
        for part in slices(batches, most=TOGETHER):
            words, line_of, place = _line_words(part.column("text"))
            if len(words) == 0:
                continue
            lines, tokens = _tokens(words, line_of, ranks)
            begin = np.flatnonzero(np.concatenate(([True], lines[1:] != lines[:-1])))
            n = np.diff(np.append(begin, len(lines)))
            # a set of three words or fewer is similar to no other
            size = np.where(n >= LEAST, prefix_length(n), 0)
            within = np.arange(len(tokens)) - np.repeat(begin, n)
            low, high = _bitmaps(tokens, begin)
            rows, number = place[0][lines[begin]], place[1][lines[begin]]
            row, of_row = pa.array(rows), np.bincount(rows)[rows]
            columns = {
                "doc_id": part.column("doc_id").take(row), "text_key": part.column("text_key").take(row), "line": pa.array(number),
                "n_lines": pa.array(of_row), "key": pa.array(_keys(tokens, begin, n)), "n": pa.array(n.astype(np.int32)),
                "low": pa.array(low), "high": pa.array(high), "prefix": _lists(tokens[within < np.repeat(size, n)], size),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _entries(classes: DataFrame, asks: Column) -> DataFrame:
    """A row per prefix token; ``meta`` holds size, position, and whether the set asks."""
    return classes.select(
        "first.*", "low", "high", F.shiftleft(F.col("n").cast("bigint"), 34).alias("size"), asks.cast("bigint").alias("asks"),
        F.posexplode("prefix").alias("pos", "token"),
    ).select(
        "doc_id", "text_key", "line", "low", "high", "token",
        (F.col("size") + F.shiftleft(F.col("pos").cast("bigint"), 3) + F.col("asks") * 4).alias("meta"),
    )


def _cells(entries: DataFrame, hot: DataFrame) -> DataFrame:
    """Entries with the cell of their token that they are compared in (``at``).

    A token of ``hot(token, blocks)`` deals its sets out to blocks, and each two
    blocks meet in a cell of their own; in such a cell only sets of different blocks
    are compared (side 1 with side 2). Other tokens are a cell.
    """
    blocks, k = F.coalesce("blocks", F.lit(1)), F.col("k")
    own = F.pmod(F.xxhash64("text_key", "line"), blocks)
    cell = F.least(own, k) * blocks + F.greatest(own, k)
    side = F.when(own == k, 0).when(own < k, 1).otherwise(2).cast("bigint")
    dealt = entries.join(hot, "token", "left").withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    return dealt.select(
        F.when(F.col("blocks").isNull(), F.col("token")).otherwise(F.xxhash64("token", cell)).alias("at"),
        "doc_id", "text_key", "line", "low", "high", (F.col("meta") + side).alias("meta"),
    )


def _candidates(every: bool):
    """Pairs of sets of one cell that meet all bounds, from rows in the order of cells.

    Bounds: sizes, positions of the shared token, and bits in which the bitmaps
    differ. A pair is told by the set that comes later, if it asks: with ``every``
    each of its pairs, else one whose bitmap differs least, and if there are ``more``.
    """
    def pairs(table: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        n, alike = table.column("meta").to_numpy() >> 34, group[1:] == group[:-1]
        order = np.flatnonzero(np.append(alike, False) | np.append(False, alike))  # others meet no set
        order = order[np.argsort((group[order] << 31) | n[order])]
        keys = table.column("doc_id")
        place = [keys.fill_null(-(1 << 63)).to_numpy(), keys.is_valid().to_numpy(), table.column("text_key").to_numpy(), table.column("line").to_numpy()]
        place = [v[order] for v in place]
        group, n, meta = group[order], n[order], table.column("meta").to_numpy()[order]
        low, high = (table.column(c).to_numpy()[order].view(np.uint64) for c in ("low", "high"))
        pos, asks, side = (meta >> 3) & ((1 << 31) - 1), (meta & 4) > 0, meta & 3

        def earlier(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            out, tie = np.zeros(len(x), dtype=bool), np.ones(len(x), dtype=bool)
            for v in place:
                out |= tie & (v[x] < v[y])
                tie &= v[x] == v[y]
            return out

        def told(x: np.ndarray, y: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
            columns = [place[2][x], place[3][x], place[2][y], place[3][y], more]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["x_text", "x_line", "y_text", "y_line", "more"])

        best = np.full(len(order), 1 << 60, dtype=np.int64)  # bits that differ, then the row
        count = np.zeros(len(order), dtype=np.int64)
        i, d, held, size = np.arange(len(order)), 0, [], 0
        while True:
            d += 1
            i = i[i < len(order) - d]
            i = i[(group[i] == group[i + d]) & (4 * n[i + d] <= 5 * n[i])]
            if len(i) == 0:
                break
            j = i + d
            both = n[i] + n[j]
            ok = (9 * (n[i] - pos[i]) >= 4 * both) & (9 * (n[j] - pos[j]) >= 4 * both)
            # different sets of one size miss a word each
            ok &= ((n[i] != n[j]) | (n[i] >= 9)) & ((side[i] != side[j]) | (side[i] == 0))
            a, b, both = i[ok], j[ok], both[ok]
            differ = np.bitwise_count(low[a] ^ low[b]).astype(np.int64) + np.bitwise_count(high[a] ^ high[b])
            near = 9 * differ <= both
            a, b, differ = a[near], b[near], differ[near]
            first = earlier(a, b)
            for x, y, take in ((a, b, first), (b, a, ~first)):
                take = take & asks[y]
                x, y = x[take], y[take]
                if every:
                    held.append((x, y))
                    size += len(x)
                else:
                    best[y] = np.minimum(best[y], (differ[take] << 48) + x)
                    count[y] += 1
            if size > 1 << 18:
                x, y = (np.concatenate(side_) for side_ in zip(*held, strict=True))
                yield told(x, y, np.zeros(len(x), dtype=bool))
                held, size = [], 0
        if every:
            if size:
                x, y = (np.concatenate(side_) for side_ in zip(*held, strict=True))
                yield told(x, y, np.zeros(len(x), dtype=bool))
        elif (count > 0).any():
            y = np.flatnonzero(count)
            yield told(best[y] & ((1 << 48) - 1), y, count[y] > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def joined() -> tuple[pa.Table, np.ndarray]:
            table = pa.Table.from_batches(held)
            at = table.column("at").to_numpy()
            return table, np.cumsum(np.concatenate(([True], at[1:] != at[:-1])))

        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                table, group = joined()
                last = int(np.searchsorted(group, group[-1]))
                if last:
                    yield from pairs(table.slice(0, last), group[:last])
                held, rows = table.slice(last).to_batches(), 0
        if held:
            yield from pairs(*joined())

    return run


def _line_slot(text_key: Column, line: Column) -> Column:
    return (text_key.bitwiseAND(_SLOTS - 1) + line * 40503).bitwiseAND(_SLOTS - 1).cast("int")


def _met(entries: DataFrame, hot: DataFrame, every: bool) -> DataFrame:
    """Distinct candidate pairs (x earlier than y), stored."""
    rows = _cells(entries, hot).repartition("at").sortWithinPartitions("at")
    schema = "x_text bigint, x_line bigint, y_text bigint, y_line bigint, more boolean"
    found = rows.mapInArrow(_candidates(every), schema)
    return stored(found.groupBy("x_text", "x_line", "y_text", "y_line").agg(F.max("more").alias("more")), "pairs")


def _verified(pairs: DataFrame, docs: DataFrame, common) -> DataFrame:
    """(text_key, line) of the later sets of pairs whose whole sets reach the similarity.

    Only texts with a wanted line are cut again: those of broadcast keys, or beyond
    ``FEW`` keys those that pass a filter of fixed size. Only lines that pass such a
    filter are given; the joins that follow are exact.
    """
    sides = F.explode(F.array(*[F.struct(F.col(f"{s}_text").alias("text_key"), F.col(f"{s}_line").alias("line")) for s in "xy"]))
    wanted = stored(pairs.select(sides.alias("of")).select("of.*").distinct(), "wanted")
    spark = docs.sparkSession
    keys = wanted.select("text_key").distinct()
    few = keys.count() <= FEW
    texts = spark.sparkContext.broadcast(None if few else np.flatnonzero(member_filter(wanted, "text_key")))
    slots = wanted.select(_line_slot(F.col("text_key"), F.col("line")).alias("slot")).distinct().toArrow().column("slot")
    lines_in = spark.sparkContext.broadcast(slots.to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _Ranks(common.value)
        inside, lined = np.zeros(_SLOTS, dtype=bool), np.zeros(_SLOTS, dtype=bool)
        inside[slice(None) if texts.value is None else texts.value], lined[lines_in.value] = True, True
        for batch in batches:
            take = inside[batch.column("slot").to_numpy()]
            for part in slices(iter([batch.filter(pa.array(take))]), most=TOGETHER) if take.any() else ():
                words, line_of, place = _line_words(part.column("text"))
                text_key = part.column("text_key").to_numpy()
                number = place[1]
                wants = lined[((text_key[place[0]] & (_SLOTS - 1)) + number * 40503) & (_SLOTS - 1)]
                words, line_of = words[wants[line_of]], line_of[wants[line_of]]
                if len(words) == 0:
                    continue
                lines, tokens = _tokens(words, line_of, ranks)
                begin = np.flatnonzero(np.concatenate(([True], lines[1:] != lines[:-1])))
                sets = _lists(tokens, np.diff(np.append(begin, len(lines))))
                at = lines[begin]
                yield pa.RecordBatch.from_arrays([pa.array(text_key[place[0][at]]), pa.array(number[at]), sets], names=["text_key", "line", "tokens"])

    cut = docs.join(F.broadcast(keys), "text_key", "left_semi") if few else docs
    cut = cut.select("text_key", filter_slot("text_key").alias("slot"), "text")
    found = cut.mapInArrow(run, "text_key bigint, line bigint, tokens array<bigint>").join(wanted, ["text_key", "line"], "left_semi")
    sets = stored(found.dropDuplicates(["text_key", "line"]), "sets")
    x, y = (sets.select(F.col("text_key").alias(f"{s}_text"), F.col("line").alias(f"{s}_line"), F.col("tokens").alias(f"{s}_tokens")) for s in "xy")
    both = F.size(F.array_intersect("x_tokens", "y_tokens"))
    near = (
        pairs.join(x, ["x_text", "x_line"]).join(y, ["y_text", "y_line"])
        .where(9 * both >= 4 * (F.size("x_tokens") + F.size("y_tokens")))
    )
    return near.select(F.col("y_text").alias("text_key"), F.col("y_line").alias("line")).distinct()


def _hot(classes: DataFrame, words: DataFrame, common) -> DataFrame:
    """(token, blocks) of the tokens that more than ``CELL`` sets have in their prefix.

    Only words that occur that often in all lines can be such tokens, so no others are
    counted.
    """
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _Ranks(common.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(ranks.tokens(batch.column(0).to_numpy()))], names=["token"])

    often = words.where(F.col("n") > CELL).select("token").mapInArrow(named, "token bigint")
    sets = classes.select(F.explode("prefix").alias("token")).join(often, "token").groupBy("token").agg(F.count(F.lit(1)).alias("sets"))
    return stored(sets.where(F.col("sets") > CELL).select("token", F.ceil(F.col("sets") / CELL).cast("bigint").alias("blocks")), "hot")


def repeated_lines(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, n_lines, same, near) per distinct document with a line.

    Lines are split at line breaks, their sets are the distinct words lower-cased
    (A-Z); lines without words are no lines here. Order is by document, then line.
    A line in ``same`` has the set of an earlier line; a line in ``near`` has not, but
    an earlier line's set with Jaccard 0.8 or more. Both hold line numbers from 0.

    Method: words are counted over all lines; sets are ordered by rarity and meet at
    the words of their prefixes, where sizes, positions and bitmaps bound their
    overlap; the overlap of whole sets decides. Lines with one set are one row of the
    join. A set is first compared, at each of its prefix words, with the earlier set
    that is nearest by bitmap. Sets that then have no match, but other candidates,
    are compared with all of these. A word in the prefixes of very many sets is split
    into cells of bounded size.

    Defined cases: NULL, empty and blank texts have no lines. A NULL key sorts first.
    Repeated rows are one document; a key with several texts is ordered by their
    hash next. Very long lines are whole sets. Other columns are not looked at. Texts,
    words and sets are compared by 64-bit hashes.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    counts = docs.select("text").mapInArrow(_word_counts, "token bigint, n bigint")
    counted = stored(counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= setjoin.COMMON_FROM), "counted")
    common = spark.sparkContext.broadcast(setjoin.common_tokens(counted))
    schema = "doc_id bigint, text_key bigint, line bigint, n_lines bigint, key bigint, n int, low bigint, high bigint, prefix array<bigint>"
    with noted() as made:
        wide = stored(docs.mapInArrow(_line_sets(common), schema), "lines")
        place = F.struct("doc_id", "text_key", "line")
        same_set = [F.first(c).alias(c) for c in ("n", "low", "high", "prefix")]
        classes = stored(wide.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"), *same_set), "classes")
        lines = stored(wide.select("doc_id", "text_key", "line", "n_lines", "key"), "lines")
        removed(spark, [made.pop(0)])  # the prefixes are in the classes
    compared = classes.where(F.size("prefix") > 0)
    hot = _hot(compared, counted, common)
    pairs = _met(_entries(compared, F.lit(1)), hot, every=False)
    near = stored(_verified(pairs, docs, common), "near")
    more = pairs.where("more").select(F.col("y_text").alias("text_key"), F.col("y_line").alias("line")).distinct()
    left = stored(more.join(near, ["text_key", "line"], "left_anti").withColumn("asks", F.lit(1)), "left")
    asking = compared.withColumns({"text_key": F.col("first.text_key"), "line": F.col("first.line")}).join(left, ["text_key", "line"], "left")
    tokens = stored(asking.where("asks = 1").select(F.explode("prefix").alias("token")).distinct(), "tokens")
    again = _entries(asking.drop("text_key", "line"), F.coalesce("asks", F.lit(0))).join(tokens, "token", "left_semi")
    others = _met(again, hot, every=True).join(pairs.drop("more"), ["x_text", "x_line", "y_text", "y_line"], "left_anti")
    near = stored(near.unionByName(_verified(stored(others, "others"), docs, common)).distinct().withColumn("near", F.lit(True)), "near")
    flags = classes.select("key", "first", "last", "first.text_key", "first.line").join(near, ["text_key", "line"], "left")
    flags = flags.select("key", "first", F.coalesce("near", F.lit(False)).alias("near")).where((F.col("last") > F.col("first")) | F.col("near"))
    judged = lines.join(flags, "key").select("doc_id", "text_key", "line", (place > F.col("first")).alias("same"), "near").where("same OR near")
    none = F.lit(None).cast("bigint")
    told = judged.select(
        "doc_id", "text_key", none.alias("n_lines"), F.when(F.col("same"), F.col("line")).alias("same"),
        F.when(F.col("near") & ~F.col("same"), F.col("line")).alias("near"),
    )
    texts = lines.groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"))
    every = texts.withColumns({"same": none, "near": none}).unionByName(told)
    return every.groupBy("doc_id", "text_key").agg(
        F.max("n_lines").alias("n_lines"),
        F.sort_array(F.collect_set("same")).alias("same"), F.sort_array(F.collect_set("near")).alias("near"),
    )


def _by_text(documents: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """(row, text, n_lines, same, near) per row of ``documents``."""
    rows = documents.select(
        whole_row(documents).alias("row"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"),
    )
    same_row = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_key"] == found["text_key"])
    return rows.join(found, same_row, "left").select("row", "text", rows["doc_id"], "n_lines", "same", "near")


def line_report(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_same, n_near, removed) per row; ``removed`` lists line numbers."""
    none = F.array().cast("array<bigint>")
    joined = _by_text(documents.select(key, text), repeated_lines(documents, key, text), key, text)
    same, near = F.coalesce("same", none), F.coalesce("near", none)
    return joined.select(
        "doc_id", F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"), F.size(same).cast("bigint").alias("n_same"),
        F.size(near).cast("bigint").alias("n_near"), F.sort_array(F.concat(same, near)).alias("removed"),
    )


def without_repeated_lines(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with the removed lines cut from the text, all columns and rows."""
    joined = _by_text(documents, repeated_lines(documents, key, text), key, text)
    gone: Column = F.concat("same", "near")
    left = F.array_join(F.filter(F.split(F.col("text"), "\n", -1), lambda _, i: ~F.array_contains(gone, i.cast("bigint"))), "\n")
    whole = F.col("same").isNull() | (F.size(gone) == 0)
    return joined.select(*[
        F.when(whole, F.col("text")).otherwise(left).alias(c) if c == text else F.col(f"row.`{c}`") for c in documents.columns
    ])
