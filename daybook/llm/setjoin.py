"""Exact similarity self-join of sets at Jaccard 0.8, shared by the set operators.

A set's tokens follow one global order, common tokens last. Two sets of similarity
0.8 share a token among the first ``n - ceil(0.8 n) + 1`` of each (their prefixes),
whatever the order is; the order only decides how few pairs share one.

Groups of near copies share most prefix tokens. Emitting all their pairs would grow
with the square of the group, so a token's sets are first joined with one leader
each and, if they are many, with a few neighbours each. Only sets that this leaves in
different groups are paired one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import commonest, stored

#: Tokens in this many sets or more are put last in the order, the commonest at the end.
COMMON_FROM = 12
#: As many common tokens are told to all tasks at most (16 bytes each); the others
#: of them stay where their hash puts them. Results do not depend on it.
MAX_COMMON = 500_000
#: A token in this many sets or more has its sets meet neighbours (see there).
NEIGHBOURS_FROM = 32
#: A token in this many sets or more makes its largest group a home (see ``homes``).
HOME_FROM = 64
#: A block of a product has at most so many tokens and rows (about 8 bytes a token,
#: 16 MB for the overlaps), and is multiplied so many columns at a time.
PRODUCT_TOKENS = 1 << 20
PRODUCT_ROWS = 2048
PRODUCT_COLUMNS = 1024


def prefix_length(n: np.ndarray | int):
    return n - (4 * n + 4) // 5 + 1


def common_tokens(counts: DataFrame, at_least: int = COMMON_FROM, most: int = MAX_COMMON) -> tuple[np.ndarray, np.ndarray]:
    """(sorted tokens, rank of each by count) of the commonest of ``counts(token, n)``."""
    total = stored(counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least), "common")
    top = commonest(total, most).toArrow()
    tokens, n = top.column("token").to_numpy().astype(np.int64), top.column("n").to_numpy()
    order = np.argsort(tokens)
    tokens, n = tokens[order], n[order]
    rank = np.empty(len(tokens), dtype=np.int64)
    rank[np.lexsort((tokens, n))] = np.arange(1, len(tokens) + 1)  # rarest of them first
    return tokens, rank


def ordered(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sorted distinct tokens in the global order: by hash, the common ones last."""
    known, rank = common
    if len(known) == 0:
        return tokens
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    hot = known[at] == tokens
    if not hot.any():
        return tokens
    last = tokens[hot][np.argsort(rank[at[hot]], kind="stable")]
    return np.concatenate((tokens[~hot], last))


def _leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, band, place): repeated sets and tokens of a single set
    go; the first row of a (token, band) leads the others of it; the first rows of
    neighbouring bands, and the two rows at their border, are paired as well.
    """
    schema = None
    names = ("token", "band", "key", "n", "pos")
    held = None  # the last row, not yet emitted: a dict with its pairs, and if it has company
    lead = None  # first row of the current (token, band)

    def out(columns: dict) -> pa.RecordBatch:
        arrays = [pa.array(columns[c]) for c in ("token", "key", "n", "pos")]
        for c in ("lead", "other"):
            none = columns[c + "_at"] < 0
            arrays += [pa.array(columns[c], mask=none), pa.array(columns[c + "_n"], mask=none), pa.array(columns[c + "_pos"], mask=none)]
        return pa.RecordBatch.from_arrays(arrays, names=["token", "key", "n", "pos", "lead", "lead_n", "lead_pos", "other", "other_n", "other_pos"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        c = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in names}
        extra = []
        if lead is not None:
            extra = [lead] if held["same_as_lead"] else [lead, held["row"]]
        base = len(extra)
        if base:
            c = {x: np.concatenate((np.array([r[x] for r in extra], dtype=c[x].dtype), c[x])) for x in names}
        size = len(c["token"])
        keep = np.ones(size, dtype=bool)
        keep[1:] = (c["token"][1:] != c["token"][:-1]) | (c["key"][1:] != c["key"][:-1]) | (c["band"][1:] != c["band"][:-1])
        if base:
            keep[:base] = True
        c = {x: v[keep] for x, v in c.items()}
        size = len(c["token"])
        new_token = np.ones(size, dtype=bool)
        new_token[1:] = c["token"][1:] != c["token"][:-1]
        new_band = new_token.copy()
        new_band[1:] |= c["band"][1:] != c["band"][:-1]
        at = np.arange(size)
        first = np.maximum.accumulate(np.where(new_band, at, 0))
        lead_at = np.where(new_band, -1, first)
        other_at = np.full(size, -1)
        border = new_band & ~new_token
        lead_at[border] = first[np.maximum(at - 1, 0)][border]
        other_at[border] = (at - 1)[border]
        other_at[other_at == lead_at] = -1
        company = ~new_token
        company[:-1] |= ~new_token[1:]
        if base:  # the carried last row has the pairs it got in its own batch
            company[base - 1] |= held["company"]
            head = held["pairs"]
        col = {"token": c["token"], "key": c["key"], "n": c["n"], "pos": c["pos"]}
        for name, where in (("lead", lead_at), ("other", other_at)):
            source = np.maximum(where, 0)
            col[name], col[name + "_n"], col[name + "_pos"] = c["key"][source], c["n"][source], c["pos"][source]
            col[name + "_at"] = where
            if base:
                p = head[name]
                col[name + "_at"][base - 1] = -1 if p is None else 0
                if p is not None:
                    for k, v in zip((name, name + "_n", name + "_pos"), p, strict=True):
                        col[k][base - 1] = v
        emit = company.copy()
        emit[: max(base - 1, 0)] = False
        emit[-1] = False
        if emit.any():
            yield out({k: v[emit] for k, v in col.items()})
        i = size - 1
        lead_row = {x: c[x][first[i]] for x in names}
        pairs = {
            name: None if col[name + "_at"][i] < 0 else (col[name][i], col[name + "_n"][i], col[name + "_pos"][i])
            for name in ("lead", "other")
        }
        held = {
            "row": {x: c[x][i] for x in names}, "same_as_lead": first[i] == i, "company": bool(company[i]), "pairs": pairs,
            "columns": {k: v[i : i + 1].copy() for k, v in col.items()},
        }
        lead = lead_row
    if held is not None and held["company"]:
        yield out(held["columns"])


_SHARED = (
    "token bigint, key bigint, n int, pos int, lead bigint, lead_n int, lead_pos int, "
    "other bigint, other_n int, other_pos int"
)


def shared_tokens(prefixes: DataFrame, place: Column, label: str) -> DataFrame:
    """Prefix tokens that several sets have, of ``prefixes(key, n, prefix)``.

    ``place`` orders the sets of one token and size band; the first leads.
    """
    entries = prefixes.select(
        "key", F.col("n").cast("int").alias("n"), place.cast("bigint").alias("place"), F.posexplode("prefix").alias("pos", "token")
    ).withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int"))
    rows = entries.repartition("token").sortWithinPartitions("token", "band", "place", "key")
    return stored(rows.select("token", "band", "key", "n", "pos").mapInArrow(_leaders, _SHARED), label)


def may_match(n1: Column, pos1: Column, n2: Column, pos2: Column) -> Column:
    """Length and positional bounds of a pair for the first token it shares.

    All of the needed overlap, 4/9 of both sizes, then lies at these positions or
    after them. A pair that is similar passes at its first shared token; whether it
    also does at later ones does not matter.
    """
    return (9 * (n1 - pos1) >= 4 * (n1 + n2)) & (9 * (n2 - pos2) >= 4 * (n1 + n2)) & (5 * F.least(n1, n2) >= 4 * F.greatest(n1, n2))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def leader_pairs(shared: DataFrame) -> DataFrame:
    """(a, b) of the sets that were given a leader and meet the bounds."""
    def of(name: str) -> DataFrame:
        ok = may_match(F.col("n"), F.col("pos"), F.col(f"{name}_n"), F.col(f"{name}_pos"))
        return shared.where(F.col(name).isNotNull() & ok).select(*_pair(name, "key"))

    return of("lead").unionByName(of("other"))


def bounded_pairs(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose overlap within the prefixes can still be enough.

    Common tokens outside both prefixes' overlap lie in the rest of the set whose
    prefix ends first, so overlap + that rest bounds the whole overlap.
    """
    few = prefixes.join(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", "left_semi")
    few = stored(few.dropDuplicates(["key"]), "bounds")
    a = few.select(F.col("key").alias("a"), F.col("n").alias("a_n"), F.col("prefix").alias("a_prefix"))
    b = few.select(F.col("key").alias("b"), F.col("n").alias("b_n"), F.col("prefix").alias("b_prefix"))
    return (
        pairs.join(a, "a").join(b, "b")
        .where(_can_reach(F.size(F.array_intersect("a_prefix", "b_prefix")), F.col("a_n"), F.col("b_n")))
        .select("a", "b")
    )


def _can_reach(overlap: Column, n1: Column, n2: Column) -> Column:
    rest = F.greatest(F.floor((4 * n1 + 4) / 5), F.floor((4 * n2 + 4) / 5)) - 1
    return (9 * (overlap + rest) >= 4 * (n1 + n2)) & (5 * F.least(n1, n2) >= 4 * F.greatest(n1, n2))


def apart(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """The shared tokens whose sets are in several groups, with each token's largest."""
    rows = shared.select("token", "key", "n", "pos").join(groups.withColumnRenamed("node", "key"), "key", "left")
    rows = rows.select("token", "key", "n", "pos", F.coalesce("component", "key").alias("component"))
    sizes = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("size"))
    main = (
        sizes.groupBy("token").agg(F.count(F.lit(1)).alias("groups"), F.max_by("component", F.struct("size", "component")).alias("main"))
        .where("groups > 1").select("token", "main")
    )
    return stored(rows.join(main, "token"), "apart")


def neighbour_pairs(shared: DataFrame) -> DataFrame:
    """(a, b) of sets that happen to be neighbours in a token that many sets have.

    The sets of such a token are put in an order of its own by a hash, and each meets
    the next two. A set gets two partners per token, so the pairs grow with the shared
    tokens, not with the square of a group, and a group whose members are mostly within
    reach of each other becomes one.
    """
    large = shared.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") >= NEIGHBOURS_FROM).select("token")
    w = Window.partitionBy("token").orderBy(F.xxhash64("token", "key"), "key")
    me = F.struct("key", "n", "pos")
    near = shared.join(large, "token").select(me.alias("x"), F.array(F.lead(me, 1).over(w), F.lead(me, 2).over(w)).alias("next"))
    met = near.select("x", F.explode("next").alias("y")).where("y is not null")
    return met.where(may_match(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"))).select(*_pair("x.key", "y.key"))


def first_pairs(shared: DataFrame) -> DataFrame:
    """Distinct (a, b) that are tried before all others: with leaders and neighbours."""
    return leader_pairs(shared).unionByName(neighbour_pairs(shared)).where("a <> b").distinct()


def homes(apart: DataFrame) -> DataFrame:
    """(key, home, component) of sets that share most with one large group.

    A home is the largest group of a token that many sets have. The sets of that group
    belong to it; any other set belongs to the one that most of its tokens name. Homes
    without such guests are left out. Pairs within a home are left to
    ``product_links``, all other pairs to ``remaining_pairs``.
    """
    large = apart.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") >= HOME_FROM).select("token")
    votes = apart.join(large, "token").groupBy("key", "component", F.col("main").alias("home")).agg(F.count(F.lit(1)).alias("votes"))
    voted = stored(votes.groupBy("key", "component").agg(F.max_by("home", F.struct("votes", "home")).alias("home")), "votes")
    named = voted.select(F.col("home").alias("component")).distinct()
    own = apart.select("key", "component").distinct().join(named, "component", "left_semi")
    guests = voted.join(named, "component", "left_anti")
    every = own.select("key", F.col("component").alias("home"), "component").unionByName(guests.select("key", "home", "component"))
    return stored(every.join(guests.select("home").distinct(), "home", "left_semi"), "homes")


def _products(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between two blocks of sets, one for each set and other component.

    The blocks are incidence matrices over the tokens they share. Their product, a
    block of columns at a time, accumulates the overlaps of all pairs of rows.
    """
    found_a, found_b = [], []
    if left.num_rows and right.num_rows:
        sides = []
        for t in (left, right):
            lists = t.column("tokens").combine_chunks()
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            sides.append((t.column("key").to_numpy(), t.column("component").to_numpy(), n, np.repeat(np.arange(len(n)), n), lists.flatten().to_numpy()))
        (a, a_group, a_n, a_row, a_token), (b, b_group, b_n, b_row, b_token) = sides
        both = np.intersect1d(a_token, b_token)
        overlap = np.zeros((len(a), len(b)), dtype=np.float32)
        for at in range(0, len(both), PRODUCT_COLUMNS):
            columns = both[at : at + PRODUCT_COLUMNS]
            matrices = []
            for rows, row, token in ((len(a), a_row, a_token), (len(b), b_row, b_token)):
                where = np.minimum(np.searchsorted(columns, token), len(columns) - 1)
                hit = columns[where] == token
                m = np.zeros((rows, len(columns)), dtype=np.float32)
                m[row[hit], where[hit]] = 1
                matrices.append(m)
            overlap += matrices[0] @ matrices[1].T
        linked = (9 * overlap >= 4 * (a_n[:, None] + b_n[None, :])) & (a_group[:, None] != b_group[None, :])
        i, j = np.nonzero(linked)
        _, first = np.unique(np.stack((i, b_group[j])), axis=1, return_index=True)
        found_a, found_b = np.minimum(a[i], b[j])[first], np.maximum(a[i], b[j])[first]
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def product_links(at_home: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of ``at_home(key, home, component)`` within each home.

    The sets outside the home's own group are multiplied with all sets of the home,
    in blocks of so many tokens that two blocks and their product fit in a task. Of
    the links of one set with one other group one per block is given: enough to join
    them. ``sets(key, tokens)`` has the whole sets, so no more verification follows.
    """
    rows = at_home.join(sets, "key").withColumn("n", F.size("tokens"))
    sizes = rows.groupBy("home").agg(
        F.greatest(F.ceil(F.sum("n") / PRODUCT_TOKENS), F.ceil(F.count(F.lit(1)) / PRODUCT_ROWS)).cast("int").alias("blocks")
    )
    rows = rows.join(sizes, "home").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ("key", "component", "tokens")
    fresh = [F.col(c).alias(c) for c in columns]  # told apart from the right side's columns
    left = rows.where("component <> home").select(F.col("home").alias("home"), F.col("own").alias("i"), every.alias("j"), *fresh)
    right = rows.select("home", every.alias("i"), F.col("own").alias("j"), *columns)
    blocks = ("home", "i", "j")
    return left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInArrow(_products, "a bigint, b bigint").distinct()


def remaining_pairs(apart: DataFrame, at_home: DataFrame, tested: DataFrame) -> DataFrame:
    """Distinct (a, b) across groups and homes that meet the bounds and were not tested.

    A token all of whose sets are in one group gave no rows in ``apart``; else the
    sets outside its largest group are joined with all of its sets, so the largest
    group is never paired with itself.
    """
    apart = apart.join(at_home.select("key", "home"), "key", "left")
    columns = ("key", "n", "pos", "component", "main", "home")
    x = apart.where("component <> main and (home is null or home <> main)").select("token", *[F.col(c).alias(f"x_{c}") for c in columns])
    y = apart.select("token", *[F.col(c).alias(f"y_{c}") for c in columns])
    y_first = (F.col("y_component") != F.col("y_main")) & (F.col("y_home").isNull() | (F.col("y_home") != F.col("y_main")))
    met = x.join(y, "token").where(
        (F.col("x_component") != F.col("y_component")) & (~y_first | (F.col("x_key") < F.col("y_key")))
        & (F.col("x_home").isNull() | F.col("y_home").isNull() | (F.col("x_home") != F.col("y_home")))
        & may_match(F.col("x_n"), F.col("x_pos"), F.col("y_n"), F.col("y_pos"))
    )
    return met.select(*_pair("x_key", "y_key")).distinct().join(tested, ["a", "b"], "left_anti")
