"""The registered queries of this package as DuckDB SQL over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str, separators: str = r"[\x20\x09-\x0D]+", lower: bool = False) -> str:
    """SQL for the list of words of a text column."""
    text = f"coalesce({text}, '')"
    if lower:
        text = f"translate({text}, '{UPPER}', '{LOWER}')"
    return f"list_filter(string_split_regex({text}, '{separators}'), lambda x: x <> '')"


def jaccard_components(documents: str = "documents") -> str:
    """CTEs ending in ``component(doc_id, n_shingles, component_id)``."""
    return f"""
    doc_words AS (SELECT doc_id, {words('text', lower=True)} AS w FROM {documents}),
    shingle AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
            THEN list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM doc_words),
    sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    overlap AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id
        GROUP BY 1, 2),
    link AS (
        SELECT a, b FROM overlap JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
        WHERE 100 * i >= 80 * (x.n + y.n - i)),
    both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM {documents} UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
    component AS (
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id FROM {documents} d
        LEFT JOIN sized USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id)"""


def contamination(documents: str = "documents") -> str:
    """CTEs ending in ``contaminated(doc_id, n_words, n_hit, n_items, items_sha256)``."""
    separators = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
    item AS (SELECT item_id, {words('text', separators, True)} AS w FROM benchmark),
    item_window AS (
        SELECT item_id, unnest(CASE WHEN len(w) >= 10
            THEN list_transform(generate_series(1, len(w) - 9), lambda i: w[i:i + 9])
            WHEN len(w) > 0 THEN [w] ELSE [] END) AS win FROM item),
    win AS (SELECT DISTINCT item_id, len(win) AS size, array_to_string(win, ' ') AS win FROM item_window),
    doc AS (SELECT doc_id, {words('text', separators, True)} AS w FROM {documents}),
    gram AS (
        SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS win FROM (
            SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS p
            FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)),
    hit AS (SELECT doc_id, p, size, item_id FROM gram JOIN win USING (size, win)),
    hit_word AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + size - 1)) AS p FROM hit),
    hit_items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hit GROUP BY doc_id),
    contaminated AS (
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
               sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256
        FROM doc LEFT JOIN (SELECT doc_id, count(*) AS n FROM hit_word GROUP BY doc_id) h USING (doc_id)
        LEFT JOIN hit_items USING (doc_id))"""


def mixed(documents: str = "documents") -> str:
    """CTEs ending in ``mix(doc_id, size, source_size, target, taken)`` and the quota."""
    return f"""
    sized AS (SELECT *, len({words('text')})::BIGINT AS size, md5(doc_id::VARCHAR) AS h FROM {documents}),
    src AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
    weighed AS (SELECT source, s, 3 * s AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM src),
    running AS (
        SELECT *, sum(s) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
               sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight
        FROM weighed),
    level AS (SELECT rest, rest_weight FROM running WHERE rest * weight <= cap * rest_weight ORDER BY cap / weight, source NULLS LAST LIMIT 1),
    targets AS (
        SELECT source, s, CASE WHEN w.weight * l.rest <= w.cap * l.rest_weight
            THEN (w.weight * l.rest)::DOUBLE / l.rest_weight::DOUBLE ELSE cap::DOUBLE END AS target
        FROM weighed w, level l),
    placed AS (
        SELECT d.*, t.s, t.target, floor(t.target + 0.5)::BIGINT AS quota,
               coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
    mix AS (
        SELECT *, (greatest(0, least(size, quota - before)) + greatest(0, least(size, quota - s - before))
                   + greatest(0, least(size, quota - 2 * s - before)))::BIGINT AS taken
        FROM placed)"""


def shards(limit: int, documents: str = "documents") -> str:
    """CTEs ending in ``cut``: the shortest hash prefix whose rows fit the limit."""
    return f"""
    hashed AS (
        SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS bits, coalesce(strlen(text), 0)::BIGINT AS bytes
        FROM {documents}),
    bucket AS (
        SELECT depth, bits >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
        FROM hashed, (SELECT unnest(generate_series(0, 60)) AS depth) GROUP BY ALL),
    cut AS (
        SELECT h.*, depth, prefix, shard_bytes, shard_rows, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS nth
        FROM hashed h JOIN bucket b ON h.bits >> (60 - depth) = prefix WHERE shard_bytes <= {limit} OR depth = 60)"""


LINE_DEDUP = f"""
    WITH split AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line_text,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line FROM documents),
    line AS (
        SELECT doc_id, line, list_sort(list_distinct({words('line_text', lower=True)})) AS w FROM split),
    kept AS (SELECT doc_id, line, w, array_to_string(w, ' ') AS s FROM line WHERE len(w) > 0),
    class AS (SELECT s, any_value(w) AS w, min((doc_id, line)) AS first, row_number() OVER () AS c FROM kept GROUP BY s),
    word AS (SELECT c, len(w) AS n, unnest(w) AS t FROM class),
    rare AS (
        SELECT c, n, t FROM (
            SELECT c, n, t, row_number() OVER (PARTITION BY c ORDER BY df, t) AS p
            FROM word JOIN (SELECT t, count(*) AS df FROM word GROUP BY t) USING (t))
        WHERE p <= n - (4 * n + 4) // 5 + 1),
    pair AS (
        SELECT DISTINCT a.c AS a, b.c AS b FROM rare a JOIN rare b ON a.t = b.t AND a.c < b.c
        WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
    link AS (
        SELECT x.first AS x, y.first AS y, x.s AS xs, y.s AS ys FROM pair JOIN class x ON x.c = a JOIN class y ON y.c = b
        WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (len(x.w) + len(y.w))),
    near AS (SELECT DISTINCT CASE WHEN x > y THEN xs ELSE ys END AS s FROM link),
    judged AS (
        SELECT k.doc_id, k.line, (k.doc_id, k.line) > c.first AS same, near.s IS NOT NULL AS near
        FROM kept k JOIN class c ON c.s = k.s LEFT JOIN near ON near.s = k.s),
    report AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (same) AS n_same, count(*) FILTER (near AND NOT same) AS n_near,
               string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (same OR near) AS removed
        FROM judged GROUP BY doc_id)
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_same, 0) AS n_same, coalesce(n_near, 0) AS n_near, coalesce(removed, '') AS removed
    FROM documents LEFT JOIN report USING (doc_id)"""


#: A checksum as a list of steps: a byte is mixed in, then -1 shifts by one bit.
CRC32 = """xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END))"""

PREFIX_TRIE = f"""
    WITH turn_of AS (
        SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
        FROM conversations WHERE conv_id IS NOT NULL),
    conv AS (
        SELECT conv_id, conv_id - conv_id % 100 AS head, {CRC32.format("conv_id::VARCHAR")} % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM turn_of)),
    piece AS (
        SELECT c.conv_id, 0 AS own, i, t FROM conv c JOIN turn_of x ON x.conv_id = c.head AND i <= h
        UNION ALL SELECT c.conv_id, 1, i, t FROM conv c JOIN turn_of x ON x.conv_id = c.conv_id AND i > h),
    rebuilt AS (
        SELECT conv_id, coalesce(list(t ORDER BY own, i) FILTER (t IS NOT NULL), []) AS turns
        FROM conv LEFT JOIN piece USING (conv_id) GROUP BY conv_id),
    prefix AS (SELECT conv_id, len(turns) AS size, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt),
    node AS (
        SELECT d, turns[1:d] AS p, min(conv_id) AS conv_id, count(*) AS n, count(*) FILTER (size = d) AS n_ends,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
        FROM prefix GROUP BY ALL),
    child AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
    judged AS (
        SELECT x.*, coalesce(c.n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (x.n - 1) * length(p[d].text) END AS saved
        FROM node x LEFT JOIN child c USING (d, p)),
    above AS (SELECT unnest(range(d + 1)) AS a, p, n_children, saved FROM judged),
    total AS (
        SELECT a AS d, p[1:a] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY ALL)
    SELECT x.conv_id, x.d AS depth, y.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children, n_leaves, saved_tokens, x.ends_sha256
    FROM judged x JOIN total USING (d, p) LEFT JOIN node y ON y.d = x.d - 1 AND y.p = x.p[1:x.d - 1]"""

SOURCE_DIVERGENCE = f"""
    WITH doc AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
               regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
        FROM documents),
    word AS (SELECT lang, source, id, unnest(w) AS term FROM doc),
    kept AS (SELECT lang, term, count(*) AS total FROM word GROUP BY 1, 2 HAVING count(DISTINCT id) >= 3),
    counted AS (SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY ALL),
    grp AS (SELECT DISTINCT lang, source FROM doc),
    of_lang AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS n FROM kept GROUP BY lang),
    of_group AS (SELECT lang, source, sum(n)::BIGINT AS n FROM counted GROUP BY 1, 2),
    total AS (
        SELECT lang, source, coalesce(g.n, 0) + coalesce(l.v, 0) AS own, coalesce(l.n, 0) + coalesce(l.v, 0) AS whole
        FROM grp LEFT JOIN of_lang l USING (lang) LEFT JOIN of_group g USING (lang, source)),
    share AS (
        SELECT lang, source, term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // own AS p,
               1 + 1000000000 * (k.total + 1) // whole AS q
        FROM total JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
    summed AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
        FROM share a JOIN share b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
    valued AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM share WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM valued)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200"""


ORACLE = {
    "op3_ngram_jaccard": f"WITH RECURSIVE {jaccard_components()} SELECT doc_id, n_shingles, component_id FROM component",
    "op4_decontamination": f"WITH {contamination()} SELECT *, n_hit > 0 AS contaminated FROM contaminated",
    "op7_mixing": f"WITH {mixed()} SELECT doc_id, size, s AS source_size, target, taken FROM mix",
    "op9_sharding": f"""
        WITH {shards(1 << 20)}
        SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INT, '0') END AS shard, depth::INT AS depth,
               bytes, shard_bytes, shard_rows
        FROM cut WHERE nth = 1""",
    "op10_line_dedup": LINE_DEDUP,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_source_divergence": SOURCE_DIVERGENCE,
}
