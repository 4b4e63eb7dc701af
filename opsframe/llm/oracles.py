"""The results of the text queries that SQL can express, for another engine."""

ESCAPED = """replace(replace(replace(replace(replace(replace(
    coalesce({0}, ''), '\\', '\\\\'), '<|', '<\\|'), '</s>', '<\\/s>'),
    '<s>', '<\\s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]')"""

CHAT = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role,
        coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL
    SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), ''
        ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT)
        AS loss_chars,
    sha256(coalesce(string_agg(text, ''
        ORDER BY turn NULLS FIRST, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<|turn|>' || {ESCAPED.format("role")} || '<|text|>'
        || {ESCAPED.format("text")} || '</s>')) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

WORDS = r"""list_filter(regexp_extract_all(translate(coalesce({0}, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

CONTAMINATION = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {WORDS.format("text")} AS ws
    FROM documents
), items AS (
    SELECT item_id, {WORDS.format("text")} AS ws FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(10, len(ws)) AS k,
        array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS w
    FROM items,
        unnest(generate_series(1, greatest(1, len(ws) - 9))) AS t(i)
    WHERE len(ws) > 0
), places AS (
    SELECT r, i, k, array_to_string(ws[i : i + k - 1], ' ') AS w
    FROM docs, (SELECT DISTINCT k FROM windows) AS ks,
        unnest(generate_series(1, len(ws) - k + 1)) AS t(i)
), hits AS (
    SELECT r, i, p.k AS k, item_id FROM places AS p
    JOIN windows AS q ON p.w = q.w AND p.k = q.k
), words AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM hits, unnest(generate_series(i, i + k - 1)) AS t(place) GROUP BY r
), found AS (
    SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hits
        WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(s, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

QUALITY_RULES = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), places AS (
    SELECT r, i, len(ws) - 7 >= i AS whole,
        array_to_string(ws[i : i + 7], ' ') AS w, ws[i] AS word
    FROM docs, unnest(generate_series(1, len(ws))) AS x(i)
), windows AS (
    SELECT r, i, word,
        whole AND count(*) OVER (PARTITION BY r, whole, w) > 1 AS again
    FROM places
), words AS (
    SELECT r, bool_or(again) OVER (PARTITION BY r ORDER BY i
            ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS again,
        word = lag(word) OVER (PARTITION BY r ORDER BY i) AS same
    FROM windows
), counts AS (
    SELECT r, count(*) FILTER (again) AS n_repeat_words,
        count(*) FILTER (same) AS same FROM words GROUP BY r
), base AS (
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g'))
            AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(same, 0) AS same, len(lines) AS n_lines,
        len(list_filter(ws,
            lambda x: NOT regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS bare,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper,
        length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) AS lower,
        length(t) - length(replace(t, '!', '')) AS bangs
    FROM docs LEFT JOIN counts USING (r)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words
        AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, NOT (base_failed
        OR 10 * n_symbols > n_words
        OR n_dup_lines > 3 AND 10 * n_dup_lines > 3 * n_lines
        OR word_chars < 2 * n_words OR word_chars > 15 * n_words
        OR 10 * bare > 3 * n_words
        OR upper > lower
        OR 5 * bangs > n_words
        OR 10 * same > 3 * n_words) AS kept
FROM judged
"""


def _field(name: str) -> str:
    """A field as the leaf hashes it: '-' for NULL, else byte count, ':' and
    the value as text."""
    text = f"CAST({name} AS VARCHAR)"
    return (
        f"CASE WHEN {name} IS NULL THEN '-' "
        f"ELSE CAST(strlen({text}) AS VARCHAR) || ':' || {text} END"
    )


# CRC-32 by its table, built from the reversed polynomial 0xEDB88320
# (3988292384) by eight shifts of every byte; levels of the trees by a
# recursive grouping of consecutive pairs.
MERKLE = """WITH RECURSIVE
bits(n, k, c) AS (
    SELECT n, 0, n FROM range(256) AS t(n)
    UNION ALL
    SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END
    FROM bits WHERE k < 8
),
crc_table AS (SELECT n, c FROM bits WHERE k = 8),
ids AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
crc_steps(s, i, c) AS (
    SELECT s, 0, 4294967295 FROM ids
    UNION ALL
    SELECT x.s, x.i + 1,
        xor((SELECT t.c FROM crc_table t
             WHERE t.n = xor(x.c, ascii(substr(x.s, x.i + 1, 1))) & 255), x.c >> 8)
    FROM crc_steps x WHERE x.i < length(x.s)
),
crcs AS (SELECT s, xor(c, 4294967295) AS crc FROM crc_steps WHERE i = length(s)),
fields AS (
    SELECT d.doc_id, d.lang, d.source, d.text, d.n_chars,
        CASE WHEN d.n_chars IS NOT NULL AND c.crc % 7 = 0
             THEN d.n_chars + 1 ELSE d.n_chars END AS t_chars
    FROM documents d LEFT JOIN crcs c ON c.s = CAST(d.doc_id AS VARCHAR)
),
leaves AS (
    SELECT doc_id, lang,
        sha256(concat_ws('', {id}, {source}, {lang}, {chars}, {text})) AS leaf,
        sha256(concat_ws('', {id}, {source}, {lang}, {tchars}, {text})) AS tleaf
    FROM fields
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
        count(*) OVER (PARTITION BY lang) AS m
    FROM leaves
),
lt(lang, lvl, idx, h, cnt) AS (
    SELECT lang, 0, r, leaf, m FROM ranked
    UNION ALL
    SELECT lang, lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (cnt + 1) // 2
    FROM lt WHERE cnt > 1 GROUP BY lang, lvl, idx // 2, cnt
),
subroots AS (SELECT lang, h AS subroot FROM lt WHERE cnt = 1),
groups AS (
    SELECT lang, subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
        count(*) OVER () AS k
    FROM subroots
),
gt(lvl, idx, h, cnt) AS (
    SELECT 0, g, subroot, k FROM groups
    UNION ALL
    SELECT lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (cnt + 1) // 2
    FROM gt WHERE cnt > 1 GROUP BY lvl, idx // 2, cnt
),
root AS (SELECT h AS root FROM gt WHERE cnt = 1),
depth AS (SELECT lang, max(lvl) AS d FROM lt GROUP BY lang),
steps AS (
    SELECT x.doc_id, x.leaf, l.lvl AS step, s.h AS sib, (x.r >> l.lvl) % 2 = 0 AS left_side
    FROM ranked x
    JOIN lt l ON l.lang IS NOT DISTINCT FROM x.lang AND l.cnt > 1 AND l.idx = x.r >> l.lvl
    LEFT JOIN lt s ON s.lang IS NOT DISTINCT FROM x.lang AND s.lvl = l.lvl
        AND s.idx = xor(x.r >> l.lvl, 1)
    UNION ALL
    SELECT x.doc_id, x.leaf, dp.d + l.lvl AS step, s.h, (gr.g >> l.lvl) % 2 = 0
    FROM ranked x
    JOIN groups gr ON gr.lang IS NOT DISTINCT FROM x.lang
    JOIN depth dp ON dp.lang IS NOT DISTINCT FROM x.lang
    JOIN gt l ON l.cnt > 1 AND l.idx = gr.g >> l.lvl
    LEFT JOIN gt s ON s.lvl = l.lvl AND s.idx = xor(gr.g >> l.lvl, 1)
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, leaf ORDER BY step) AS k FROM steps
),
folded(doc_id, leaf, k, acc) AS (
    SELECT doc_id, leaf, 0, tleaf FROM ranked
    UNION ALL
    SELECT f.doc_id, f.leaf, f.k + 1,
        CASE WHEN n.sib IS NULL THEN sha256(f.acc)
             WHEN n.left_side THEN sha256(f.acc || n.sib)
             ELSE sha256(n.sib || f.acc) END
    FROM folded f JOIN numbered n
        ON n.doc_id IS NOT DISTINCT FROM f.doc_id AND n.leaf = f.leaf AND n.k = f.k + 1
),
last AS (
    SELECT doc_id, leaf, arg_max(acc, k) AS folded_root FROM folded GROUP BY doc_id, leaf
),
proofs AS (
    SELECT x.doc_id, x.leaf,
        sha256(coalesce(string_agg(n.sib, '' ORDER BY n.k), '')) AS proof_sha256
    FROM ranked x LEFT JOIN numbered n
        ON n.doc_id IS NOT DISTINCT FROM x.doc_id AND n.leaf = x.leaf
    GROUP BY x.doc_id, x.leaf
)
SELECT x.doc_id, x.leaf, s.subroot, r.root, p.proof_sha256, l.folded_root,
    l.folded_root = r.root AS verified
FROM ranked x
JOIN subroots s ON s.lang IS NOT DISTINCT FROM x.lang
CROSS JOIN root r
JOIN proofs p ON p.doc_id IS NOT DISTINCT FROM x.doc_id AND p.leaf = x.leaf
JOIN last l ON l.doc_id IS NOT DISTINCT FROM x.doc_id AND l.leaf = x.leaf
""".format(
    id=_field("doc_id"),
    source=_field("source"),
    lang=_field("lang"),
    chars=_field("n_chars"),
    tchars=_field("t_chars"),
    text=_field("text"),
)


ORACLES = {
    "op4_decontamination": CONTAMINATION,
    "op7_chat_tree": CHAT,
    "op9_quality_rules": QUALITY_RULES,
    "op11_merkle_manifest": MERKLE,
}
