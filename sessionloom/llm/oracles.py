"""What SQL can say of the operators, in DuckDB over the same tables, by brute force."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from sessionloom.llm import raking

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _components(nodes: str, links: str) -> str:
    """Table expressions up to ``component(id, component_id)``: the smallest id reachable."""
    return f"""both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
    reach AS (SELECT id, id AS top FROM {nodes} UNION
        SELECT l.b, r.top FROM reach r JOIN both_ways l ON l.a = r.id WHERE r.top < l.b),
    component AS (SELECT id, min(top) AS component_id FROM reach GROUP BY id)"""


_LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"

CHOSEN_PATH = f"""WITH RECURSIVE cut AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
    shingle AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
        FROM cut WHERE len(w) >= 5
        UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM cut WHERE len(w) BETWEEN 1 AND 4)),
    size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    meeting AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
    link AS MATERIALIZED (SELECT a, b FROM meeting m JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
        WHERE 100 * m.n >= 85 * (p.n + q.n - m.n)),
    node AS (SELECT DISTINCT doc_id AS id FROM documents),
    {_components("node", "link")}
    SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
    FROM documents d LEFT JOIN size s USING (doc_id) JOIN component c ON c.id = d.doc_id"""

PHRASE_AUTOMATA = f"""WITH cut AS MATERIALIZED (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    win AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM cut WHERE len(w) >= 50)),
    hit AS MATERIALIZED (SELECT doc_id, i, true AS starts FROM win JOIN (SELECT k, min(doc_id) AS f FROM win GROUP BY k) USING (k)
        WHERE f < doc_id),
    word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM cut),
    judged AS (SELECT doc_id, x, i, coalesce(bool_or(starts) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
        FROM word LEFT JOIN hit USING (doc_id, i)),
    left_over AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS kept
        FROM judged GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM cut LEFT JOIN left_over USING (doc_id)"""

MULTI_INDEX = f"""WITH RECURSIVE sound AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    link AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y
        ON x.vec_id < y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
    node AS (SELECT DISTINCT vec_id AS id FROM embeddings),
    {_components("node", "link")},
    degree AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
    SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
    FROM embeddings v JOIN component c ON c.id = v.vec_id LEFT JOIN degree d ON d.id = v.vec_id"""

_CRC = """xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda crc, b: list_reduce(range(8), lambda v, k: xor(v >> 1, (v & 1) * 3988292384), xor(crc, b)),
        4294967295::BIGINT), 4294967295)"""

PREFIX_ROLLUP = f"""WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    named AS MATERIALIZED (SELECT conv_id, pos, dense_rank() OVER (ORDER BY role, text) AS id,
        len({_WORDS.format('text')}) AS words FROM turns),
    sized AS (SELECT conv_id, count(*) AS n, {_CRC} % 4 AS h FROM named GROUP BY conv_id),
    rebuilt AS (SELECT s.conv_id, t.pos, t.id, t.words FROM sized s
            JOIN named t ON t.conv_id = s.conv_id - s.conv_id % 20 AND t.pos <= s.h
        UNION ALL SELECT s.conv_id, t.pos - s.h + least(s.h, coalesce(f.n, 0)), t.id, t.words FROM sized s
            JOIN named t ON t.conv_id = s.conv_id AND t.pos > s.h
            LEFT JOIN sized f ON f.conv_id = s.conv_id - s.conv_id % 20),
    prefix AS MATERIALIZED (SELECT conv_id, pos AS depth, words,
            string_agg(id, '/') OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM rebuilt
        UNION ALL SELECT conv_id, 0, 0, '' FROM sized),
    stepped AS (SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS above,
        depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM prefix),
    node AS MATERIALIZED (SELECT depth, path, min(conv_id) AS conv_id, any_value(above) AS above, any_value(words) AS words,
        count(*) AS n_convs, coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (is_end), '') AS ends
        FROM stepped GROUP BY depth, path),
    child AS (SELECT depth - 1 AS depth, above AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
    below AS (SELECT p.depth, p.path, sum((u.n_convs - 1) * u.words) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
        FROM node u JOIN prefix p ON p.conv_id = u.conv_id AND p.depth <= u.depth
        LEFT JOIN child c ON c.depth = u.depth AND c.path = u.path GROUP BY p.depth, p.path)
    SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0) AS n_children,
        b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
    FROM node v JOIN below b USING (depth, path) LEFT JOIN child c USING (depth, path)
    LEFT JOIN node u ON u.depth = v.depth - 1 AND u.path = v.above"""

ORACLES = {
    "op1_chosen_path": CHOSEN_PATH,
    "op4_raking": raking.oracle(),
    "op5_phrase_automata": PHRASE_AUTOMATA,
    "op8_multi_index": MULTI_INDEX,
    "op12_prefix_rollup": PREFIX_ROLLUP,
}
