"""DuckDB SQL of the operators that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^ \t-\r]+') AS t FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(t) >= 4 THEN list_transform(range(1, len(t) - 2), lambda i: array_to_string(t[i:i + 3], ' '))
        WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS g
    FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), p AS (
    SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)
), r AS (
    SELECT doc_id, doc_id AS root FROM w UNION SELECT p.y, r.root FROM r JOIN p ON p.x = r.doc_id
)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.root) AS component_id
FROM w JOIN r ON r.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""

LINE_DEDUP = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS line FROM split
), solid AS (
    SELECT doc_id, i, line, len(regexp_extract_all(line, '[^ \t-\r]+')) AS n,
        row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
    FROM lines WHERE regexp_matches(line, '[^ \t-\r]')
), seq AS (
    SELECT doc_id, list(line ORDER BY pos) AS l, list(n ORDER BY pos) AS c, count(*) AS m FROM solid GROUP BY doc_id
), ends AS (
    SELECT doc_id, l, c, a, unnest(range(a, least(a + 7, m) + 1)) AS b
    FROM (SELECT doc_id, l, c, m, unnest(range(1, m + 1)) AS a FROM seq)
), runs AS (
    SELECT doc_id, a, b, array_to_string(l[a:b], chr(10)) AS run FROM ends
    WHERE list_sum(c[a:b]) >= 8 AND (list_sum(c[a:b]) - c[b] < 8 OR list_sum(c[a:b]) - c[a] < 8)
), firsts AS (
    SELECT run, min((doc_id, a)) AS origin FROM runs GROUP BY run
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS pos FROM runs JOIN firsts USING (run) WHERE (doc_id, a) > origin
), spans AS (
    SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE lag IS NULL OR lag < pos - 1) AS n_runs
    FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS lag FROM gone) GROUP BY doc_id
), dropped AS (
    SELECT doc_id, i FROM solid JOIN gone USING (doc_id, pos)
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
    FROM lines ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT s.doc_id, coalesce(q.m, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_runs, 0)::BIGINT AS n_runs, length(coalesce(kept.text, ''))::INTEGER AS kept_chars, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split s LEFT JOIN seq q USING (doc_id) LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""



def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    step = "list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, k: xor(a >> 1, (a & 1) * 3988292384), xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(chars: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', chars, 'text'))})"


MERKLE_MANIFEST = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '-') AS g, {_leaf('n_chars')} AS leaf,
        CASE WHEN {_crc32('doc_id::VARCHAR')} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf('n_chars::HUGEINT + 1')} END AS altered
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM d
), low AS (
    SELECT 0 AS lv, g, idx, n, leaf AS h FROM leaves
    UNION ALL
    SELECT lv + 1, g, idx // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY lv, g, idx // 2
), tops AS (
    SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
    SELECT 0 AS lv, idx, n, h FROM tops
    UNION ALL
    SELECT lv + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY lv, idx // 2
), climb AS (
    SELECT rid, g, 0 AS lv, idx, n, coalesce(altered, leaf) AS cur, '' AS proof FROM leaves
    UNION ALL
    SELECT c.rid, c.g, c.lv + 1, c.idx // 2, (c.n + 1) // 2,
        sha256(CASE WHEN c.idx % 2 = 1 THEN s.h || c.cur ELSE c.cur || coalesce(s.h, '') END), c.proof || coalesce(s.h, '')
    FROM climb c LEFT JOIN low s ON s.lv = c.lv AND s.g = c.g AND s.idx = xor(c.idx, 1) WHERE c.n > 1
), ascend AS (
    SELECT c.rid, 0 AS lv, t.idx, t.n, c.cur, c.proof FROM climb c JOIN tops t USING (g) WHERE c.n = 1
    UNION ALL
    SELECT c.rid, c.lv + 1, c.idx // 2, (c.n + 1) // 2,
        sha256(CASE WHEN c.idx % 2 = 1 THEN s.h || c.cur ELSE c.cur || coalesce(s.h, '') END), c.proof || coalesce(s.h, '')
    FROM ascend c LEFT JOIN high s ON s.lv = c.lv AND s.idx = xor(c.idx, 1) WHERE c.n > 1
)
SELECT l.doc_id, l.leaf, t.h AS subroot, r.h AS root, sha256(a.proof) AS proof_sha256, a.cur AS folded_root, a.cur = r.h AS verified
FROM leaves l JOIN tops t ON t.g = l.g JOIN ascend a ON a.rid = l.rid AND a.n = 1, (SELECT h FROM high WHERE n = 1) r
"""

PREFIX_TRIE = rf"""
WITH t AS (
    SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
        len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS w, turn
    FROM conversations WHERE conv_id IS NOT NULL
), p AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) AS pos FROM t
), c AS (
    SELECT conv_id, {_crc32('conv_id::VARCHAR')} % 4 AS k FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
    SELECT c.conv_id, p.pos, p.h, p.w FROM c JOIN p ON p.conv_id = c.conv_id - c.conv_id % 20 AND p.pos <= c.k
    UNION ALL
    SELECT c.conv_id, p.pos, p.h, p.w FROM c JOIN p ON p.conv_id = c.conv_id AND p.pos > c.k
), m AS (
    SELECT conv_id, row_number() OVER o AS d, string_agg(h, '') OVER o AS path, w FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY pos)
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM c
), n AS (
    SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM m GROUP BY path, d
), e AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends
    FROM (SELECT conv_id, arg_max(path, d) AS path FROM m GROUP BY conv_id) GROUP BY path
), kids AS (
    SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1
), up AS (
    SELECT left(n.path, 64 * a.a) AS path, kids.path IS NULL AS leaf, (n.n_convs - 1) * n.w AS saved
    FROM n LEFT JOIN kids USING (path), LATERAL (SELECT unnest(range(0, n.d + 1)) AS a) a
), sums AS (
    SELECT path, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved) AS saved FROM up GROUP BY path
)
SELECT n.conv_id, n.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0)::BIGINT AS n_children,
    sums.n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM n JOIN sums USING (path) LEFT JOIN kids USING (path) LEFT JOIN e USING (path)
LEFT JOIN n parent ON n.d > 0 AND parent.path = left(n.path, greatest(64 * (n.d - 1), 0))
"""

BODIES = {
    "op2_ngram_join": NGRAM_JOIN, "op6_line_dedup": LINE_DEDUP, "op11_merkle_manifest": MERKLE_MANIFEST, "op12_prefix_trie": PREFIX_TRIE,
}
