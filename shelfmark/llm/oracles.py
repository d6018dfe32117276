"""SQL forms of the queries that SQL can express, for an engine with list functions."""

COLLOCATIONS = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (SELECT c.lang, c.k, c.phrase, a, w, j, l.f AS l, r.f AS r, n, 1000::HUGEINT * a * n // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:j], ' ') JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1:], ' ') JOIN sizes s ON s.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS a FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM candidates)) GROUP BY ALL),
ranked AS (SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, o.a DESC, o.phrase) AS rank
    FROM lowest o LEFT JOIN longer g ON g.lang = o.lang AND g.phrase = o.phrase WHERE g.a IS NULL OR 100 * g.a < 100 * o.a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

PREFIX_TRIE = """
WITH turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
steps AS (SELECT c, [4294967295] || flatten(list_transform(range(1, length(c::VARCHAR) + 1), lambda i: [ascii(substr(c::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS s FROM (SELECT DISTINCT c FROM turns)),
heads AS (SELECT c, c - c % 100 AS base, xor(4294967295, list_reduce(s, lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) % 6 AS h FROM steps),
built AS (SELECT heads.c, i AS o, role, text FROM heads JOIN turns ON turns.c = base AND i <= h UNION ALL SELECT heads.c, 6 + i, role, text FROM heads JOIN turns ON turns.c = heads.c AND i > h),
prefixes AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY o) AS d, length(text) AS chars,
        string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY o) AS k FROM built),
paths AS (SELECT *, max(d) OVER (PARTITION BY c) AS len FROM (SELECT * FROM prefixes UNION ALL SELECT c, 0, 0, '' FROM heads)),
nodes AS (SELECT k, d, min(c) AS conv_id, count(*) AS n, (count(*) - 1) * max(chars) AS w, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '')) AS ends FROM paths GROUP BY k, d),
children AS (SELECT left(k, 64 * (d - 1)) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sums AS (SELECT left(u.k, 64 * e) AS k, count(*) FILTER (leaf) AS leaves, sum(w) AS saved
    FROM (SELECT nodes.*, children.n IS NULL AS leaf, unnest(range(0, d + 1)) AS e FROM nodes LEFT JOIN children ON children.k = nodes.k) u GROUP BY 1)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n AS n_convs, coalesce(children.n, 0) AS n_children,
    leaves AS n_leaves, saved::BIGINT AS saved_tokens, nodes.ends AS ends_sha256
FROM nodes LEFT JOIN children ON children.k = nodes.k JOIN sums ON sums.k = nodes.k LEFT JOIN nodes up ON nodes.d > 0 AND up.k = left(nodes.k, 64 * (nodes.d - 1))
"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x, row_number() OVER () AS row FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, least(len(q.x), len(c.x)) + 1), lambda i: q.x[i] * c.x[i]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.row <> c.row)
SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) <= 20
"""
