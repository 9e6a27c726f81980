"""What the corpus queries return, in DuckDB SQL, for those that SQL can express.

Language, toxicity and quality models, packing, surrogates and templates are beyond SQL; their queries are tested
against brute force, an exact round trip or held-out labels.
"""

from __future__ import annotations

_BLANK = r"[\x20\x09-\x0D]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce({_LOWER}, ''), '{_BLANK}'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS c
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (n + m - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""


def _base32(digits: str) -> str:
    parts = []
    for i in range(0, 40, 5):
        value = f"('0x' || substr({digits}, {i + 1}, 5))::BIGINT"
        parts += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({value} >> {k}) & 31) + 1, 1)" for k in (15, 10, 5, 0)]
    return " || ".join(parts)


OP6 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS target FROM p GROUP BY html),
d AS (SELECT page_id, html, target, sha1(html) AS hex FROM p JOIN g USING (html))
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {_base32("hex")} AS payload_digest,
  CASE WHEN page_id < target THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < target THEN target END AS refers_to
FROM d
"""

# A turn replies to the first turn with the words of the one before it.
OP9 = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(text, '') AS text, trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')) AS words
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), origin AS (SELECT conv_id, words, min(turn) AS first FROM t WHERE words <> '' GROUP BY conv_id, words),
links AS (
  SELECT t.conv_id, t.turn, o.first AS parent FROM t JOIN t p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1
  JOIN origin o ON o.conv_id = p.conv_id AND o.words = p.words
), chain(conv_id, turn, top, depth) AS (
  SELECT conv_id, turn, turn, 0 FROM t
  UNION ALL SELECT c.conv_id, c.turn, l.parent, c.depth + 1 FROM chain c JOIN links l ON l.conv_id = c.conv_id AND l.turn = c.top
), tops AS (SELECT conv_id, turn, max(depth) AS depth, arg_max(top, depth) AS root FROM chain GROUP BY conv_id, turn)
SELECT conv_id || '.' || root AS conversation_id, depth::BIGINT AS depth, conv_id || '.' || turn AS message_id,
  CASE WHEN parent IS NOT NULL THEN conv_id || '.' || parent END AS parent_id, trim(text, E' \t\n') AS text
FROM t JOIN tops USING (conv_id, turn) LEFT JOIN links USING (conv_id, turn)
"""

_HOST = "regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)"

OP10 = f"""
WITH p AS (
  SELECT page_id, url, rtrim({_HOST}, '.') AS host, regexp_extract(url, '^[^:]*://[^/?#]*([^#]*)', 1) AS rest,
    regexp_extract(url, '^[^:]*://[^/?#]*(/[^/?#]*/)', 1) AS directory,
    1704067200 + page_id * 7919 % 365 * 86400 + page_id * 104729 % 86400 AS time
  FROM pages
), named AS (
  SELECT DISTINCT unnest([host, regexp_replace(host, '^[^.]*[.]', ''), host || directory]) AS pattern FROM p
), hashed AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 7))::BIGINT AS h FROM named WHERE pattern <> ''),
listed AS (
  SELECT 'ads' AS list, * FROM hashed WHERE h % 3 = 0 UNION ALL SELECT 'spam', * FROM hashed WHERE h % 4 = 1
  UNION ALL SELECT 'allow', * FROM hashed WHERE h % 10 = 7
), active AS (
  SELECT list, pattern, 1704067200 + h % 200 * 86400 AS since, 1704067200 + (h % 200 + 60) * 86400 AS until FROM listed
  UNION ALL SELECT list, pattern, 1704067200 + (h % 200 + 120) * 86400, NULL FROM listed WHERE h % 2 = 0
), keys AS (
  SELECT page_id, time, unnest(list_distinct(
    list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))
    || list_transform(range(1, greatest(len(string_split(regexp_extract(rest, '^([^?]*)', 1), '/')) - 1, 1) + 1),
      lambda i: host || array_to_string(string_split(regexp_extract(rest, '^([^?]*)', 1), '/')[1:i], '/') || '/')
    || [host || rest])) AS pattern
  FROM p WHERE host <> ''
), met AS (
  SELECT page_id, list(DISTINCT list ORDER BY list) AS lists, count(*) AS n, bool_or(list = 'allow') AS allowed
  FROM keys JOIN active USING (pattern) WHERE since <= time AND (until IS NULL OR time < until) GROUP BY page_id
)
SELECT page_id, url, host, time, CASE WHEN allowed THEN 'allowed' WHEN lists IS NOT NULL THEN 'blocked' ELSE 'unlisted' END AS verdict,
  coalesce(array_to_string(lists, ','), '') AS lists, coalesce(n, 0)::BIGINT AS n_entries
FROM p LEFT JOIN met USING (page_id)
"""

# The largest id of equal scores comes last; vectors with a null or non-finite component are left out.
OP11 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    coalesce(list_sum(list_transform(range(1, least(len(q.w), len(c.w)) + 1), lambda i: q.w[i] * c.w[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# The checksum's table follows from its polynomial: eight steps for each byte.
_CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS t"


def _crc32(text: str) -> str:
    """Of a text without code points beyond U+00FF, with the table in scope as ``t``."""
    letters = f"list_transform(string_split({text}, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [192 + (ord(x) >> 6), 128 + (ord(x) & 63)] END)"
    steps = f"list_reduce([4294967295] || flatten({letters})::BIGINT[], lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


OP12 = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), leaves AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf, CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf(_LOWER)} END AS tampered
  FROM documents, crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves
), low AS (
  SELECT 0 AS level, source, n, i, leaf AS node FROM placed
  UNION ALL
  SELECT level + 1, source, (n + 15) // 16, i // 16, sha256(string_agg(node, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY level, source, n, i // 16
), subroots AS (SELECT source, level AS depth, node AS subroot FROM low WHERE n = 1),
tops AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS trees FROM subroots),
high AS (
  SELECT 0 AS level, trees AS n, place AS i, subroot AS node FROM tops
  UNION ALL
  SELECT level + 1, (n + 15) // 16, i // 16, sha256(string_agg(node, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, n, i // 16
), root AS (SELECT node AS root, level AS height FROM high WHERE n = 1),
beside AS (
  SELECT p.doc_id, p.leaf, p.source, p.i, l.level, string_agg(l.node, '' ORDER BY l.i) FILTER (l.i < p.i // (16 ** l.level)::BIGINT) AS before,
    string_agg(l.node, '' ORDER BY l.i) FILTER (l.i > p.i // (16 ** l.level)::BIGINT) AS after
  FROM placed p JOIN low l ON l.source IS NOT DISTINCT FROM p.source AND l.n > 1 AND l.i // 16 = p.i // (16 ** (l.level + 1))::BIGINT GROUP BY ALL
  UNION ALL
  SELECT p.doc_id, p.leaf, p.source, p.i, t.depth + h.level, string_agg(h.node, '' ORDER BY h.i) FILTER (h.i < t.place // (16 ** h.level)::BIGINT),
    string_agg(h.node, '' ORDER BY h.i) FILTER (h.i > t.place // (16 ** h.level)::BIGINT)
  FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source JOIN high h ON h.n > 1 AND h.i // 16 = t.place // (16 ** (h.level + 1))::BIGINT GROUP BY ALL
), paths AS (
  SELECT source, i, string_agg(coalesce(before, '') || coalesce(after, ''), '' ORDER BY level) AS proof FROM beside GROUP BY source, i
), folded AS (
  SELECT source, i, 0 AS level, coalesce(tampered, leaf) AS node FROM placed
  UNION ALL
  SELECT f.source, f.i, f.level + 1, sha256(coalesce(b.before, '') || f.node || coalesce(b.after, ''))
  FROM folded f JOIN beside b ON b.source IS NOT DISTINCT FROM f.source AND b.i = f.i AND b.level = f.level
), ends AS (SELECT source, i, arg_max(node, level) AS folded_root FROM folded GROUP BY source, i)
SELECT p.doc_id, p.leaf, t.subroot, root.root, sha256(coalesce(q.proof, '')) AS proof_sha256, e.folded_root, e.folded_root = root.root AS verified
FROM root, placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source JOIN ends e ON e.source IS NOT DISTINCT FROM p.source AND e.i = p.i
LEFT JOIN paths q ON q.source IS NOT DISTINCT FROM p.source AND q.i = p.i
"""

OP13 = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_crc32("(doc_id || ':' || run)")} AS h FROM counted, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), v AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, v.word, v.n FROM cut a JOIN v ON v.word = a.rest
  UNION SELECT v.word, a.word, a.n FROM cut a JOIN v ON v.word = a.rest
), best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
), ends AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

ORACLES = {
    "op4_hyperminhash_dedup": OP4,
    "op6_warc_chunks": OP6,
    "op9_quotation_linking": OP9,
    "op10_temporal_url_lists": OP10,
    "op11_term_at_a_time_top_k": OP11,
    "op12_merkle_manifest": OP12,
    "op13_spelling_variants": OP13,
}
