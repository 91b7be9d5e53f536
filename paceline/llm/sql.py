"""The SQL that registered queries of the operators are checked against, where SQL can say what they return."""

from __future__ import annotations

from paceline.llm.licenses import RULES, SENTENCES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _values(rows) -> str:
    quoted = lambda v: str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(quoted, row)) + ")" for row in rows)


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), m AS (
  SELECT *, role = 'assistant' AS loss,
    CASE WHEN regexp_matches(role || chr(10) || text, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE=|<</ROLE>>|[\\<>\[]\\')
      THEN regexp_replace(text, '([\\<>\[])', '\1\\', 'g') ELSE text END AS shown
  FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (loss), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (loss), '')) AS loss_sha256,
  sum(length(shown) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 18 + length(role) END)::BIGINT
    AS formatted_chars
FROM m GROUP BY conv_id
"""

LICENSES = rf"""
WITH sentences AS (
  SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(coalesce(text, '')), '[.;:!?](\s|$)', chr(10) || '\1', 'g'), '[\r\n]+')) AS s,
    generate_subscripts(string_split_regex(regexp_replace(lower(coalesce(text, '')), '[.;:!?](\s|$)', chr(10) || '\1', 'g'), '[\r\n]+'), 1) AS pos
  FROM documents
), known(id, sentence) AS (VALUES {_values(SENTENCES.items())}),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY pos) AS ids, ' ' || string_agg(id, '  ' ORDER BY pos) || ' ' AS line
  FROM sentences JOIN known ON trim(regexp_replace(regexp_replace(s, '[^a-z0-9.-]+', ' ', 'g'), '\.+( |$)', '\1', 'g')) = sentence
  GROUP BY doc_id
), rules(pos, name, pattern) AS (VALUES {_values((i, name, "%" + "%".join(f" {x} " for x in ids) + "%") for i, (name, ids) in enumerate(RULES))}),
named AS (
  SELECT doc_id, string_agg(name, ',' ORDER BY pos) AS names
  FROM (SELECT doc_id, name, min(pos) AS pos FROM found JOIN rules ON line LIKE pattern GROUP BY doc_id, name) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(names, '') AS licenses
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id
"""

_REACH = """
reach AS (
  SELECT id, id AS other FROM nodes
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), roots AS (SELECT id, min(other) AS root FROM reach GROUP BY id)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w
), nodes AS (SELECT id, len(s) AS n FROM sets),
items AS (SELECT id, unnest(s) AS x FROM sets),
common AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.id <> b.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), {_REACH}
SELECT n.id AS doc_id, n.n::BIGINT AS n_shingles, root AS component_id, root = n.id AS kept FROM nodes n JOIN roots r ON r.id = n.id
"""

URLS = f"""
WITH r(host, path, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
)
SELECT page_id, q.host, q.path, r.host || r.path AS rule, coalesce(action, 'allow') AS verdict
FROM q LEFT JOIN r ON (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) = 1
"""

GRID_JOIN = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id
  WHERE list_cosine_similarity(p.e, q.e) >= 0.93
), nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH}
SELECT r.id AS vec_id, (SELECT count(*) FROM links l WHERE l.a = r.id)::BIGINT AS n_links, root AS component_id, root = r.id AS kept
FROM roots r
"""

# Unsigned crc32 of UTF-8 text, by a table of the 256 remainders.
_CRC = """
crc(t) AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i))
)"""


def _crc32(hexed: str, table: str = "t") -> str:
    """SQL for the crc32 of the bytes whose hex digits ``hexed`` is."""
    byte = f"(16 * (strpos('0123456789ABCDEF', substr({hexed}, 2 * i + 1, 1)) - 1) + strpos('0123456789ABCDEF', substr({hexed}, 2 * i + 2, 1)) - 1)"
    return (
        f"xor(4294967295, list_reduce(list_transform(range(0, length({hexed}) // 2), lambda i: {byte}::BIGINT),"
        f" lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"
    )


def _levels(name: str, base: str) -> str:
    """All nodes of trees eight wide over ``base`` (tree, pos, hash, n)."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, pos, hash, n FROM {base}
  UNION ALL SELECT tree, any_value(level) + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), any_value((n + 7) // 8)
  FROM {name} WHERE n > 1 GROUP BY tree, pos // 8
)"""


def _sides(name: str, nodes: str) -> str:
    """Per node the digests of its run before and after it."""
    inside = "PARTITION BY tree, level, pos // 8 ORDER BY pos ROWS BETWEEN"
    return f"""
{name} AS (
  SELECT tree, level, pos, coalesce(string_agg(hash, '') OVER ({inside} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(hash, '') OVER ({inside} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {nodes} WHERE n > 1
)"""


def _leaf(text: str) -> str:
    put = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    return f"sha256({' || '.join(map(put, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


MERKLE = f"""
WITH RECURSIVE {_CRC},
leaves AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("hex(encode(doc_id::VARCHAR))")} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered
  FROM documents, crc
), placed AS (
  SELECT doc_id, leaf, tampered, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), base AS (SELECT tree, pos, leaf AS hash, n FROM placed), {_levels("nodes", "base")},
subroots AS (SELECT tree, hash FROM nodes WHERE n = 1),
above AS (SELECT -1 AS tree, tree AS pos, hash, count(*) OVER () AS n FROM subroots), {_levels("top", "above")},
{_sides("sides", "nodes")}, {_sides("top_sides", "top")},
folds AS (
  SELECT doc_id, pos AS nth, tree, 0 AS level, pos, '' AS proof, coalesce(tampered, leaf) AS h FROM placed
  UNION ALL SELECT doc_id, nth, tree, s.level + 1, pos // 8, proof || before || after, sha256(before || h || after)
  FROM folds f JOIN sides s USING (tree, level, pos)
), inner_folds AS (SELECT * FROM folds QUALIFY row_number() OVER (PARTITION BY tree, nth ORDER BY level DESC) = 1),
top_folds AS (
  SELECT tree, nth, 0 AS level, tree AS pos, proof, h FROM inner_folds
  UNION ALL SELECT f.tree, nth, s.level + 1, f.pos // 8, proof || before || after, sha256(before || h || after)
  FROM top_folds f JOIN top_sides s ON s.level = f.level AND s.pos = f.pos
), proofs AS (SELECT * FROM top_folds QUALIFY row_number() OVER (PARTITION BY tree, nth ORDER BY level DESC) = 1),
root AS (SELECT hash AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, s.hash AS subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM placed p JOIN proofs q ON q.tree = p.tree AND q.nth = p.pos JOIN subroots s ON s.tree = p.tree CROSS JOIN root
"""

SPELLING = f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL
), hexed AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (SELECT run, n, {_crc32("x")} AS h FROM hexed, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word,
    sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), shorter AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
), near AS (
  SELECT word AS a, rest AS b FROM shorter WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM shorter WHERE rest IN (SELECT word FROM words)
  UNION SELECT p.word, q.word FROM shorter p JOIN shorter q ON p.i = q.i AND p.rest = q.rest AND p.word <> q.word
), told AS (
  SELECT a, count(*) AS n_near, max(w.n) AS most, arg_min(b, (-w.n, b)) AS best FROM near JOIN words w ON w.word = b GROUP BY a
), formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 2 * n THEN best END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
  FROM words LEFT JOIN told ON a = word
), chain AS (
  SELECT word, word AS root, form AS onward FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.onward
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM chain WHERE onward IS NULL) USING (word)
"""

ORACLE = {
    "op2_top_k": TOP_K,
    "op3_chat_format": CHAT,
    "op5_license_scan": LICENSES,
    "op6_near_duplicates": NEAR_DUPLICATES,
    "op7_url_filter": URLS,
    "op10_grid_join": GRID_JOIN,
    "op11_spelling": SPELLING,
    "op13_merkle": MERKLE,
}
