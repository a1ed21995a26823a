"""DuckDB SQL of the operators whose results SQL can express, written on its own."""

OP13 = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same,
         CAST(list_dot_product(a.v, o.v) AS BIGINT) AS score
  FROM r a JOIN r o ON a.vec_id <> o.vec_id
  WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
            AS INTEGER) AS "rank",
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY "rank" <= 3
"""

def _field(x):
    return f"coalesce(octet_length(encode(CAST({x} AS VARCHAR))) || ':' || CAST({x} AS VARCHAR), '-')"


def _leaf(n_chars):
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# CRC-32 bit by bit over the decimal digits
CRC = """xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT],
              list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
                             lambda i: ord(CAST(doc_id AS VARCHAR)[i])::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
                           lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""

OP11 = f"""
WITH RECURSIVE
d AS (
  SELECT doc_id, lang IS NOT NULL AS named, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN {CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claimed
  FROM documents),
r AS (
  SELECT *, row_number() OVER (ORDER BY named, lang, doc_id NULLS FIRST, leaf) AS id,
         dense_rank() OVER (ORDER BY named, lang) AS tree,
         row_number() OVER (PARTITION BY named, lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY named, lang) AS size
  FROM d),
up AS (
  SELECT tree, 0 AS lvl, pos AS idx, leaf AS h, size FROM r
  UNION ALL
  SELECT tree, any_value(lvl) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), any_value(size + 1) // 2
  FROM up WHERE size > 1 GROUP BY tree, idx // 2),
top AS (
  SELECT 0 AS lvl, tree - 1 AS idx, h, count(*) OVER () AS size FROM up WHERE size = 1
  UNION ALL
  SELECT any_value(lvl) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), any_value(size + 1) // 2
  FROM top WHERE size > 1 GROUP BY idx // 2),
way AS (
  SELECT r.id, u.lvl AS step, r.pos >> u.lvl AS at, s.h
  FROM r JOIN up u ON u.tree = r.tree AND u.idx = r.pos >> u.lvl AND u.size > 1
  LEFT JOIN up s ON s.tree = r.tree AND s.lvl = u.lvl AND s.idx = xor(u.idx, 1)
  UNION ALL
  SELECT r.id, 1000 + u.lvl, (r.tree - 1) >> u.lvl, s.h
  FROM r JOIN top u ON u.idx = (r.tree - 1) >> u.lvl AND u.size > 1
  LEFT JOIN top s ON s.lvl = u.lvl AND s.idx = xor(u.idx, 1)),
steps AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step) AS k FROM way),
fold AS (
  SELECT id, 0::BIGINT AS k, claimed AS h FROM r
  UNION ALL
  SELECT f.id, s.k, sha256(CASE WHEN s.at % 2 = 1 THEN coalesce(s.h, '') || f.h ELSE f.h || coalesce(s.h, '') END)
  FROM fold f JOIN steps s ON s.id = f.id AND s.k = f.k + 1),
proof AS (SELECT id, sha256(coalesce(string_agg(h, '' ORDER BY k), '')) AS proof_sha256 FROM steps GROUP BY id),
root AS (SELECT h AS root FROM top WHERE size = 1)
SELECT r.doc_id, r.leaf, u.h AS subroot, root.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       f.h AS folded_root, f.h = root.root AS verified
FROM r CROSS JOIN root
JOIN up u ON u.tree = r.tree AND u.size = 1
LEFT JOIN proof p ON p.id = r.id
JOIN (SELECT id, arg_max(h, k) AS h FROM fold GROUP BY id) f ON f.id = r.id
"""

# base32 of a hexadecimal digest: four letters for five digits
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LETTERS = " || ".join(f"'{_BASE32}'[((v >> {s}) & 31) + 1]" for s in (15, 10, 5, 0))

OP12 = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (
  SELECT *, max(page_id) OVER (PARTITION BY body) AS lead FROM p)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: list_reduce(
         list_transform([CAST('0x' || substr(hex, i * 5 + 1, 5) AS INTEGER)], lambda v: {_LETTERS}),
         lambda a, b: a || b)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM lead THEN lead END AS refers_to
FROM g
"""

_WORDS = r"[^\x20\x09-\x0D]+"

OP8 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws FROM documents),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)),
repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(8)) AS k FROM repeated) GROUP BY rid),
lines AS (
  SELECT rid, doc_id, source, text, trim(x, ' ') AS x
  FROM (SELECT rid, doc_id, source, text, unnest(string_split(regexp_replace(regexp_replace(lower(t),
          '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'), chr(10))) AS x FROM d)
  WHERE trim(x, ' ') <> ''),
frequent AS (
  SELECT source, x, min(doc_id) AS first FROM lines GROUP BY source, x HAVING count(DISTINCT coalesce(text, '')) >= 20),
removed AS (
  SELECT l.rid, sum(len(string_split(l.x, ' ')))::BIGINT AS n
  FROM lines l JOIN frequent f ON l.x = f.x AND l.source IS NOT DISTINCT FROM f.source
  WHERE l.doc_id IS DISTINCT FROM f.first GROUP BY l.rid),
base AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(r.n, 0)::BIGINT AS n_removed
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d) d
  LEFT JOIN covered c USING (rid) LEFT JOIN removed r USING (rid))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT base_failed AND NOT (n_removed > 0 AND n_words - n_removed < 0.5 * n_words) AS kept
FROM base
"""

SQL = {
    "op8_quality_rules": OP8,
    "op11_merkle_manifest": OP11,
    "op12_warc_zip": OP12,
    "op13_hard_negatives": OP13,
}
