"""SQL statements of the document operators that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH base AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT *, regexp_extract_all(text, '{_WORD}') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM base
), windows AS (
  SELECT row, i, [words[i], words[i + 1], words[i + 2]] AS w
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM cut)
), twice AS (
  SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, w) > 1
), covered AS (
  SELECT row, count(DISTINCT i + k) AS n FROM twice, range(3) AS r(k) GROUP BY row
), features AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines,
         (length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')))::BIGINT AS n_upper
  FROM cut LEFT JOIN covered c USING (row)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words
            OR word_chars > 20 * n_words OR 100 * n_upper > 50 * word_chars) AS kept
FROM features
"""

OP4 = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS total, 3 * sum(size)::BIGINT AS cap,
         (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, sum(total) OVER () - coalesce(sum(cap) OVER before, 0) AS words,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights
  FROM totals
  WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  -- The first source, by cap per weight, that does not reach its cap sets the level of all others.
  SELECT words::DOUBLE AS words, weights::DOUBLE AS weights, cap::DOUBLE / weight AS ratio FROM filled
  WHERE cap::DOUBLE >= weight * words::DOUBLE / weights::DOUBLE ORDER BY cap / weight, source LIMIT 1
), targets AS (
  SELECT source, total, CASE WHEN cap::DOUBLE / weight < ratio THEN cap::DOUBLE
                             ELSE weight * words / weights END AS target
  FROM totals, level
), needs AS (
  SELECT *, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END::BIGINT AS whole FROM targets
), rests AS (
  SELECT *, floor(target + 0.5)::BIGINT - whole * total AS rest FROM needs
), places AS (
  SELECT source, place, size, count(*) AS n,
         sum(size * count(*)) OVER (PARTITION BY source ORDER BY place, size) - size * count(*) AS before
  FROM sized GROUP BY source, place, size
)
SELECT s.doc_id, s.size, r.total AS source_size, r.target,
       (r.whole * s.size + greatest(0, least(s.size, floor((r.rest - p.before) / p.n))))::BIGINT AS taken
FROM sized s
JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
JOIN places p ON p.source IS NOT DISTINCT FROM s.source AND p.place = s.place AND p.size = s.size
"""


OP11 = rf"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM cut WHERE len(w) >= 35)
), twice AS (
  SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT r, list(DISTINCT i + k) AS places FROM windows SEMI JOIN twice USING (h), range(35) AS t(k) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN w
                                   ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(places, i)), lambda i: w[i]) END, ' '))
       AS kept_sha256
FROM cut LEFT JOIN gone USING (r)
"""

OP12 = """
WITH clean AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM clean a JOIN clean b ON a.r <> b.r WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT r, anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.r, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.r = p.r AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""

OP13 = r"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
         sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text)::VARCHAR || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered
  FROM (SELECT *, concat(coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id, '-'), coalesce(strlen(source)::VARCHAR || ':' || source, '-'),
                         coalesce(strlen(lang)::VARCHAR || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars, '-')) AS head
        FROM documents)
), checksums AS (
  -- CRC-32 bit by bit: a byte enters with the first of its eight steps.
  SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
           lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), placed AS (
  SELECT l.doc_id, l.tree, l.leaf, CASE WHEN c.crc % 3 = 0 THEN l.lowered ELSE l.leaf END AS now,
         row_number() OVER (PARTITION BY tree ORDER BY l.doc_id NULLS FIRST, leaf) - 1 AS i, row_number() OVER () AS r
  FROM leaves l LEFT JOIN checksums c ON c.doc_id = l.doc_id
), up AS (
  SELECT tree, 0 AS level, i AS idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 7) // 8
  FROM up WHERE n > 1 GROUP BY tree, level, idx // 8
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS i FROM up WHERE n = 1
), upper AS (
  SELECT 0 AS level, i AS idx, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 7) // 8 FROM upper WHERE n > 1 GROUP BY level, idx // 8
), steps AS (
  SELECT r, 0 AS part, u.level, coalesce(string_agg(u.digest, '' ORDER BY u.idx) FILTER (u.idx < p.i // (8 ** u.level)::BIGINT), '') AS before,
         coalesce(string_agg(u.digest, '' ORDER BY u.idx) FILTER (u.idx > p.i // (8 ** u.level)::BIGINT), '') AS after
  FROM placed p JOIN up u ON u.tree = p.tree AND u.n > 1 AND u.idx // 8 = p.i // (8 ** (u.level + 1))::BIGINT GROUP BY r, u.level
  UNION ALL
  SELECT r, 1, u.level, coalesce(string_agg(u.digest, '' ORDER BY u.idx) FILTER (u.idx < s.i // (8 ** u.level)::BIGINT), ''),
         coalesce(string_agg(u.digest, '' ORDER BY u.idx) FILTER (u.idx > s.i // (8 ** u.level)::BIGINT), '')
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN upper u ON u.n > 1 AND u.idx // 8 = s.i // (8 ** (u.level + 1))::BIGINT GROUP BY r, u.level
), proofs AS (
  SELECT r, sha256(string_agg(before || after, '' ORDER BY part, level)) AS proof, list(before || '|' || after ORDER BY part, level) AS path
  FROM steps GROUP BY r
), folded AS (
  SELECT p.doc_id, p.leaf, s.digest AS subroot, (SELECT digest FROM upper WHERE n = 1) AS root, coalesce(f.proof, sha256('')) AS proof_sha256,
         coalesce(list_reduce(list_prepend(p.now, f.path), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))), p.now) AS folded_root
  FROM placed p JOIN subroots s ON s.tree = p.tree LEFT JOIN proofs f ON f.r = p.r
)
SELECT *, folded_root = root AS verified FROM folded
"""


def statements() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op4_mixing": OP4, "op11_repeats": OP11, "op12_negatives": OP12, "op13_merkle": OP13}
