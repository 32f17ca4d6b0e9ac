"""SQL of the corpus queries that SQL can express, for an independent engine."""

QUALITY_RULES = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), placed AS (
  SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM texts
), windows AS (
  SELECT doc_id, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3,
         lead(w, 4) OVER o AS w4
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), again AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2, w3, w4) AS n
  FROM windows WHERE w4 IS NOT NULL
), repeats AS (
  SELECT doc_id, sum(least(5, coalesce(next - i, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next
        FROM again WHERE n > 1) GROUP BY doc_id
), dup AS (
  SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), measures AS (
  SELECT t.doc_id, t.t, len(words)::BIGINT AS n_words,
         length(regexp_replace(t.t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t.t) - length(translate(t.t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(d.n_dup_lines, 0) AS n_dup_lines,
         coalesce(r.n_repeat_words, 0) AS n_repeat_words,
         len(string_split(t.t, chr(10))) AS n_lines,
         length(regexp_replace(t.t, '\P{Lu}+', '', 'g')) AS n_capitals,
         length(regexp_replace(t.t, '\P{L}+', '', 'g')) AS n_letters,
         len(regexp_extract_all(t.t, '!!')) AS n_exclamations
  FROM texts t LEFT JOIN dup d ON t.doc_id = d.doc_id LEFT JOIN repeats r ON t.doc_id = r.doc_id
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words * 2
            OR (n_dup_lines >= 3 AND n_dup_lines * 10 > n_lines * 3)
            OR n_capitals * 2 > n_letters OR n_exclamations * 5 > n_words
            OR word_chars < n_words * 2 OR word_chars > n_words * 25
            OR n_letters * 2 < word_chars) AS kept
FROM judged
"""

#: Patterns as the contract gives them, and the three further kinds; ends by running sums of lengths.
SECRET_SCANS = r"""
WITH kinds(rank, kind, pattern, part, least) AS (VALUES
  (1, 'assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (2, 'access', 'AKIA[A-Z0-9]+', 0, 20),
  (3, 'hex', '[0-9a-f]+', 0, 24),
  (4, 'private_key', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 1),
  (5, 'web_token', 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', 0, 1),
  (6, 'prefixed_token', '(?:ghp|gho|ghs|xoxb|xoxp|sk_live)[_-][A-Za-z0-9-]{16,}', 0, 1)
), texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents
), cut AS (
  SELECT row, rank, kind, least, regexp_extract_all(t, pattern, 0) AS found,
         CASE part WHEN 2 THEN regexp_extract_all(t, pattern, 2)
                   ELSE regexp_extract_all(t, pattern, 0) END AS judged,
         string_split_regex(t, pattern) AS gaps
  FROM texts, kinds
), matches AS (
  SELECT row, rank, kind, least, unnest(range(1, len(found) + 1)) AS i, unnest(found) AS m,
         unnest(judged) AS j, unnest(gaps[1:len(found)]) AS gap
  FROM cut WHERE len(found) > 0
), placed AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY row, rank ORDER BY i) AS past
  FROM matches
), spans AS (
  SELECT row, rank, kind, past - length(m) AS start,
         concat_ws(':', kind, (past - length(m))::BIGINT, past::BIGINT) AS span
  FROM placed WHERE length(j) >= least
), listed AS (
  SELECT row, count(*) FILTER (rank = 1) AS n_assign, count(*) FILTER (rank = 2) AS n_access,
         count(*) FILTER (rank = 3) AS n_hex,
         string_agg(span, ',' ORDER BY start, rank) FILTER (rank <= 3) AS base,
         string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row)
"""

#: All pairs of the given vectors, and whatever they reach.
EMBEDDING_DEDUP = r"""
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), sound AS (
  SELECT row, vec_id, e FROM vectors
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.row, a.vec_id, b.vec_id AS other FROM sound a JOIN sound b
  ON a.row <> b.row AND len(a.e) = len(b.e)
     AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 END
), reached AS (
  SELECT vec_id, vec_id AS other FROM vectors
  UNION
  SELECT r.vec_id, l.other FROM reached r JOIN links l ON l.vec_id = r.other
), components AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), degrees AS (
  SELECT row, count(*) AS n_links FROM links GROUP BY row
)
SELECT v.vec_id, coalesce(d.n_links, 0) AS n_links, c.component_id,
       v.vec_id = c.component_id AS kept
FROM vectors v JOIN components c ON c.vec_id = v.vec_id LEFT JOIN degrees d ON d.row = v.row
"""

SUBSTRING_DEDUP = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), blocks AS (
  SELECT row, low, words[low:low + 290] AS chunk, len(words) AS n
  FROM (SELECT row, words, unnest(range(1, len(words) + 1, 256)) AS low FROM texts)
), windows AS (
  SELECT row, low + k AS i, md5(array_to_string(chunk[k + 1:k + 35], ' ')) AS content
  FROM (SELECT *, unnest(range(0, least(256, n - 34 - low + 1))) AS k FROM blocks)
), repeated AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY content) AS n FROM windows)
  WHERE n > 1
), placed AS (
  SELECT row, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS j FROM texts
), judged AS (
  SELECT p.row, w, j, coalesce(max(r.i) OVER (PARTITION BY p.row ORDER BY j) > j - 35, false) AS gone
  FROM placed p LEFT JOIN repeated r ON r.row = p.row AND r.i = p.j
), kept AS (
  SELECT row, count(*) FILTER (gone) AS n_removed,
         string_agg(w, ' ' ORDER BY j) FILTER (NOT gone) AS kept
  FROM judged GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row)
"""

#: Bytes as pairs of hexadecimal digits.
SUFFIX_ARRAY_DEDUP = r"""
WITH texts AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS row, doc_id,
         hex(encode(coalesce(text, ''))) AS digits
  FROM documents
), blocks AS (
  SELECT row, low, substr(digits, 2 * low + 1, 1222) AS chunk, length(digits) // 2 AS n
  FROM (SELECT row, digits, unnest(range(0, length(digits) // 2, 512)) AS low FROM texts)
), windows AS (
  SELECT row, low + k AS i, md5(substr(chunk, 2 * k + 1, 200)) AS content
  FROM (SELECT *, unnest(range(0, least(512, n - 100 - low + 1))) AS k FROM blocks)
), later AS (
  SELECT row, i FROM (
    SELECT row, i, row_number() OVER (PARTITION BY content ORDER BY row, i) AS nth FROM windows)
  WHERE nth > 1
), bytes AS (
  SELECT row, low + k AS j, substr(chunk, 2 * k + 1, 2) AS byte
  FROM (SELECT *, unnest(range(0, least(512, n - low))) AS k FROM blocks)
), covered AS (
  SELECT b.row, j, byte,
         coalesce(max(l.i) OVER (PARTITION BY b.row ORDER BY j) > j - 100, false) AS gone
  FROM bytes b LEFT JOIN later l ON l.row = b.row AND l.i = b.j
), judged AS (
  SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY row ORDER BY j) AS starts
  FROM covered
), kept AS (
  SELECT row, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans,
         string_agg(byte, '' ORDER BY j) FILTER (NOT gone) AS kept
  FROM judged GROUP BY row
)
SELECT doc_id, length(digits) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN kept USING (row)
"""
