"""DuckDB twins of the queries that SQL can express, over the same tables."""

# Words of a text: runs of all but the six ASCII blanks.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5 = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
         octet_length(encode(coalesce(text, ''))) AS n FROM documents),
blocks AS (  -- 500 starts each, so that a start is found without counting from the text's beginning
  SELECT r, doc_id, b, substring(h, 2 * b + 1, 1098) AS piece
  FROM (SELECT r, doc_id, h, unnest(generate_series(0, n - 50, 500)) AS b FROM d WHERE n >= 50)),
windows AS MATERIALIZED (
  SELECT r, doc_id, b + k AS i, md5(substring(piece, 2 * k + 1, 100)) AS s
  FROM (SELECT *, unnest(generate_series(0, least(500, length(piece) // 2 - 49) - 1)) AS k FROM blocks)),
firsts AS (SELECT s, min(doc_id) AS doc FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
starts AS (SELECT r, i FROM windows JOIN firsts USING (s) WHERE windows.doc_id > firsts.doc),
runs AS (
  SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM starts)),
spans AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY r, g),
cuts AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
kept AS (
  SELECT d.r, count(*) AS n_spans, sum(b - a) AS n_removed,
         string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
         || substring(any_value(h), 2 * max(b) + 1) AS h
  FROM d JOIN cuts USING (r) GROUP BY d.r)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(kept.n_removed, 0)::BIGINT AS n_removed,
       coalesce(kept.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP6 = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
sound AS MATERIALIZED (
  SELECT r, vec_id, e, len(e) AS dim, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.dim = b.dim AND a.r <> b.r
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reach AS (
  SELECT r AS a, r AS b FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
degree AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(degree.n, 0)::BIGINT AS n_links, least.component_id,
       coalesce(v.vec_id = least.component_id, false) AS kept
FROM v JOIN least USING (r) LEFT JOIN degree USING (r)
"""

OP8 = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
windows AS MATERIALIZED (
  SELECT r, doc_id, i, sha256(array_to_string(list_slice(w, i, i + 19), ' ')) AS s
  FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
firsts AS (SELECT s, min(struct_pack(doc := doc_id, i := i)) AS f FROM windows GROUP BY s HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT r, unnest(generate_series(windows.i, windows.i + 19)) AS i
  FROM windows JOIN firsts USING (s)
  WHERE windows.doc_id <> firsts.f.doc OR windows.i <> firsts.f.i),
word AS (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
kept AS (
  SELECT word.r, string_agg(word.word, ' ' ORDER BY word.i) AS t, count(*) AS n
  FROM word ANTI JOIN covered ON word.r = covered.r AND word.i = covered.i GROUP BY word.r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP10 = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
repeated AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(generate_series(i, i + 7)) AS i FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l) AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN repeated USING (r)),
f AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
         + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::BIGINT
         + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 30 * n_words)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM f
"""

OP11 = r"""
WITH RECURSIVE bits AS (  -- the table of the checksum, from its polynomial
  SELECT i, i AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
runs AS MATERIALIZED (
  SELECT id || ':' || run AS tag, run, count(*) AS n
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id,
               translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
sums AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(octet_length(encode(tag))),
                        lambda k: ('0x' || substring(hex(encode(tag)), 2 * k + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, crc),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run) + 2)::BIGINT)
                    ELSE run END AS word, n FROM sums)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
open AS MATERIALIZED (  -- a word without its letter i; i = 0 where nothing is left out
  SELECT word, n, i, CASE WHEN i = 0 THEN word ELSE substring(word, 1, i - 1) || substring(word, i + 1) END AS rest
  FROM (SELECT *, unnest(range(length(word) + 1)) AS i FROM words)),
pairs AS MATERIALIZED (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM open a JOIN open b USING (rest)
  WHERE a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)),
near AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS best, max(other_n) AS best_n FROM pairs GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
         CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
walk AS (
  SELECT word, word AS reached, 0 AS step FROM forms
  UNION ALL
  SELECT walk.word, f.form, step + 1 FROM walk JOIN forms f ON f.word = walk.reached WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN (SELECT word, arg_max(reached, step) AS root FROM walk GROUP BY word) w USING (word)
"""

OP13 = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS MATERIALIZED (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a
  FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 5) t(k)))
  GROUP BY ALL HAVING count(*) >= 30),
long_ones AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, 2000000::HUGEINT * c.a // (l.a::HUGEINT + r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM long_ones) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM long_ones)) GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
  FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.phrase = b.phrase
  WHERE s.longer IS NULL OR 100::HUGEINT * s.longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {"op5_suffix_array_dedup": OP5, "op6_embedding_dedup": OP6, "op8_substring_dedup": OP8,
           "op10_quality_rules": OP10, "op11_spelling_variants": OP11, "op13_collocations": OP13}
