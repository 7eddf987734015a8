"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from . import mixing, quality, secrets

OP2_SQL = r"""
WITH lines AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT keyed.*, frequent.k IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

OP10_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         [1, 2, 3][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), running AS (
  SELECT *, (sum(source_size) OVER ())::BIGINT AS total, (sum(weight) OVER ())::BIGINT AS weights,
         coalesce(sum(cap) OVER w, 0)::BIGINT AS cap_before, coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_before
  FROM sources
  WINDOW w AS (ORDER BY cap / weight ASC, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, (total - cap_before) * weight > cap * (weights - weight_before) AS is_capped FROM running
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN cap::DOUBLE
              ELSE (weight * (total - (sum(CASE WHEN is_capped THEN cap ELSE 0 END) OVER ())::BIGINT))::DOUBLE
                   / (weights - (sum(CASE WHEN is_capped THEN weight ELSE 0 END) OVER ())::BIGINT) END AS target
  FROM capped
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM targets
), hashes AS (
  SELECT source, h, sum(size) AS words FROM sized GROUP BY source, h
), summed AS (
  SELECT hashes.source, h, words, substr(h, 1, {mixing.BLOCK_DIGITS}) AS block,
         target - passes * source_size AS rest,
         sum(words) OVER (PARTITION BY hashes.source ORDER BY h) AS upto
  FROM hashes JOIN plan ON hashes.source IS NOT DISTINCT FROM plan.source
), blocks AS (
  SELECT source, block, max(upto) AS block_upto, any_value(rest) AS rest FROM summed GROUP BY source, block
), edges AS (
  SELECT source, min(block) AS block FROM blocks WHERE block_upto > rest GROUP BY source
), taken AS (
  SELECT summed.source, h,
         rest > 0 AND (edges.block IS NULL OR summed.block < edges.block
                       OR summed.block = edges.block AND upto - words / 2 <= rest) AS extra
  FROM summed LEFT JOIN edges ON summed.source IS NOT DISTINCT FROM edges.source
)
SELECT doc_id, size, source_size, target, (size * (passes + extra::INT))::BIGINT AS taken
FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source
JOIN taken ON sized.source IS NOT DISTINCT FROM taken.source AND sized.h = taken.h
"""



def _matches(kind: str, pattern: str, group: int = 0) -> str:
    """Matches of one kind, placed by the lengths of the pieces between them."""
    pattern = pattern.replace("'", "''")
    return f"""
SELECT r, {secrets.KINDS.index(kind)} AS k, value,
       (sum(length(gap) + length(whole)) OVER (PARTITION BY r ORDER BY i))::BIGINT AS "end",
       "end" - length(whole) AS start
FROM (SELECT r, unnest(string_split_regex(t, '{pattern}')) AS gap, unnest(regexp_extract_all(t, '{pattern}', 0)) AS whole,
             unnest(regexp_extract_all(t, '{pattern}', {group})) AS value,
             generate_subscripts(string_split_regex(t, '{pattern}'), 1) AS i
      FROM d WHERE regexp_matches(t, '{pattern}'))
WHERE whole IS NOT NULL"""


def _op5_sql() -> str:
    w, names = secrets.WINDOW, "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    classes = " ".join(f"WHEN regexp_full_match(value, '{p}') THEN {secrets._entropy_limit(bits)}"
                       for _, p, bits in secrets.CLASSES)
    allowed = "|".join(secrets.ALLOWED)
    text = f"coalesce(string_agg({names}[k + 1] || ':' || start || ':' || \"end\", ',' ORDER BY start, k, \"end\"), '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  SELECT r, k, start, "end" FROM ({_matches("assign", secrets.ASSIGN, 1)}) WHERE length(value) >= {secrets.MIN_VALUE}
  UNION ALL SELECT r, k, start, "end" FROM ({_matches("access", secrets.ACCESS)})
  UNION ALL SELECT r, k, start, "end" FROM ({_matches("hex", secrets.HEX)})
), candidates AS (
  SELECT *, CASE {classes} ELSE -1 END AS most FROM ({_matches("entropy", secrets.CANDIDATE)})
  WHERE NOT regexp_full_match(value, '{allowed}')
), windows AS (
  SELECT r, k, start, value, most, unnest(range(length(value) - {w - 1})) AS i FROM candidates
), counted AS (
  SELECT r, k, start, most, i, c, count(*) AS n
  FROM (SELECT r, k, start, most, i, unnest(string_split(substr(value, i::INT + 1, {w}), '')) AS c FROM windows)
  WHERE c <> '' GROUP BY ALL
), hits AS (
  SELECT r, k, start, i, most FROM counted GROUP BY ALL
  HAVING sum(CASE WHEN n < 2 THEN 0 ELSE round({secrets.SCALE} * n * log2(n)) END) <= most
), more AS (
  SELECT r, k, start + min(i) AS start, start + max(i) + {w} AS "end" FROM hits GROUP BY r, k, hits.start
), spans AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM more WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.r = more.r AND b.start <= more.start AND b."end" >= more."end")
), base_text AS (
  SELECT r, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
         count(*) FILTER (WHERE k = 2) AS n_hex, {text} AS s FROM base GROUP BY r
), span_text AS (SELECT r, {text} AS s FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.s, '')) AS base_sha256, coalesce(s.s, '') AS spans
FROM d LEFT JOIN base_text b USING (r) LEFT JOIN span_text s USING (r)"""


def _bits(p: str, q: str) -> str:
    one = lambda a: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({p} + {q})) ELSE 0 END"
    return f"({one(p)} + {one(q)})"


def _op9_sql() -> str:
    shares = ", ".join(f"sum({c})::DOUBLE / sum(n_chars) AS q_{c}" for c in quality.CLASSES)
    class_bits = " + ".join(_bits(f"(m.{c}::DOUBLE / m.n_chars)", f"refs.q_{c}") for c in quality.CLASSES)
    p, q = "(c::DOUBLE / n_words)", "q"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, text IS NOT NULL AS has_text, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, regexp_extract_all(t, '[^ 	-
]+') AS ws FROM d)
), sums AS (SELECT r, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars FROM w GROUP BY r),
windows AS (
  SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {quality.WINDOW - 1} FOLLOWING) AS ws
  FROM w
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, ws) AS n FROM windows WHERE len(ws) = {quality.WINDOW})
  WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT i + o) AS n_repeat_words
  FROM (SELECT r, i, unnest(range({quality.WINDOW})) AS o FROM again) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^ 	-
]') GROUP BY r
), counted AS (
  SELECT r, doc_id, lang, has_text, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, length(t) AS n_chars,
         length(regexp_replace(t, '[\p{{L}} 	-
]+', '', 'g')) AS n_rest,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS upper, length(regexp_replace(t, '[^0-9]+', '', 'g')) AS digit
  FROM d LEFT JOIN sums USING (r) LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)
), m AS (
  SELECT *, word_chars - n_rest - upper AS letter, n_symbols AS symbol, n_chars - word_chars AS space,
         n_rest - digit - n_symbols AS other,
         n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted
), drawn AS (
  SELECT * FROM m JOIN (SELECT lang, count(*) AS n FROM d WHERE lang IS NOT NULL AND has_text GROUP BY lang) USING (lang)
  WHERE has_text AND ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0
        < least(1.0, {quality.SAMPLE_DOCS}::DOUBLE / n) AND NOT base_failed
), refs AS (SELECT lang, sum(n_words) AS words, {shares} FROM drawn GROUP BY lang),
common AS (
  SELECT lang, word, n::DOUBLE / words AS q FROM (
    SELECT lang, lower(w) AS word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, lower(w)) AS k
    FROM drawn JOIN w USING (r) GROUP BY lang, lower(w)
  ) JOIN refs USING (lang) WHERE k <= {quality.COMMON_WORDS}
), totals AS (SELECT lang, sum(q) AS total FROM common GROUP BY lang),
runs AS (SELECT r, lower(w) AS word, count(*) AS c FROM w GROUP BY r, lower(w)),
met AS (
  SELECT r, lang, sum({_bits(p, q)}) AS bits, sum({p}) AS p, sum(q) AS q
  FROM runs JOIN common USING (word) JOIN sums USING (r) GROUP BY r, lang
), word_distance AS (
  SELECT r, min((bits + total - q + {_bits("greatest(1 - p, 0.0)", "greatest(1 - total, 0.0)")}) / 2) AS x
  FROM (SELECT m.r, totals.lang, total, coalesce(bits, 0) AS bits, coalesce(p, 0) AS p, coalesce(q, 0) AS q
        FROM m CROSS JOIN totals LEFT JOIN met ON met.r = m.r AND met.lang = totals.lang)
  GROUP BY r
), class_distance AS (
  SELECT r, min(({class_bits}) / 2) AS x FROM m CROSS JOIN refs WHERE n_chars >= {quality.GUARD_CHARS} GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(c.x > {quality.MAX_CLASS_DISTANCE}, false)
       AND NOT coalesce(n_words >= {quality.GUARD_WORDS}
                        AND wd.x > {quality.MAX_WORD_DISTANCE} + {quality.WORD_NOISE} / n_words, false) AS kept
FROM m LEFT JOIN class_distance c USING (r) LEFT JOIN word_distance wd USING (r)"""


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), known AS (
  SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0
), totals AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM known
), tf AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM known) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals GROUP BY term
), items AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)
), asked AS (
  SELECT DISTINCT i, item_id, unnest(terms) AS term FROM items
), scores AS (
  SELECT i, item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), totals
  GROUP BY i, item_id, r, doc_id
), ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE = {"op12_lexical_search": OP12_SQL, "op2_line_dedup": OP2_SQL, "op5_secret_scan": _op5_sql(), "op9_quality_rules": _op9_sql(),
          "op10_source_mixing": OP10_SQL}
