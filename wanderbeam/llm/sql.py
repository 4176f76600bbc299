"""DuckDB SQL for the operators that SQL can express, written apart from the operators."""

from __future__ import annotations

# Words: runs of anything but space and 09-0D.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_STOPS = sorted(
    set(
        """the of and to in is that it for as was with be by on not he are this at from or an a
        der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch
        de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se
        de la que el en y a los se del las un por con no una su para es al lo como""".split()
    )
)
_STOP_LIST = ", ".join(f"'{w}'" for w in sorted({*_STOPS, *(w[0].upper() + w[1:] for w in _STOPS if len(w) > 1)}))

QUALITY_RULES_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, {_WORDS} AS w FROM documents
), g AS (
  SELECT r, i, list_slice(w, i, i + 4) AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM g) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
), li AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(body, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
), m AS (
  SELECT d.doc_id, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(body) - length(translate(body, '#*$%&|<>', '')) AS n_symbols,
         coalesce(li.dup, 0) AS n_dup_lines, coalesce(li.n_lines, 0) AS n_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: rtrim(x, '.,') IN ({_STOP_LIST}))) AS stops
  FROM d LEFT JOIN covered USING (r) LEFT JOIN li USING (r)
), f AS (
  SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed,
    list_filter([
      CASE WHEN (CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END) NOT BETWEEN 2 AND 25 THEN 'mean_word_length' END,
      CASE WHEN (CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END) > 0.1 THEN 'symbols' END,
      CASE WHEN (CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END) < 0.02 THEN 'stop_words' END,
      CASE WHEN (CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END) > 0.3 THEN 'duplicate_lines' END,
      CASE WHEN (CASE WHEN n_lines > 0 THEN n_words / n_lines ELSE 0 END) < 1 THEN 'blank_lines' END
    ], lambda x: x IS NOT NULL) AS failed
  FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       len(failed) = 0 AND NOT base_failed AS kept, array_to_string(failed, ',') AS failed_rules
FROM f
"""

# CRC-32 byte by byte over the hexadecimal digits of the UTF-8 text; the table of 256 entries
# comes from the polynomial.
_CRC_STEP = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
_CRC_TABLE = f"""steps AS (
  SELECT i::BIGINT AS i, i::BIGINT AS x, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, {_CRC_STEP}, k + 1 FROM steps WHERE k < 8
), crc AS (SELECT list(x ORDER BY i) AS tab FROM steps WHERE k = 8
)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)"""


SHARDING_SQL = f"""
WITH RECURSIVE {_CRC_TABLE}, d AS (
  SELECT doc_id, coalesce(text, '') AS body FROM documents
), s AS (
  SELECT doc_id, octet_length(encode(body)) + 1 AS size, md5(body) AS k,
         {_crc32('body')} AS crc
  FROM d, crc
), p AS (
  SELECT *, sum(size) OVER (ORDER BY k, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS start,
         sum(size) OVER () AS whole
  FROM s
), q AS (SELECT *, ((start * 16) // whole)::INTEGER AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY start) - 1)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM q
"""

# Forty plain bisection steps on the exponent, then the same blocks and permutations.
MIXING_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len({_WORDS}) + 1 AS tokens FROM documents
), s AS (
  SELECT source, sum(tokens) AS tokens FROM d GROUP BY source
), sh AS (
  SELECT source, tokens, tokens::DOUBLE / (sum(tokens) OVER ())::DOUBLE AS p, sum(tokens) OVER () AS whole,
         count(*) OVER () AS n FROM s
), shares AS (SELECT list(p) AS ps, list(tokens::DOUBLE) AS ts, max(whole)::DOUBLE AS whole, max(n) AS n FROM sh
), flat AS (SELECT -list_sum(list_transform(ps, lambda p: p * ln(p))) AS h FROM shares
), be AS (
  SELECT 0 AS k, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT k + 1, CASE WHEN good THEN mid ELSE lo END, CASE WHEN good THEN hi ELSE mid END FROM (
    SELECT k, lo, hi, mid,
      ln(list_sum(list_transform(ps, lambda p: pow(p, mid))))
        - mid * list_sum(list_transform(ps, lambda p: pow(p, mid) * ln(p)))
          / list_sum(list_transform(ps, lambda p: pow(p, mid))) >= 0.95 * ln(n) AS good
    FROM (SELECT *, (lo + hi) / 2 AS mid FROM be WHERE k < 40), shares)
), br AS (
  SELECT 0 AS k, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT k + 1, CASE WHEN good THEN mid ELSE lo END, CASE WHEN good THEN hi ELSE mid END FROM (
    SELECT k, lo, hi, mid,
      whole * list_max(list_transform(list_zip(ps, ts), lambda z: pow(z[1], mid) / z[2]))
        / list_sum(list_transform(ps, lambda p: pow(p, mid))) > 4.0 AS good
    FROM (SELECT *, (lo + hi) / 2 AS mid FROM br WHERE k < 40), shares)
), e AS (
  SELECT CASE WHEN n < 2 OR flat.h >= 0.95 * ln(n) THEN 1.0 ELSE (SELECT lo FROM be WHERE k = 40) END AS a FROM shares, flat
), chosen AS (
  SELECT CASE WHEN n >= 2 AND whole * list_max(list_transform(list_zip(ps, ts), lambda z: pow(z[1], a) / z[2]))
        / list_sum(list_transform(ps, lambda p: pow(p, a))) > 4.0
      THEN greatest(a, (SELECT hi FROM br WHERE k = 40)) ELSE a END AS alpha
  FROM e, shares
), plan AS (
  SELECT source, tokens, floor(pow(p, alpha) / (sum(pow(p, alpha)) OVER ()) * whole::DOUBLE + 1e-6)::BIGINT AS allowance
  FROM sh, chosen
), cut AS (
  SELECT source, tokens AS size, allowance // tokens AS passes, allowance % tokens AS rest FROM plan
), b AS (
  SELECT d.*, c.passes, c.rest, unnest(range((c.passes + 1)::BIGINT)) AS block
  FROM d JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
), keyed AS (
  SELECT *, md5('mix#' || coalesce(doc_id::VARCHAR, '') || '#' || block) AS key FROM b
), run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source, block ORDER BY key) AS upto FROM keyed
)
SELECT doc_id, source, tokens::BIGINT AS mix_tokens, block::INTEGER AS mix_block, key AS mix_key
FROM run WHERE block < passes OR upto <= rest
"""

SUBSTRING_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), g AS (
  SELECT r, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13 AND doc_id IS NOT NULL)
), f AS (
  SELECT win, min(doc_id) AS first FROM g GROUP BY win
), gone AS (
  SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (win) WHERE first < doc_id)
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY p) AS body
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r
), n AS (
  SELECT r, count(*) AS n FROM gone GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""

FILTER_AUDIT_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body, {_WORDS} AS w FROM documents
), l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map {{
    'A': len(w) < 100,
    'B': 100 * len(list_distinct(w)) < 80 * len(w),
    'C': 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 10 * length(body),
    'D': regexp_matches(body, '[#$%&*|]'),
    'E': coalesce(min(d.doc_id) OVER (PARTITION BY body) < d.doc_id, false)}} AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
  FROM o, range(1, 6) t(step)
), g AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL
), r AS (
  SELECT part, filter_order, step, own, g.n, good, toxic, fails[own] AS hit,
    len(list_filter(string_split(earlier, ''), lambda e: e <> '' AND fails[e])) > 0 AS before,
    len(list_filter(map_values(fails), lambda v: v)) AS many
  FROM g, s
), t AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT before AND NOT hit THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT before AND hit THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN before AND hit THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN hit AND many = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT before AND hit AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT before AND hit AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM t
"""

PREFIX_TRIE_SQL = f"""
WITH RECURSIVE {_CRC_TABLE}, t AS (
  SELECT conv_id AS c, length(coalesce(text, '')) AS chars, dig,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dig) AS p
  FROM (SELECT *, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS dig
        FROM conversations WHERE conv_id IS NOT NULL)
), cv AS (
  SELECT c, c - c % 100 AS b, {_crc32('c::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT c FROM t), crc
), r AS (
  SELECT cv.c, t.p AS d, t.chars, t.dig FROM cv JOIN t ON t.c = cv.b AND t.p <= cv.h
  UNION ALL
  SELECT cv.c, t.p - cv.h + (SELECT count(*) FROM t u WHERE u.c = cv.b AND u.p <= cv.h), t.chars, t.dig
  FROM cv JOIN t ON t.c = cv.c AND t.p > cv.h
), p AS (
  SELECT c, d, chars, string_agg(dig, ',') OVER (PARTITION BY c ORDER BY d) AS path,
    d = max(d) OVER (PARTITION BY c) AS last FROM r
  UNION ALL SELECT c, 0, 0, '', c NOT IN (SELECT c FROM r) FROM cv
), n AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends
  FROM p GROUP BY path, d
), a AS (
  SELECT n.*, up.path AS over, up.d AS over_d FROM n JOIN p up ON up.c = n.conv_id AND up.d <= n.d
), kids AS (
  SELECT over AS path, over_d AS d, count(*) AS n_children FROM a WHERE over_d = a.d - 1 GROUP BY ALL
), total AS (
  SELECT a.over AS path, a.over_d AS d, sum(a.saved) AS saved, count(*) FILTER (kids.path IS NULL) AS leaves
  FROM a LEFT JOIN kids ON kids.path = a.path AND kids.d = a.d GROUP BY ALL
), above AS (
  SELECT a.path, a.d, m.conv_id FROM a JOIN n m ON m.path = a.over AND m.d = a.over_d WHERE a.over_d = a.d - 1
)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, above.conv_id::BIGINT AS parent_conv_id,
       n.n_convs::BIGINT AS n_convs, coalesce(kids.n_children, 0)::BIGINT AS n_children,
       total.leaves::BIGINT AS n_leaves, total.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN total ON total.path = n.path AND total.d = n.d
LEFT JOIN kids ON kids.path = n.path AND kids.d = n.d
LEFT JOIN above ON above.path = n.path AND above.d = n.d
"""
