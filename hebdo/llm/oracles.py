"""DuckDB SQL for the operators that SQL expresses, over whole tables."""

ORACLES = {}

ORACLES["op1_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || left(md5('17:' || doc_id::VARCHAR), 13))::BIGINT::DOUBLE / 4503599627370496.0 AS coin
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM d GROUP BY source),
-- every source's level if exactly the sources with a smaller cap per weight were capped
l AS (SELECT a.source, a.source_size, a.weight, 3.0::DOUBLE * a.source_size AS cap,
             (SELECT (sum(b.source_size)::DOUBLE
                      - coalesce(sum(3.0::DOUBLE * b.source_size) FILTER (
                          (3.0::DOUBLE * b.source_size / b.weight, b.source) < (3.0::DOUBLE * a.source_size / a.weight, a.source)), 0))
                     / sum(b.weight) FILTER (
                          (3.0::DOUBLE * b.source_size / b.weight, b.source) >= (3.0::DOUBLE * a.source_size / a.weight, a.source))
              FROM s b) AS level
      FROM s a),
lv AS (SELECT arg_min(level, cap / weight) AS level FROM l WHERE level <= cap / weight),
t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM lv)) AS target FROM l)
SELECT d.doc_id, d.size, t.source_size, t.target,
       (CASE WHEN t.source_size = 0 THEN 0
             ELSE floor(t.target / t.source_size)
                  + (d.coin < t.target / t.source_size - floor(t.target / t.source_size))::INT END
        * d.size)::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""

ORACLES["op4_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
"""

ORACLES["op3_warc"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last_id IS NOT NULL AND page_id IS DISTINCT FROM last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last_id IS NOT NULL AND page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
FROM g
"""

# CRC-32 by half bytes: each step shifts by four bits and adds the table entry of the low ones
# (fixed values of the polynomial 0xEDB88320)
_CRC_TABLE = ("[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
              "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]")

ORACLES["op2_quality_rules"] = rf"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS uid, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (SELECT uid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t),
vocabulary AS (
  SELECT word, xor(list_reduce(
           list_prepend(4294967295::BIGINT, flatten(list_transform(range(strlen(word)), lambda k: [
             strpos('0123456789ABCDEF', substr(hex(encode(word)), 2 * k + 2, 1)) - 1,
             strpos('0123456789ABCDEF', substr(hex(encode(word)), 2 * k + 1, 1)) - 1]))),
           lambda crc, x: xor(({_CRC_TABLE}::BIGINT[])[(xor(crc, x) & 15) + 1], crc >> 4)), 4294967295::BIGINT) AS crc
  FROM (SELECT DISTINCT word FROM w)),
h AS (SELECT uid, i, crc, lead(crc) OVER (PARTITION BY uid ORDER BY i) AS next FROM w JOIN vocabulary USING (word)),
g AS (SELECT uid, crc % 16384 AS bucket FROM h
      UNION ALL SELECT uid, (crc * 1000003 + next) % 16384 FROM h WHERE next IS NOT NULL),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
c AS (SELECT bucket, count(*) AS raw, count(good.doc_id) AS target
      FROM g JOIN t USING (uid) LEFT JOIN good ON t.doc_id = good.doc_id GROUP BY bucket),
r AS (SELECT bucket, round_even((ln((target + 1.0) / ((SELECT sum(target) FROM c)::DOUBLE + 16384.0))
                                 - ln((raw + 1.0) / ((SELECT sum(raw) FROM c)::DOUBLE + 16384.0))) * 1000000, 0)::BIGINT AS ratio
      FROM (SELECT bucket, raw::DOUBLE AS raw, target::DOUBLE AS target FROM c)),
scores AS (SELECT uid, sum(ratio) AS total, count(*) AS n FROM g JOIN r USING (bucket) GROUP BY uid),
windows AS (SELECT uid, i, list(word) OVER (PARTITION BY uid ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS eight FROM w),
twice AS (SELECT uid, i FROM (SELECT uid, i, count(*) OVER (PARTITION BY uid, eight) AS n FROM windows WHERE len(eight) = 8) WHERE n > 1),
covered AS (SELECT uid, count(DISTINCT i + k) AS n FROM twice, range(8) AS r(k) GROUP BY uid),
b AS (SELECT t.doc_id, t.uid, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(covered.n, 0)::BIGINT AS n_repeat_words
      FROM t LEFT JOIN covered USING (uid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(total >= -80000 * n, false) AS kept
FROM f LEFT JOIN scores USING (uid)
"""

ORACLES["op5_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS pos
  FROM conversations),
c AS (SELECT conv_id, count(*) AS n_turns, list(struct_pack(role := role, text := text) ORDER BY pos) AS turns
      FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT turns[1:k.k] AS turns FROM c, LATERAL (SELECT unnest(range(1, n_turns)) AS k) k),
j AS (SELECT *, min(conv_id) OVER (PARTITION BY turns) AS copy_of FROM c),
v AS (SELECT j.*, conv_id IS NOT DISTINCT FROM copy_of AND p.turns IS NULL AS kept FROM j LEFT JOIN p ON j.turns = p.turns)
SELECT v.conv_id, n_turns, copy_of, kept, NULL::BIGINT AS part, NULL AS chat FROM v WHERE NOT kept
UNION ALL
SELECT v.conv_id, any_value(n_turns), any_value(copy_of), true, (pos - 1) // 256,
       string_agg('<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
                  || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos)
FROM v JOIN t ON v.conv_id IS NOT DISTINCT FROM t.conv_id WHERE kept GROUP BY v.conv_id, (pos - 1) // 256
"""

ORACLES["op12_filter_audit"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (
  SELECT t.doc_id, part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic, {
           'A': len(words) < 100, 'B': 100 * len(list_distinct(words)) < 80 * len(words),
           'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
           'D': regexp_matches(text, '[#$%&*|]'),
           'E': t.doc_id > min(t.doc_id) OVER (PARTITION BY text)} AS x
  FROM t LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l
    ON t.doc_id = l.doc_id),
p AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda c:
        CASE c WHEN 'A' THEN x.A WHEN 'B' THEN x.B WHEN 'C' THEN x.C WHEN 'D' THEN x.D ELSE x.E END) AS fails FROM f),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM p GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || d.c || e.c || g.c AS filter_order, [a.c, b.c, d.c, e.c, g.c] AS seq
      FROM letters a, letters b, letters d, letters e, letters g
      WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
s AS (SELECT filter_order, step, seq[step] AS this, seq[1:step - 1] AS earlier FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, this,
         sum(n) FILTER (NOT list_has_any(fails, list_append(earlier, this))) AS kept,
         sum(n) FILTER (list_contains(fails, this) AND NOT list_has_any(fails, earlier)) AS removed,
         sum(n) FILTER (list_contains(fails, this) AND list_has_any(fails, earlier)) AS redundant,
         sum(n) FILTER (fails = [this]) AS unique_fails,
         sum(good) FILTER (list_contains(fails, this) AND NOT list_has_any(fails, earlier)) AS good_lost,
         sum(toxic) FILTER (list_contains(fails, this) AND NOT list_has_any(fails, earlier)) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, this), 0)::BIGINT AS shapley
FROM r
"""

ORACLES["op13_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
d AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id != s.first AS dropped FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
