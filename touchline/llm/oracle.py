"""DuckDB SQL for the queries that SQL can express. Tokenizers, XXH64 and the
trained classifier have no SQL form; their queries are tested against
brute-force versions instead."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role), '')) AS loss_sha256,
       sum(24 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
           + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g'))
          )::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLE["op5_secrets"] = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
rules(ord, kind, pattern, least, grp) AS (VALUES
  (0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12, 2),
  (1, 'access', 'AKIA[A-Z0-9]+', 18, 0),
  (2, 'hex', '[0-9a-f]+', 16, 0),
  (3, 'github', 'gh[pousr]_[A-Za-z0-9]{36,}', 0, 0),
  (4, 'slack', 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 0),
  (5, 'jwt', 'eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}', 0, 0),
  (6, 'key_block', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0),
  (7, 'google', 'AIza[0-9A-Za-z_-]{35}', 0, 0)),
lists AS (
  SELECT rid, 0 AS ord, 'assign' AS kind, 12 AS least, regexp_extract_all(text, (SELECT pattern FROM rules WHERE ord = 0), 0) AS hits,
         regexp_extract_all(text, (SELECT pattern FROM rules WHERE ord = 0), 2) AS vals,
         regexp_split_to_array(text, (SELECT pattern FROM rules WHERE ord = 0)) AS gaps FROM docs
  UNION ALL
  SELECT rid, ord, kind, least, regexp_extract_all(text, pattern) AS hits, regexp_extract_all(text, pattern) AS vals,
         regexp_split_to_array(text, pattern) AS gaps FROM docs, rules WHERE ord > 0),
parts AS (
  SELECT rid, ord, kind, least, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(vals) AS val,
         unnest(gaps[1:len(hits)]) AS gap FROM lists WHERE len(hits) > 0),
placed AS (
  SELECT rid, ord, kind, least, val, length(hit) AS n,
         sum(length(gap) + length(hit)) OVER (PARTITION BY rid, ord ORDER BY i) AS e FROM parts),
spans AS (SELECT rid, ord, kind || ':' || (e - n) || ':' || e AS span, e - n AS s FROM placed WHERE length(val) >= least),
joined AS (
  SELECT rid, count(*) FILTER (WHERE ord = 0) AS a, count(*) FILTER (WHERE ord = 1) AS b,
         count(*) FILTER (WHERE ord = 2) AS c, string_agg(span, ',' ORDER BY s, ord) FILTER (WHERE ord < 3) AS base,
         string_agg(span, ',' ORDER BY s, ord) AS spans FROM spans GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (rid)
"""

ORACLE["op6_quality"] = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
lists AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
words AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM lists),
grams AS (
  SELECT rid, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS gram FROM words
  WINDOW o AS (PARTITION BY rid ORDER BY i)),
again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams WHERE gram IS NOT NULL)
  WHERE n > 1),
repeated AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) t(k) GROUP BY rid),
m AS (
  SELECT rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM lists LEFT JOIN repeated USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
cells AS (
  SELECT rid, lang, source, base_failed, r.ratio AS ratio, r.v AS v
  FROM (SELECT *, unnest([
      {'ratio': 'symbol_ratio', 'v': n_symbols::DOUBLE / greatest(n_words, 1)},
      {'ratio': 'dup_line_ratio', 'v': n_dup_lines::DOUBLE / greatest(n_lines, 1)},
      {'ratio': 'repeat_ratio', 'v': n_repeat_words::DOUBLE / greatest(n_words, 1)},
      {'ratio': 'word_length', 'v': word_chars::DOUBLE / greatest(n_words, 1)},
      {'ratio': 'n_words', 'v': n_words::DOUBLE}, {'ratio': 'n_lines', 'v': n_lines::DOUBLE}]) AS r FROM judged)),
sketch AS (
  SELECT lang, source, ratio, CASE WHEN v > 0 THEN ceil(ln(v) / ln(1.01::DOUBLE / 0.99::DOUBLE)) END AS bucket, count(*) AS n
  FROM cells WHERE NOT base_failed GROUP BY ALL),
everything AS (
  SELECT ratio, bucket, floor(1e9 * n / sum(n) OVER (PARTITION BY ratio))::BIGINT AS n
  FROM (SELECT ratio, bucket, sum(n) AS n FROM sketch GROUP BY ratio, bucket)),
of_lang AS (
  SELECT lang, ratio, bucket, floor(1e9 * n / sum(n) OVER (PARTITION BY lang, ratio))::BIGINT AS n
  FROM (SELECT lang, ratio, bucket, sum(n) AS n
        FROM (SELECT lang, ratio, bucket, 10000000 * n AS n FROM sketch
              UNION ALL SELECT l.lang, ratio, e.bucket, e.n FROM (SELECT DISTINCT lang, ratio FROM sketch) l JOIN everything e USING (ratio))
        GROUP BY lang, ratio, bucket)),
merged AS (
  SELECT lang, source, ratio, bucket, sum(n) AS n
  FROM (SELECT lang, source, ratio, bucket, 10000000 * n AS n FROM sketch
        UNION ALL SELECT g.lang, g.source, g.ratio, l.bucket, l.n FROM (SELECT DISTINCT lang, source, ratio FROM sketch) g
        JOIN of_lang l ON l.lang IS NOT DISTINCT FROM g.lang AND l.ratio = g.ratio)
  GROUP BY lang, source, ratio, bucket),
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, ratio ORDER BY bucket NULLS FIRST) AS upto,
         sum(n) OVER (PARTITION BY lang, source, ratio) AS total,
         CASE WHEN bucket IS NULL THEN 0 ELSE 2 * pow(1.01::DOUBLE / 0.99::DOUBLE, bucket) / (1.01::DOUBLE / 0.99::DOUBLE + 1) END AS mid FROM merged),
quartiles AS (
  SELECT lang, source, ratio, min(mid) FILTER (WHERE upto >= ceil(total * 0.25)) AS q1,
         min(mid) FILTER (WHERE upto >= ceil(total * 0.5)) AS q2,
         min(mid) FILTER (WHERE upto >= ceil(total * 0.75)) AS q3 FROM ranked GROUP BY lang, source, ratio),
spare(ratio, size, n) AS (VALUES ('symbol_ratio', 'n_words', 40::DOUBLE), ('dup_line_ratio', 'n_lines', 4::DOUBLE),
                                 ('repeat_ratio', 'n_words', 100::DOUBLE), ('word_length', NULL, NULL)),
limits AS (
  SELECT q.lang, q.source, q.ratio, q.q3 + greatest(6 * greatest(q.q3 - q.q1, 0.02::DOUBLE * q.q3), coalesce(s.n / z.q2, 0)) AS most
  FROM quartiles q JOIN spare s ON s.ratio = q.ratio
  LEFT JOIN quartiles z ON z.ratio = s.size AND z.lang IS NOT DISTINCT FROM q.lang AND z.source IS NOT DISTINCT FROM q.source),
failed AS (
  SELECT DISTINCT c.rid FROM cells c
  JOIN limits a ON a.ratio = c.ratio AND a.lang IS NOT DISTINCT FROM c.lang AND a.source IS NOT DISTINCT FROM c.source
  WHERE c.v > a.most)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed.rid IS NULL AS kept
FROM judged LEFT JOIN failed ON failed.rid = judged.rid
"""

_BITS = " + ".join(f"{1 << (4 - k)} * (substr(bits, 5 * i + {k + 1}, 1) = '1')::INT" for k in range(5))
ORACLE["op7_warc"] = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT h, min(page_id) AS first FROM hashed GROUP BY h),
bits AS (
  SELECT h, first, array_to_string(list_transform(string_split(h, ''), lambda x: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', x) - 1) + 1, 4)
  ), '') AS bits FROM firsts),
digests AS (
  SELECT h, first, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_BITS}, 1)), '') AS digest FROM bits)
SELECT page_id, payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM hashed JOIN digests USING (h)
"""

# CRC-32 by half bytes; fixed values: the table of the polynomial 0xEDB88320.
_NIBBLES = ("([0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, "
            "3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]::BIGINT[])")
_HALF = f"xor({_NIBBLES}[({{0}} & 15) + 1], {{0}} >> 4)"


def _crc32(column: str) -> str:
    digit = "(strpos('0123456789ABCDEF', substr(hex({0}), {1}, 1)) - 1)"
    byte = f"{digit.format(column, '2 * i + 1')} * 16 + {digit.format(column, '2 * i + 2')}"
    step = _HALF.format(_HALF.format("xor(c, b)"))
    return (f"xor(list_reduce(list_transform(range(strlen({column})), lambda i: ({byte})::BIGINT), lambda c, b: {step}, "
            "4294967295::BIGINT), 4294967295)")


ORACLE["op11_conversation_trie"] = f"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p,
         struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS s
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, list(s ORDER BY p) AS own, c::VARCHAR AS name FROM turns GROUP BY c),
shares AS (SELECT *, {_crc32('name')} % 6 AS h FROM convs),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(list_slice(b.own, 1, a.h), []), list_slice(a.own, a.h + 1, len(a.own))) AS seq
  FROM shares a LEFT JOIN convs b ON b.c = a.c - a.c % 100),
members AS (SELECT c, d, list_slice(seq, 1, d) AS node, len(seq) = d AS ends
            FROM (SELECT c, seq, unnest(range(len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(node[d].t) END AS saved,
         sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM members GROUP BY node, d),
kids AS (SELECT list_slice(node, 1, d - 1) AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
grown AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (node, d)),
above AS (SELECT d, conv_id, n_children, saved, unnest(range(d + 1)) AS e, node FROM grown),
sums AS (SELECT list_slice(node, 1, e) AS node, e AS d, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved
         FROM above GROUP BY 1, 2)
SELECT g.conv_id, g.d::BIGINT AS depth, p.conv_id AS parent_conv_id, g.n_convs::BIGINT AS n_convs,
       g.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, g.ends_sha256
FROM grown g JOIN sums s ON s.node = g.node AND s.d = g.d
LEFT JOIN nodes p ON p.d = g.d - 1 AND p.node = list_slice(g.node, 1, g.d - 1)
"""

ORACLE["op12_neighbours"] = """
WITH vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20
"""

ORACLE["op13_resampling"] = f"""
WITH texts AS (SELECT true AS doc, doc_id AS id, text FROM documents
               UNION ALL SELECT false, item_id, text FROM benchmark),
words AS (
  SELECT row_number() OVER () AS rid, doc, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
runs AS (
  SELECT rid, doc, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM words),
found AS (SELECT rid, doc, f, count(*) AS n FROM runs GROUP BY rid, doc, f),
buckets AS (SELECT f, {_crc32('f')} % 10000 AS b FROM (SELECT DISTINCT f FROM found)),
hits AS (SELECT rid, doc, b, sum(n) AS n FROM found JOIN buckets USING (f) GROUP BY rid, doc, b),
counts AS (SELECT b, coalesce(sum(n) FILTER (doc), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT doc), 0)::DOUBLE AS t
           FROM hits GROUP BY b),
gains AS (SELECT b, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + 10000)
                                    / ((s + 1) * ((SELECT sum(t) FROM counts) + 10000))))::BIGINT AS gain FROM counts),
sums AS (SELECT rid, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS gain FROM hits JOIN gains USING (b) GROUP BY rid),
weighed AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
         coalesce(gain // n - (gain % n < 0)::BIGINT, 0) AS weight,
         ('0x' || substr(sha256('7:' || id::VARCHAR), 1, 8))::BIGINT AS h
  FROM words LEFT JOIN sums USING (rid) WHERE doc),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM weighed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
                  25 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS drawn FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
       CASE WHEN n_words >= 20 AND place <= drawn THEN place END::BIGINT AS rank
FROM ranked
"""
