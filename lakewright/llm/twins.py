"""DuckDB SQL that must give the rows of the registered queries."""

from __future__ import annotations

import zlib

from lakewright.llm.sharding import P1, P2, round_keys
from lakewright.llm.url_filter import UPPER


def lines(ratio: float) -> str:
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), told AS (
  SELECT DISTINCT nr, source, trim(u.line) AS line FROM docs, unnest(lines) AS u(line) WHERE trim(u.line) <> ''
), totals AS (
  SELECT source, count(*) AS total FROM documents GROUP BY source
), bad AS (
  SELECT t.source, list(line) AS bad FROM (
    SELECT source, line, count(*) AS n FROM told GROUP BY source, line
  ) t JOIN totals ON t.source IS NOT DISTINCT FROM totals.source
  WHERE n >= 3 AND n > {ratio}::DOUBLE * total GROUP BY t.source
), cleaned AS (
  SELECT doc_id, d.source, text, lines,
    list_filter(lines, lambda x: bad IS NULL OR NOT list_contains(bad, trim(x))) AS good
  FROM docs d LEFT JOIN bad ON d.source IS NOT DISTINCT FROM bad.source
)
SELECT doc_id, source, CASE WHEN len(good) < len(lines) THEN array_to_string(good, chr(10)) ELSE text END AS text,
  coalesce(len(lines), 0)::INTEGER AS n_lines, coalesce(len(lines) - len(good), 0)::INTEGER AS n_dropped
FROM cleaned
"""


DECONTAMINATION = """
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents
), items AS (
  SELECT w AS item, min(item_id) AS item_id, count(*) AS n_items FROM (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM benchmark
  ) WHERE len(w) >= 8 GROUP BY w
), item_seeds AS (
  SELECT item_id, p - 1 AS j, unnest([[item[p], item[p+1], item[p+2], '', item[p+4], item[p+6], item[p+7]],
    [item[p], item[p+1], '', '', item[p+4], item[p+5], item[p+6], item[p+7]]]) AS seed
  FROM (SELECT *, unnest(range(1, len(item) - 6)) AS p FROM items)
), doc_seeds AS (
  SELECT doc_id, w, p - 1 AS i, unnest([[w[p], w[p+1], w[p+2], '', w[p+4], w[p+6], w[p+7]],
    [w[p], w[p+1], '', '', w[p+4], w[p+5], w[p+6], w[p+7]]]) AS seed
  FROM (SELECT *, unnest(range(1, len(w) - 6)) AS p FROM docs)
), aligned AS (
  SELECT DISTINCT doc_id, item_id, i - j AS start, w FROM doc_seeds JOIN item_seeds USING (seed)
), matched AS (
  SELECT doc_id, a.item_id, n_items, len(item) AS item_tokens, start, list_transform(range(1, len(item) + 1), lambda k:
    CASE WHEN start + k >= 1 AND start + k <= len(w) AND w[start + k] = item[k] THEN 1 ELSE 0 END) AS m
  FROM aligned a JOIN items USING (item_id)
), judged AS (
  SELECT *, list_sum(m) AS matched, least(len(m), 13) AS width FROM matched
)
SELECT doc_id, item_id, n_items, item_tokens::INTEGER AS item_tokens, max(matched)::INTEGER AS matched,
  arg_max(start, matched * 1000000 - start)::INTEGER AS start
FROM judged
WHERE list_bool_or(list_transform(range(0, len(m) - width + 1), lambda s: list_sum(m[s + 1:s + width]) >= width - floor(width * 2 / 13)))
GROUP BY doc_id, item_id, n_items, item_tokens
"""

NEAR_DEDUP = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
), shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) END AS s FROM words
), told AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM shingled
), numbered AS (
  SELECT doc_id, n, shingle_no FROM told JOIN (
    SELECT shingle, row_number() OVER () AS shingle_no FROM told GROUP BY shingle HAVING count(*) > 1
  ) USING (shingle)
), linked AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM numbered a JOIN numbered b ON a.shingle_no = b.shingle_no AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM shingled JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON doc_id = a
"""


EMBEDDING_DEDUP = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
), told AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, (SELECT count(*) FROM linked WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN told ON vec_id = a
"""


FILL_IN_MIDDLE = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), cut AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
    array_to_string(u[greatest(c1, c2) + 1:n], '') AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
    AS output_sha256, sha256(t) AS restored_sha256
FROM cut
"""


SUFFIX_DEDUP = """
WITH docs AS (
  SELECT doc_id, encode(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents
), windows AS (
  SELECT doc_id, i, md5(h[i:i + 199]) AS k FROM (SELECT doc_id, h, unnest(range(1, n - 198)) AS i FROM docs)
), repeated AS (
  SELECT doc_id, i FROM windows JOIN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1) USING (k)
), begun AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 200 THEN 0 ELSE 1 END AS b FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), spans AS (
  SELECT doc_id, min(i) AS lo, max(i) + 199 AS hi FROM (SELECT doc_id, i, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM begun) GROUP BY doc_id, s
), gaps AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER w, 0) AS before, lead(lo) OVER w IS NULL AS final FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY lo)
), kept AS (
  SELECT doc_id, sum(hi - lo + 1) AS n_removed, count(*) AS n_spans,
    string_agg(hex(h[before + 1:lo - 1]), '' ORDER BY lo) || max(CASE WHEN final THEN hex(h[hi + 1:]) ELSE '' END) AS left_over
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(left_over, hex(h)))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


def urls(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), placed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(verdict, rule_host, rule_path) AS (VALUES {values}), fits AS (
  SELECT page_id, max_by(struct_pack(rule := rule_host || rule_path, verdict := verdict), len(rule_host || rule_path)) AS best
  FROM placed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT p.page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM placed p LEFT JOIN fits f ON p.page_id = f.page_id
"""


def _rounds(source: str, columns: str, seed: int) -> str:
    """A query that gives ``columns`` and the image ``p`` of ``source``'s ``p``."""
    sql = f"SELECT {columns}, n, a, b, p // b AS l, p % b AS r FROM {source}"
    for i, (k1, c1, k2, c2) in enumerate(round_keys(seed)):
        if i % 2 == 0:
            step = f"(l + (((r * {k1} + {c1}) % {P1}) * {k2} + {c2}) % {P2}) % a AS l, r"
        else:
            step = f"l, (r + (((l * {k1} + {c1}) % {P1}) * {k2} + {c2}) % {P2}) % b AS r"
        sql = f"SELECT {columns}, n, a, b, {step} FROM ({sql})"
    return f"SELECT {columns}, n, a, b, l * b + r AS p FROM ({sql})"


def shards(count: int, seed: int = 20240229) -> str:
    # the byte table T of the checksum: crc32 of the one byte i is T[i ^ 0xFF] ^ 0xFF000000
    by_byte = [zlib.crc32(bytes([i ^ 0xFF])) ^ 0xFF000000 for i in range(256)]
    return f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, x: xor(c >> 8, ({by_byte})[1 + (xor(c, x) & 255)])), 4294967295::BIGINT) AS text_crc32
  FROM documents
), whole AS (
  SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM documents
), numbered AS (
  SELECT s.*, n, a, (n + a - 1) // a AS b, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM sized s, whole
), walk AS (
  {_rounds("numbered", "doc_id, size, text_crc32", seed)}
  UNION ALL
  {_rounds("(SELECT * FROM walk WHERE p >= n)", "doc_id, size, text_crc32", seed)}
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (p % {count})::INTEGER AS shard, (p // {count})::BIGINT AS slot,
  NULL::INTEGER AS grown_shard
FROM walk WHERE p < n
"""
