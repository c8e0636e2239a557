"""SQL for DuckDB that gives the same rows as the queries, where SQL can express them."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)
), hit AS (
  SELECT DISTINCT doc_id, i + j AS p
  FROM (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY s) > 1),
       (SELECT unnest(range(0, 35)) AS j)
), kept AS (
  SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS kept, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d)
  ANTI JOIN hit USING (doc_id, p)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op3_warc_capture_index": r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), q AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM q
""",
    "op7_fm_index_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), found AS (
  SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, s)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op8_suffix_array_dedup": r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
), windows AS (
  SELECT doc_id, i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), 100)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d)
), hit AS (
  SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY s) < doc_id
), ends AS (
  SELECT doc_id, i AS a, i + 50 AS z, max(i + 50) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM hit
), runs AS (
  SELECT doc_id, run, min(a) AS a, max(z) AS z
  FROM (SELECT *, sum(CASE WHEN before IS NULL OR a > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a) AS run FROM ends)
  GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, list({'a': a, 'z': z} ORDER BY a) AS r FROM runs GROUP BY doc_id
), pieces AS (
  SELECT doc_id, n, r, CASE WHEN r IS NULL THEN h ELSE
    array_to_string(list_transform(range(0, len(r) + 1), lambda j:
      CASE WHEN j = len(r) THEN substr(h, CAST(2 * r[j].z + 1 AS BIGINT))
           WHEN j = 0 THEN substr(h, 1, CAST(2 * r[1].a AS BIGINT))
           ELSE substr(h, CAST(2 * r[j].z + 1 AS BIGINT), CAST(2 * (r[j + 1].a - r[j].z) AS BIGINT)) END), '') END AS kept
  FROM d LEFT JOIN gaps USING (doc_id)
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(list_sum(list_transform(r, lambda x: x.z - x.a)), 0) AS BIGINT) AS n_removed,
  CAST(coalesce(len(r), 0) AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM pieces
""",
    "op11_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), e AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM e
), g AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM g
""",
    "op13_phrase_automata": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(p) AS piece FROM d)
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), phrases AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 6) AS t(m) WHERE len(w) >= m)
), counts AS (
  SELECT lang, phrase, m, count(*) AS f FROM phrases GROUP BY lang, phrase, m HAVING count(*) >= 100
), candidates AS (
  SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1
), covers AS (
  SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(a) AS a
  FROM (SELECT lang, w, a, j, unnest(range(1, m - j + 2)) AS i FROM candidates, range(2, 5) AS t(j) WHERE j < m) GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN covers o ON c.lang = o.lang AND c.phrase = o.phrase WHERE o.a IS NULL OR 100 * o.a < 100 * c.a
), cuts AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, s.n, CAST(1000 AS HUGEINT) * k.a * s.n // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)) k
  JOIN counts x ON x.lang = k.lang AND x.phrase = k.head JOIN counts y ON y.lang = k.lang AND y.phrase = k.tail
  JOIN sizes s ON s.lang = k.lang
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k.k) = 1
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM cuts)
WHERE rank <= 2000
""",
}
