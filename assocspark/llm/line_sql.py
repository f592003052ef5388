"""Check SQL of line deduplication, written from its definition: every window against every earlier equal one."""

SQL = r"""
WITH d AS (SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS s FROM documents),
l AS (SELECT doc_id, s, i, len(regexp_extract_all(s[i], '[^\x20\x09-\x0D]+')) AS n FROM d, unnest(range(1, len(s) + 1)) AS t(i)),
w AS (SELECT doc_id, i, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto,
             sum(n) OVER (PARTITION BY doc_id ORDER BY i) - n AS before FROM l),
ahead AS (SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.i >= a.i
          WHERE b.upto - a.before >= 50 GROUP BY a.doc_id, a.i),
back AS (SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.i >= a.i
         WHERE b.upto - a.before >= 50 GROUP BY b.doc_id, b.i),
spans AS (SELECT doc_id, s, e FROM ahead UNION SELECT doc_id, s, e FROM back),
bodies AS (SELECT p.doc_id, p.s, p.e, array_to_string(list_slice(d.s, p.s, p.e), chr(10)) AS body, p.e - p.s AS size
           FROM spans p JOIN d USING (doc_id)),
placed AS (SELECT doc_id, s, e, first_value(doc_id) OVER f AS first_doc, first_value(e) OVER f AS first_end
           FROM bodies WINDOW f AS (PARTITION BY body, size ORDER BY doc_id, s)),
later AS (SELECT doc_id, s, e FROM placed WHERE doc_id <> first_doc OR s > first_end),
gone AS (SELECT DISTINCT w.doc_id, w.i FROM w JOIN later x ON w.doc_id = x.doc_id AND w.i BETWEEN x.s AND x.e),
marked AS (SELECT w.doc_id, w.i, gone.i IS NOT NULL AS out FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i),
runs AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked WHERE out),
named AS (SELECT doc_id, min(i) AS a, max(i) AS b FROM runs GROUP BY doc_id, g),
listed AS (SELECT doc_id, string_agg((a - 1)::VARCHAR || ':' || (b - 1)::VARCHAR, ',' ORDER BY a) AS removed FROM named GROUP BY doc_id),
kept AS (SELECT m.doc_id, count(*) AS n_lines, count(*) FILTER (out) AS n_removed,
                coalesce(string_agg(l.s[m.i], chr(10) ORDER BY m.i) FILTER (NOT out), '') AS body
         FROM marked m JOIN l ON m.doc_id = l.doc_id AND m.i = l.i GROUP BY m.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, coalesce(x.removed, '') AS removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(k.body) END AS text_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN listed x ON d.doc_id = x.doc_id
"""
