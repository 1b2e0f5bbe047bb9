"""SQL of the pN_ queries that SQL can state."""

_SECTION_TERMS = """
WITH s AS (SELECT DISTINCT doc_id, section_id, entities, tags FROM sections),
total AS (SELECT count(*) AS n FROM (SELECT DISTINCT doc_id, section_id FROM sections)),
v AS (SELECT doc_id, section_id, 'entities' AS field_name, unnest(entities) AS raw FROM s
      UNION ALL SELECT doc_id, section_id, 'tags', unnest(tags) FROM s),
t AS (SELECT doc_id, section_id, field_name, trim(regexp_replace(lower(raw), '\\s+', ' ', 'g')) AS term FROM v WHERE raw IS NOT NULL),
f AS (SELECT field_name, term, count(*) AS n_occurrences, count(DISTINCT (doc_id, section_id)) AS n_records
      FROM t WHERE term <> '' GROUP BY ALL),
m AS (SELECT f.*, CASE WHEN n_records < 3 THEN 'rare' WHEN n_records > 0.1 * (SELECT n FROM total) THEN 'common' END AS mark FROM f)
"""

_PAGE_TERMS = """
WITH b AS (SELECT DISTINCT doc_id, block_id, text FROM blocks
           WHERE content_type IN ('paragraph', 'list', 'blockquote', 'definition') AND text IS NOT NULL),
w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM b),
v AS (SELECT doc_id, section_id, 'entity' AS kind, unnest(entities) AS raw FROM sections
      UNION ALL SELECT doc_id, section_id, 'tag', unnest(tags) FROM sections),
u AS (SELECT DISTINCT doc_id, section_id, kind, trim(regexp_replace(lower(raw), '\\s+', ' ', 'g')) AS term FROM v WHERE raw IS NOT NULL),
c AS (SELECT doc_id, 'word' AS kind, term, count(*) AS tf FROM w GROUP BY ALL
      UNION ALL SELECT doc_id, kind, term, count(*) FROM u WHERE term <> '' GROUP BY ALL),
s AS (SELECT kind, term, count(*) AS n_pages, sum(tf) AS cf FROM c GROUP BY ALL),
t AS (SELECT kind, sum(tf) AS total FROM c GROUP BY ALL),
l AS (SELECT doc_id, kind, sum(tf) AS length FROM c GROUP BY ALL),
p AS (SELECT c.doc_id, c.kind, c.term, c.tf, s.n_pages, s.cf / t.total AS pc, (c.tf + 2000.0 * s.cf / t.total) / (l.length + 2000.0) AS pd
      FROM c JOIN s USING (kind, term) JOIN t USING (kind) JOIN l USING (doc_id, kind))
"""

_BIGRAMS = """
WITH s AS (SELECT DISTINCT doc_id, section_id, entities, tags FROM sections),
r AS (SELECT row_number() OVER () AS rec, field_name, list_filter(list_transform(list_filter(vals, lambda x: x IS NOT NULL), lambda x: trim(regexp_replace(lower(x), '\\s+', ' ', 'g'))), lambda x: x <> '') AS v
      FROM (SELECT 'entities' AS field_name, entities AS vals FROM s UNION ALL SELECT 'tags', tags FROM s)),
g AS (SELECT rec, field_name, unnest(list_transform(v[1:len(v) - 1], lambda x, i: x || '␟' || v[i + 1])) AS term FROM r WHERE len(v) > 1)
SELECT field_name, term, count(*) AS n_occurrences, count(DISTINCT rec) AS n_records FROM g GROUP BY ALL
"""

_NGRAMS = """
WITH s AS (SELECT DISTINCT doc_id, section_id, entities, tags FROM sections),
r AS (SELECT row_number() OVER () AS rec, field_name, list_filter(list_transform(list_filter(vals, lambda x: x IS NOT NULL), lambda x: trim(regexp_replace(lower(x), '\\s+', ' ', 'g'))), lambda x: x <> '') AS v
      FROM (SELECT 'entities' AS field_name, entities AS vals FROM s UNION ALL SELECT 'tags', tags FROM s)),
i AS (SELECT rec, field_name, v, unnest(range(1, len(v) + 1)) AS a FROM r WHERE len(v) > 0),
g AS (SELECT rec, field_name, v, a, unnest(range(1, len(v) - a + 2)) AS n FROM i)
SELECT field_name, n::INTEGER AS n, array_to_string(v[a:a + n - 1], '␟') AS term, count(*) AS n_occurrences, count(DISTINCT rec) AS n_records FROM g GROUP BY ALL
"""

_EXACT_LINES = """
WITH b AS (SELECT DISTINCT doc_id, block_id, coalesce(space, '') AS space, text FROM blocks WHERE content_type IN ('paragraph', 'list', 'blockquote', 'definition') AND length(text) > 0),
l AS (SELECT doc_id, block_id, space, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line FROM b),
w AS (SELECT doc_id, block_id, space, line_no, trim(regexp_replace(trim(regexp_replace(regexp_replace(lower(line), '\\d[\\d./:,-]*', ' 0 ', 'g'), '[^\\p{L}\\p{M}0]+', ' ', 'g')) || ' ', '( 0){2,} ', ' 0 ', 'g')) AS words FROM l),
p AS (SELECT coalesce(space, '') AS space, count(DISTINCT doc_id) AS n_space FROM blocks GROUP BY 1),
s AS (SELECT space, words FROM w JOIN p USING (space) WHERE len(string_split(words, ' ')) >= 3 GROUP BY space, words, n_space HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) >= 0.2 * n_space)
SELECT DISTINCT doc_id, block_id, line_no FROM w JOIN s USING (space, words)
"""

_EXACT_TEXTS = """
WITH x AS (SELECT 'section' AS rec_kind, doc_id, section_id AS rec_id, title AS text FROM sections UNION ALL SELECT 'block', doc_id, block_id, text FROM blocks WHERE content_type IS DISTINCT FROM 'code')
SELECT DISTINCT rec_kind, doc_id, rec_id FROM x WHERE lower(trim(text)) IN ('todo', 'tbd', 'lorem ipsum', 'untitled', 'untitled section', '[tbd]', '[...]', '...', '{{title}}')
"""

ORACLE = {
    "p1_exact_lines": _EXACT_LINES,
    "p2_exact_texts": _EXACT_TEXTS,
    "p4_document_counts": "SELECT source, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM documents WHERE regexp_matches(text, '\\p{L}') GROUP BY source",
    "p6_entities": "SELECT DISTINCT doc_id, block_id FROM blocks WHERE content_type IS DISTINCT FROM 'code' AND regexp_matches(regexp_replace(text, '`[^`\\n]+`', '', 'g'), '&(?:nbsp|amp|lt|gt|quot|mdash|ndash|hellip);')",
    "p7_checks": "SELECT limit_name, (SELECT count(*) FROM documents WHERE length(text) > 0) AS n_docs, 0 AS n_broken, 0 AS n_cut, 0 AS n_over FROM size_limits WHERE limit_name LIKE 'pack%'",
    "p8_whole_leaks": """WITH d AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ' AS t FROM documents), g AS (SELECT item_id, ' ' || trim(regexp_replace(lower(passage), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ' AS p FROM golden_items)
SELECT doc_id, item_id FROM d, g WHERE contains(t, p)""",
    # The tables' description: apart from oversized ones, no document is longer than 4,500 characters.
    "p9_found": "SELECT doc_id FROM documents WHERE length(text) > 4500",
    "p9_checks": "SELECT source, count(*) AS n_docs, 0 AS n_broken, 0 AS n_over, 0 AS n_overlap FROM documents WHERE length(text) > 4500 GROUP BY source",
    "p3_ngram_frequencies": _NGRAMS,
    "p3_bigram_frequencies": _BIGRAMS,
    "p5_found": _PAGE_TERMS + "SELECT doc_id, kind, term FROM p WHERE n_pages <= 3 AND tf >= CASE kind WHEN 'word' THEN 4 ELSE 2 END",
    "p5_term_scores": _PAGE_TERMS + "SELECT doc_id, kind, term, tf, n_pages, round(pd * ln(pd / pc), 9) AS score FROM p",
    "p3_found": _SECTION_TERMS + "SELECT field_name, term, mark FROM m WHERE mark IS NOT NULL",
    "p3_term_frequencies": _SECTION_TERMS + "SELECT field_name, term, n_occurrences, n_records, mark FROM m",
}
