"""Registered queries: exact, line and near-duplicate removal, spelling variants."""

from leadsieve.llm import exact_dedup, line_dedup, ngram_join, simhash, spelling
from leadsieve.llm.registry import oracle, query, table


@query
def op10_exact_dedup(spark, sf):
    return exact_dedup.deduplicate(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


oracle("op10_exact_dedup", r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER w = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")


@query
def op8_ngram_join(spark, sf):
    return ngram_join.link(table(spark, sf, "documents")).drop("print")


@query
def op4_line_dedup(spark, sf):
    return line_dedup.deduplicate_lines(table(spark, sf, "documents"))


oracle("op4_line_dedup", """
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, lines, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM t),
    n AS (SELECT doc_id, pos, line, sum(CASE WHEN line = '' THEN 0 ELSE length(line) - length(replace(line, ' ', '')) + 1 END)
        OVER (PARTITION BY doc_id ORDER BY pos) AS words FROM l),
    s AS (SELECT doc_id, pos, 1 << k AS size, md5(array_to_string(lines[pos:pos + (1 << k) - 1], chr(10))) AS start
        FROM l, (SELECT unnest(range(0, 20)) AS k) WHERE pos + (1 << k) - 1 <= len(lines)),
    f AS (SELECT *, first_value(doc_id) OVER w AS f_id, first_value(pos) OVER w AS f_pos FROM s
        WINDOW w AS (PARTITION BY size, start ORDER BY doc_id, pos)),
    g AS (SELECT *, pos - row_number() OVER (PARTITION BY size, doc_id, f_id, pos - f_pos ORDER BY pos) AS run FROM f
        WHERE (f_id, f_pos) <> (doc_id, pos)),
    r AS (SELECT doc_id, min(pos) AS a, max(pos) + size - 1 AS b FROM g GROUP BY size, doc_id, f_id, pos - f_pos, run),
    m AS (SELECT r.*, y.words - coalesce(x.words, 0) AS words FROM r JOIN n y ON y.doc_id = r.doc_id AND y.pos = r.b
        LEFT JOIN n x ON x.doc_id = r.doc_id AND x.pos = r.a - 1),
    c AS (SELECT doc_id FROM t QUALIFY row_number() OVER (PARTITION BY lines ORDER BY doc_id) > 1),
    w AS (SELECT doc_id, max(words) AS words FROM n GROUP BY doc_id),
    d AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS pos FROM m WHERE words >= 8
        UNION SELECT doc_id, pos FROM n WHERE doc_id IN (SELECT doc_id FROM c JOIN w USING (doc_id) WHERE words >= 8))
SELECT n.doc_id, count(*) AS n_lines, count(d.pos) AS n_deleted,
    coalesce(string_agg(line, chr(10) ORDER BY n.pos) FILTER (d.pos IS NULL), '') AS text
FROM n LEFT JOIN d ON d.doc_id = n.doc_id AND d.pos = n.pos GROUP BY n.doc_id
""")


@query
def op12_spelling_variants(spark, sf):
    return spelling.group_variants(table(spark, sf, "documents"))


@query
def op13_simhash(spark, sf):
    return simhash.group_near(table(spark, sf, "documents"))
