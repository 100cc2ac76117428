"""Registered queries: toxicity, mixing and the audit of filters."""

from leadsieve.llm import filter_audit, mixing, toxicity
from leadsieve.llm.registry import oracle, query, table


@query
def op5_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


#: Shares of tokens by domain.
TARGETS = {"quality=1,toxic=0": 0.9, "quality=0,toxic=0": 0.08, "quality=1,toxic=1": 0.02}


@query
def op6_mixing(spark, sf):
    docs = table(spark, sf, "documents")
    return mixing.mix(docs, mixing.fit(docs, table(spark, sf, "labels")), TARGETS)


@query
def op11_filter_audit(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


oracle("op11_filter_audit", r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
    first_id AS (SELECT text, min(doc_id) AS least FROM t GROUP BY text),
    f AS (SELECT doc_id, part,
        len(words) < 100 AS "A", 100 * len(list_distinct(words)) < 80 * len(words) AS "B",
        100 * (length(w.text) - length(regexp_replace(w.text, '[A-Z]', '', 'g'))) > 10 * length(w.text) AS "C",
        regexp_matches(w.text, '[#$%&*|]') AS "D", doc_id IS DISTINCT FROM least AS "E"
        FROM w JOIN first_id USING (text)),
    l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
    m AS (SELECT f.part, "A"::INT + 2 * "B"::INT + 4 * "C"::INT + 8 * "D"::INT + 16 * "E"::INT AS mask, count(*) AS n,
        count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
    letter AS (SELECT unnest([0, 1, 2, 3, 4]) AS k),
    orders AS (SELECT '' AS filter_order, 0 AS used, 0 AS step, -1 AS k, 0 AS before
        UNION ALL SELECT filter_order || chr((65 + letter.k)::INT), used + (1 << letter.k), step + 1, letter.k, used
        FROM orders, letter WHERE used & (1 << letter.k) = 0),
    whole_orders AS (SELECT filter_order FROM orders WHERE step = 5),
    s AS (SELECT w.filter_order, o.step, o.k, o.before FROM whole_orders w JOIN orders o
        ON o.step > 0 AND left(w.filter_order, o.step) = o.filter_order),
    r AS (SELECT part, filter_order, step, k,
        sum(n) FILTER (mask & (before + (1 << k)) = 0) AS kept, sum(n) FILTER (mask & before = 0 AND mask & (1 << k) <> 0) AS removed,
        sum(n) FILTER (mask & before <> 0 AND mask & (1 << k) <> 0) AS redundant, sum(n) FILTER (mask = 1 << k) AS unique_fails,
        sum(good) FILTER (mask & before = 0 AND mask & (1 << k) <> 0) AS good_lost,
        sum(toxic) FILTER (mask & before = 0 AND mask & (1 << k) <> 0) AS toxic_lost
        FROM m, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    sum(coalesce(removed, 0)) OVER (PARTITION BY part, k)::BIGINT AS shapley
FROM r
""")
