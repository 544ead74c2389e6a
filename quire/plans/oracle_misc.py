"""DuckDB twins of scans, selections, topic scoring, related articles and token stats."""

from quire.plans.oracle import ARTICLES_CTE

SETTLED = """ev AS (SELECT *, cast(user_id AS varchar) || '/' || event_type AS pid FROM events),
done AS (SELECT DISTINCT pid FROM ev WHERE ts < timestamp '2024-01-02 00:00:00'),
q AS (SELECT pid FROM ev WHERE ts < timestamp '2024-01-04 12:00:00' - INTERVAL 30 MINUTE
      AND pid NOT IN (SELECT pid FROM done))"""

TOK = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"

ORACLE_MISC = {
    "q_day_scan": """WITH t AS (SELECT count(*) AS total FROM events WHERE cast(ts AS date) = date '2024-01-02')
SELECT event_id, ts, user_id, total FROM events, t WHERE cast(ts AS date) = date '2024-01-02'
ORDER BY ts, event_id LIMIT 1000""",
    "q_date_range": """SELECT event_id, ts, event_type, count(*) OVER () AS total FROM events
WHERE cast(ts AS date) BETWEEN date '2024-01-03' AND date '2024-01-05'""",
    "q_settled_new": "WITH " + SETTLED + """
SELECT event_id, pid, ts FROM ev WHERE pid IN (SELECT pid FROM q)""",
    "q_settled_reference": "WITH " + SETTLED + """
SELECT ev.pid, count(*) AS n_rows FROM ev JOIN q ON ev.pid = q.pid GROUP BY ev.pid""",
    "q_projection_defaults": f"""WITH {ARTICLES_CTE}
SELECT a.pid, a.dt, a.h1,
       CASE WHEN a.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 1 ELSE 0 END AS focus,
       a.extender, a.attachments, a.category FROM articles a""",
    "q_exclude_regex": f"WITH {ARTICLES_CTE} SELECT pid FROM articles WHERE NOT regexp_matches(article, '^(Der|Le) ')",
    "q_topic_score": """WITH li AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
o AS (SELECT o.o_custkey AS tno, o.o_orderkey AS pid, cast(o.o_orderdate AS date) AS published_dt,
             coalesce(li.n, 0) AS extender FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey),
c AS (SELECT tno, published_dt, count(*) AS date_count FROM o GROUP BY tno, published_dt),
r AS (SELECT tno, published_dt,
        count(*) OVER (PARTITION BY tno)
        - (row_number() OVER (PARTITION BY tno ORDER BY date_count DESC, published_dt) - 1) AS date_weight FROM c),
s AS (SELECT o.tno, o.pid, r.date_weight, cast(o.extender AS double) * 1.5 + r.date_weight AS score
      FROM o JOIN r ON o.tno = r.tno AND o.published_dt = r.published_dt),
m AS (SELECT tno, max(score) AS mx FROM s GROUP BY tno)
SELECT s.tno, s.pid, s.date_weight, round(s.score, 6) AS score FROM s JOIN m ON s.tno = m.tno WHERE s.score > m.mx / 2""",
    "q_related": f"""WITH {ARTICLES_CTE},
pool AS (SELECT a.doc_id, a.pid, a.category, e.embedding FROM articles a JOIN embeddings e ON a.doc_id = e.vec_id),
cur AS (SELECT * FROM pool WHERE category <> 'src0'),
todo AS (SELECT * FROM cur WHERE pid NOT IN (SELECT cast(doc_id AS varchar) FROM labels WHERE quality = 1)),
sims AS (SELECT t.pid, p.doc_id AS b, p.category, p.pid AS bpid,
           list_cosine_similarity(cast(t.embedding AS DOUBLE[]), cast(p.embedding AS DOUBLE[])) AS sim
         FROM todo t JOIN pool p ON t.doc_id <> p.doc_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY sim DESC, b) AS rank FROM sims WHERE sim > 0.3)
SELECT pid, cast(rank AS integer) AS rank, 'None/' || bpid AS related_url, round(sim, 6) AS sim FROM rk WHERE rank <= 3""",
    "q_related_reference": f"""WITH {ARTICLES_CTE},
pool AS (SELECT a.doc_id, a.pid, a.category, e.embedding FROM articles a JOIN embeddings e ON a.doc_id = e.vec_id),
cur AS (SELECT * FROM pool WHERE category <> 'src0'),
todo AS (SELECT * FROM cur WHERE pid NOT IN (SELECT cast(doc_id AS varchar) FROM labels WHERE quality = 1)),
sims AS (SELECT t.pid, p.doc_id AS b, p.pid AS bpid,
           list_cosine_similarity(cast(t.embedding AS DOUBLE[]), cast(p.embedding AS DOUBLE[])) AS sim
         FROM todo t CROSS JOIN pool p),
cs AS (SELECT *, CASE WHEN sim > 0.3 THEN sim ELSE 0.0 END AS csim FROM sims),
rk AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY csim DESC, b) AS rank FROM cs)
SELECT pid, cast(rank AS integer) AS rank, 'None/' || bpid AS related_url, round(csim, 6) AS sim
FROM rk WHERE rank BETWEEN 2 AND 4""",
    "q_token_stats": f"""SELECT source, count(*) AS docs, sum(len({TOK})) AS tokens, max(len({TOK})) AS max_tokens
FROM documents GROUP BY source""",
}
