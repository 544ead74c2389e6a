"""DuckDB SQL twins of the registered queries (same column names)."""

ARTICLES_CTE = """
articles AS (
  SELECT cast(d.doc_id AS varchar) AS pid,
         timestamp '2024-01-01 00:00:00' + to_minutes(d.doc_id) AS dt,
         split_part(d.text, chr(10), 1) AS h1,
         d.text AS article, d.text AS text,
         cast(coalesce(l.quality, 0) AS integer) AS focus,
         cast(d.n_chars % 3 AS integer) AS extender,
         cast(d.n_chars % 5 AS integer) AS attachments,
         d.source AS category, d.doc_id
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _kw_count(col: str, kws) -> str:
    return "(" + " + ".join(f"len(regexp_extract_all({col}, '{k}'))" for k in kws) + ")"


KW = ["the", "que", "der"]
KW_SQL = f"""
tagged AS (
  SELECT *, cast(2 * {_kw_count('h1', KW)} + {_kw_count('text', KW)} AS bigint) AS in_keywords,
         array_to_string(list_sort(list_filter({KW!r}, lambda k: regexp_matches(text, k))), '|') AS keywords_tag
  FROM articles)"""

SCORED_SQL = f"""WITH {ARTICLES_CTE}, {KW_SQL},
pos AS (SELECT *, row_number() OVER (ORDER BY dt, pid) - 1 AS position FROM tagged),
scored AS (
  SELECT *, ln(1 + position) AS ps,
         in_keywords * 0.2 + focus * 0.4 + extender * 0.15 + attachments * 0.15 + ln(1 + position) * 0.05 AS sc
  FROM pos)
"""

ORACLE = {
    "q_keyword_score": f"WITH {ARTICLES_CTE}, {KW_SQL} SELECT pid, in_keywords, keywords_tag FROM tagged",
    "q_article_score": SCORED_SQL + """
SELECT pid, in_keywords, keywords_tag, position, round(ps, 6) AS position_score, round(sc, 6) AS sort_cri
FROM scored""",
    "q_article_top": SCORED_SQL + """
SELECT pid, round(sc, 6) AS sort_cri FROM scored ORDER BY round(sc, 6) DESC, pid LIMIT 20""",
}


def _pairs(src: str, idc: str, vec: str) -> str:
    return f"""pairs AS (
  SELECT x.{idc} AS a, y.{idc} AS b,
         list_distance(cast(x.{vec} AS DOUBLE[]), cast(y.{vec} AS DOUBLE[])) AS dist
  FROM {src} x JOIN {src} y ON x.{idc} < y.{idc})"""


NN_SQL = """nn AS (
  SELECT id, min(dist) AS nn_dist FROM (
    SELECT a AS id, dist FROM pairs UNION ALL SELECT b AS id, dist FROM pairs) t GROUP BY id)"""


def _eps_sql(high: float, low: float) -> str:
    # lower bound raised by repeated 0.01 additions while the smallest distance is inside the band
    return f"""steps(k, f) AS (SELECT 0, cast({low} AS DOUBLE) UNION ALL SELECT k + 1, f + 0.01 FROM steps WHERE k < 499),
dmin AS (SELECT min(nn_dist) AS m FROM nn),
fl AS (SELECT CASE WHEN m > {low} AND m < {high} THEN (SELECT min(f) FROM steps WHERE f >= m)
                   ELSE cast({low} AS DOUBLE) END AS lo FROM dmin),
vals AS (
  SELECT DISTINCT nn_dist AS d FROM nn WHERE nn_dist > (SELECT lo FROM fl) AND nn_dist < {high}
  UNION ALL SELECT max(nn_dist) FROM nn WHERE nn_dist <= (SELECT lo FROM fl)),
ordered AS (SELECT d, lead(d) OVER (ORDER BY d DESC) AS next_d FROM vals),
drops AS (SELECT d, next_d, d - next_d AS drop FROM ordered WHERE d > (SELECT lo FROM fl) AND d < {high}),
eps AS (SELECT d AS eps FROM drops ORDER BY drop DESC, d DESC LIMIT 1)"""


def _components_sql(edge_filter: str, prefix: str = "") -> str:
    """CTEs ending in {prefix}comp(node, root): smallest reachable node id."""
    return f"""{prefix}e AS (SELECT a, b FROM pairs WHERE {edge_filter}
              UNION ALL SELECT b, a FROM pairs WHERE {edge_filter}),
{prefix}reach(node, root) AS (SELECT a, a FROM {prefix}e
              UNION SELECT {prefix}e.b, r.root FROM {prefix}reach r JOIN {prefix}e ON r.node = {prefix}e.a),
{prefix}comp AS (SELECT node, min(root) AS root FROM {prefix}reach GROUP BY node),
{prefix}lab AS (SELECT root, cast(dense_rank() OVER (ORDER BY root) - 1 AS integer) AS cluster
              FROM (SELECT DISTINCT root FROM {prefix}comp) t)"""


def _dbscan_select(src: str, idc: str, prefix: str = "") -> str:
    return f"""SELECT x.{idc}, coalesce(l.cluster, -1) AS cluster FROM {src} x
LEFT JOIN {prefix}comp c ON x.{idc} = c.node LEFT JOIN {prefix}lab l ON c.root = l.root"""


EMB_PAIRS = _pairs("embeddings", "vec_id", "embedding")

ORACLE.update({
    "q_nn_distance": f"WITH {EMB_PAIRS}, {NN_SQL} SELECT id AS vec_id, round(nn_dist, 6) AS nn_dist FROM nn",
    "q_edges": f"WITH {EMB_PAIRS} SELECT a, b, round(dist, 6) AS dist FROM pairs WHERE dist <= 1.1",
    "q_eps": f"""WITH RECURSIVE {EMB_PAIRS}, {NN_SQL}, {_eps_sql(1.2, 1.0)}
SELECT round(d, 6) AS d, round(next_d, 6) AS next_d, round(drop, 6) AS drop,
       d = (SELECT eps FROM eps) AS chosen FROM drops""",
    "q_dbscan": f"WITH RECURSIVE {EMB_PAIRS}, {_components_sql('dist <= 1.05')} "
                + _dbscan_select("embeddings", "vec_id"),
    "q_dbscan_auto": f"WITH RECURSIVE {EMB_PAIRS}, {NN_SQL}, {_eps_sql(1.2, 1.0)}, "
                     f"{_components_sql('dist <= (SELECT eps FROM eps)')} "
                     + _dbscan_select("embeddings", "vec_id"),
    "q_dbscan_two_stage": f"""WITH RECURSIVE {EMB_PAIRS}, {_components_sql('dist <= 1.1')},
s1 AS ({_dbscan_select("embeddings", "vec_id")}),
pairs2 AS (SELECT p.a, p.b, p.dist FROM pairs p JOIN s1 sa ON p.a = sa.vec_id JOIN s1 sb ON p.b = sb.vec_id
           WHERE sa.cluster = sb.cluster AND sa.cluster >= 0 AND p.dist <= 1.05),
e2 AS (SELECT a, b FROM pairs2 UNION ALL SELECT b, a FROM pairs2),
reach2(node, root) AS (SELECT a, a FROM e2 UNION SELECT e2.b, r.root FROM reach2 r JOIN e2 ON r.node = e2.a),
comp2 AS (SELECT node, min(root) AS root FROM reach2 GROUP BY node),
lab2 AS (SELECT c.node, cast(dense_rank() OVER (PARTITION BY s.cluster ORDER BY c.root) - 1 AS integer) AS cluster2
         FROM comp2 c JOIN s1 s ON c.node = s.vec_id)
SELECT s1.vec_id, s1.cluster,
       CASE WHEN s1.cluster >= 0 THEN coalesce(lab2.cluster2, -1) END AS cluster2
FROM s1 LEFT JOIN lab2 ON s1.vec_id = lab2.node""",
    "q_dbscan_minpts": f"""WITH RECURSIVE {EMB_PAIRS},
e AS (SELECT a, b FROM pairs WHERE dist <= 1.1 UNION ALL SELECT b, a FROM pairs WHERE dist <= 1.1),
deg AS (SELECT a AS n, count(*) AS deg FROM e GROUP BY a),
core AS (SELECT n FROM deg WHERE deg + 1 >= 3),
ce AS (SELECT e.a, e.b FROM e JOIN core c1 ON e.a = c1.n JOIN core c2 ON e.b = c2.n),
reach(node, root) AS (SELECT n, n FROM core UNION SELECT ce.b, r.root FROM reach r JOIN ce ON r.node = ce.a),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
lab AS (SELECT root, cast(dense_rank() OVER (ORDER BY root) - 1 AS integer) AS cluster
        FROM (SELECT DISTINCT root FROM comp) t),
corelab AS (SELECT c.node, l.cluster FROM comp c JOIN lab l ON c.root = l.root),
border AS (SELECT e.a AS node, min(cl.cluster) AS cluster FROM e JOIN corelab cl ON e.b = cl.node
           WHERE e.a NOT IN (SELECT n FROM core) GROUP BY e.a),
alllab AS (SELECT * FROM corelab UNION ALL SELECT * FROM border)
SELECT x.vec_id, coalesce(a.cluster, -1) AS cluster FROM embeddings x LEFT JOIN alllab a ON x.vec_id = a.node""",
})

GROUPED_PAIRS = """pairs AS (
  SELECT x.vec_id AS a, y.vec_id AS b,
         list_distance(cast(x.embedding AS DOUBLE[]), cast(y.embedding AS DOUBLE[])) AS dist
  FROM g x JOIN g y ON x.vec_id < y.vec_id AND x.source = y.source)"""

ORACLE["q_dbscan_grouped"] = (
    "WITH RECURSIVE g AS (SELECT e.vec_id, e.embedding, d.source FROM embeddings e "
    "JOIN documents d ON e.vec_id = d.doc_id), " + GROUPED_PAIRS + ", " + _components_sql("dist <= 1.1")
    + " SELECT x.vec_id, x.source, coalesce(l.cluster, -1) AS cluster FROM g x "
      "LEFT JOIN comp c ON x.vec_id = c.node LEFT JOIN lab l ON c.root = l.root")

# The digest chain on articles with embeddings.
def _digest_cte(eps_ctes: str, eps_expr: str) -> str:
    return f"""{ARTICLES_CTE},
art AS (SELECT a.*, e.embedding AS embeddings FROM articles a LEFT JOIN embeddings e ON a.doc_id = e.vec_id
        WHERE NOT regexp_matches(a.article, '^(Der|Le) ')),
{KW_SQL.replace('FROM articles', 'FROM art')},
posd AS (SELECT *, row_number() OVER (ORDER BY dt, pid) - 1 AS position FROM tagged),
{_pairs('posd', 'position', 'embeddings')}, {eps_ctes}
{_components_sql('dist <= ' + eps_expr)},
clus AS (SELECT p.*, coalesce(l.cluster, -1) AS cluster FROM posd p
         LEFT JOIN comp c ON p.position = c.node LEFT JOIN lab l ON c.root = l.root),
scored AS (SELECT *, in_keywords * 0.2 + focus * 0.4 + extender * 0.15 + attachments * 0.15
                     + ln(1 + position) * 0.05 AS sort_cri FROM clus),
groups AS (SELECT cluster, sum(sort_cri) AS total, max(sort_cri) AS top FROM scored
           WHERE cluster > -1 GROUP BY cluster),
kept AS (SELECT *, row_number() OVER (ORDER BY total DESC, top DESC, cluster) - 1 AS group_rank
         FROM groups WHERE total > (SELECT quantile_cont(total, 0.2) FROM groups))"""



DIGEST_CTE = _digest_cte(f"{NN_SQL}, {_eps_sql(1.2, 1.0)},", "(SELECT eps FROM eps)")
DIGEST_CTE_FIXED = _digest_cte("", "1.1")

ORACLE.update({
    "q_cluster_articles": f"""WITH RECURSIVE {DIGEST_CTE}
SELECT pid, position, cluster, in_keywords, round(sort_cri, 6) AS sort_cri FROM scored""",
    "q_cluster_rank": f"""WITH RECURSIVE {DIGEST_CTE}
SELECT cluster, round(total, 6) AS total, round(top, 6) AS top, group_rank FROM kept""",
    "q_cluster_pick": f"""WITH RECURSIVE {DIGEST_CTE},
g AS (SELECT s.cluster, k.group_rank, s.pid,
             row_number() OVER (PARTITION BY s.cluster ORDER BY s.sort_cri DESC, s.pid) AS in_rank,
             count(*) OVER (PARTITION BY s.cluster) AS size
      FROM scored s JOIN kept k ON s.cluster = k.cluster)
SELECT * FROM g WHERE in_rank <= CASE WHEN size < 4 THEN size ELSE floor(size / 2) END""",
})


# ---- search --------------------------------------------------------------
TOK = "regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+')"


def _tok(c: str) -> str:
    return TOK.format(c=c)


def _tf(tok: str, t: str) -> str:
    return f"len(list_filter({tok}, lambda x: x = '{t}'))"


def _idf(nt: str) -> str:
    return f"ln(1 + (s.n - {nt} + 0.5) / ({nt} + 0.5))"


def _bm25(tok: str, terms, prefix: str, boost: float = 1.0) -> str:
    parts = []
    for i, t in enumerate(sorted(set(terms))):
        tf = _tf(tok, t)
        parts.append(f"({_idf(f's.{prefix}{i}')} * {boost}) * ({tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * len({tok}) / s.avgdl)))")
    return "(" + " + ".join(parts) + ")"


def _df_aggs(tok: str, terms, prefix: str) -> str:
    return ", ".join(f"sum(CASE WHEN list_contains({tok}, '{t}') THEN 1 ELSE 0 END) AS {prefix}{i}"
                     for i, t in enumerate(sorted(set(terms))))


QVEC = "(SELECT cast(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))"
COS = f"(list_cosine_similarity(cast(embedding AS DOUBLE[]), {QVEC}) + 1.0)"
VDOCS = "(SELECT d.doc_id, e.embedding, d.text, d.lang, d.source, d.n_chars FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id)"
USABLE = "embedding IS NOT NULL AND len(embedding) > 0"

MQ = ["the", "elle", "und"]
_mt = _tok("text")
ORACLE.update({
    "q_match": f"""WITH d AS (SELECT doc_id, {_mt} AS tok FROM documents),
s AS (SELECT count(*) AS n, avg(len(tok)) AS avgdl, {_df_aggs('tok', MQ, 'df')} FROM d),
sc AS (SELECT doc_id, {_bm25('tok', MQ, 'df')} AS score FROM d, s
       WHERE len(list_intersect(tok, {sorted(set(MQ))!r})) > 0),
tot AS (SELECT count(*) AS total FROM sc)
SELECT doc_id, round(score, 6) AS score, total FROM sc, tot ORDER BY score DESC, doc_id LIMIT 10""",
    "q_term": """WITH s AS (SELECT count(*) AS n, sum(CASE WHEN source = 'src1' THEN 1 ELSE 0 END) AS vc FROM documents)
SELECT doc_id, round(ln(1 + (s.n - s.vc + 0.5) / (s.vc + 0.5)), 6) AS score FROM documents, s
WHERE source = 'src1' ORDER BY score DESC, doc_id LIMIT 10""",
    "q_vector": f"""SELECT vec_id, round({COS}, 6) AS score FROM embeddings WHERE {USABLE}
ORDER BY {COS} DESC, vec_id LIMIT 10""",
    "q_vector_term": f"""WITH v AS {VDOCS},
s AS (SELECT count(*) AS n, sum(CASE WHEN source = 'src2' THEN 1 ELSE 0 END) AS vc FROM v),
sc AS (SELECT doc_id, ln(1 + (s.n - s.vc + 0.5) / (s.vc + 0.5)) + {COS} AS score FROM v, s
       WHERE {USABLE} AND source = 'src2')
SELECT doc_id, round(score, 6) AS score FROM sc ORDER BY score DESC, doc_id LIMIT 10""",
})

ORACLE["q_index_search"] = ORACLE["q_match"]

_FILTER_SQL = f"""lang IN ('en', 'fr') AND n_chars >= 200 AND n_chars <= 5000
  AND (len(list_intersect({_mt}, ['elle'])) > 0 OR len(list_intersect({_mt}, ['the'])) > 0
       OR contains(' ' || array_to_string({_mt}, ' ') || ' ', ' of the '))"""

HK1, HK2, HM = ["the"], ["elle"], ["de"]
HK3 = ["und", "die"]
ORACLE.update({
    "q_filter_spec": f"SELECT doc_id, lang, n_chars FROM documents WHERE {_FILTER_SQL}",
    "q_vector_filtered": f"""WITH v AS {VDOCS}
SELECT doc_id, round({COS}, 6) AS score FROM v WHERE {USABLE} AND {_FILTER_SQL}
ORDER BY {COS} DESC, doc_id LIMIT 20""",
    "q_hybrid": f"""WITH v AS (SELECT *, {_mt} AS tok FROM {VDOCS}),
s AS (SELECT count(*) AS n, avg(len(tok)) AS avgdl, {_df_aggs('tok', HK1 + HK2 + HK3 + HM, 'df')} FROM v),
sc AS (SELECT doc_id,
  {COS} + {_bm25('tok', HM, 'dfm')} + 1.0
  + {_bm25('tok', HK1, 'dfa', 2.0)} + {_bm25('tok', HK2, 'dfb', 2.0)} + {_bm25('tok', HK3, 'dfc', 0.5)} AS score
  FROM v, (SELECT n, avgdl, {", ".join(f"df{sorted(set(HK1 + HK2 + HK3 + HM)).index(t)} AS {p}{i}" for p, ts in (("dfm", HM), ("dfa", HK1), ("dfb", HK2), ("dfc", HK3)) for i, t in enumerate(sorted(set(ts))))} FROM s) s
  WHERE {USABLE} AND n_chars >= 100 AND len(list_intersect(tok, ['de'])) > 0)
SELECT doc_id, round(score, 6) AS score FROM sc ORDER BY score DESC, doc_id LIMIT 10""",
})

from quire.plans.oracle_text import ORACLE_TEXT  # noqa: E402

ORACLE.update(ORACLE_TEXT)

from quire.plans.oracle_misc import ORACLE_MISC  # noqa: E402

ORACLE.update(ORACLE_MISC)

from quire.plans.oracle_enrich import ORACLE_ENRICH  # noqa: E402

ORACLE.update(ORACLE_ENRICH)

from quire.plans.oracle_digest import ORACLE_DIGEST  # noqa: E402

ORACLE.update(ORACLE_DIGEST)

from quire.plans.oracle_io import ORACLE_IO  # noqa: E402

ORACLE.update(ORACLE_IO)


ORACLE.update({
    "q_cluster_rank_fixed": ORACLE["q_cluster_rank"].replace(DIGEST_CTE, DIGEST_CTE_FIXED),
    "q_cluster_pick_fixed": ORACLE["q_cluster_pick"].replace(DIGEST_CTE, DIGEST_CTE_FIXED),
})


# The ranking chain per source: neighbours and eps inside each source.
GROUPED_DIGEST = f"""{ARTICLES_CTE},
art AS (SELECT a.*, e.embedding AS embeddings FROM articles a LEFT JOIN embeddings e ON a.doc_id = e.vec_id
        WHERE NOT regexp_matches(a.article, '^(Der|Le) ')),
{KW_SQL.replace('FROM articles', 'FROM art')},
posd AS (SELECT *, row_number() OVER (ORDER BY dt, pid) - 1 AS position, row_number() OVER (PARTITION BY category ORDER BY dt, pid) - 1 AS gpos FROM tagged),
pairs AS (
  SELECT x.position AS a, y.position AS b, x.category,
         list_distance(cast(x.embeddings AS DOUBLE[]), cast(y.embeddings AS DOUBLE[])) AS dist
  FROM posd x JOIN posd y ON x.position < y.position AND x.category = y.category),
nn AS (SELECT id, category, min(dist) AS nn_dist FROM (
         SELECT a AS id, category, dist FROM pairs UNION ALL SELECT b AS id, category, dist FROM pairs) t
       GROUP BY id, category),
steps(k, f) AS (SELECT 0, cast(1.0 AS DOUBLE) UNION ALL SELECT k + 1, f + 0.01 FROM steps WHERE k < 499),
dmin AS (SELECT category, min(nn_dist) AS m FROM nn GROUP BY category),
fl AS (SELECT category, CASE WHEN m > 1.0 AND m < 1.2 THEN (SELECT min(f) FROM steps WHERE f >= m)
                             ELSE cast(1.0 AS DOUBLE) END AS lo FROM dmin),
vals AS (
  SELECT DISTINCT n.category, n.nn_dist AS d FROM nn n JOIN fl ON n.category = fl.category
  WHERE n.nn_dist > fl.lo AND n.nn_dist < 1.2
  UNION ALL
  SELECT n.category, max(n.nn_dist) FROM nn n JOIN fl ON n.category = fl.category
  WHERE n.nn_dist <= fl.lo GROUP BY n.category),
ordered AS (SELECT category, d, lead(d) OVER (PARTITION BY category ORDER BY d DESC) AS next_d FROM vals),
drops AS (SELECT o.category, o.d, o.d - o.next_d AS drop FROM ordered o JOIN fl ON o.category = fl.category
          WHERE o.d > fl.lo AND o.d < 1.2 AND o.next_d IS NOT NULL),
eps AS (SELECT category, d AS eps FROM (
          SELECT *, row_number() OVER (PARTITION BY category ORDER BY drop DESC, d DESC) AS rn FROM drops) t
        WHERE rn = 1),
{_components_sql('dist <= (SELECT eps FROM eps WHERE eps.category = pairs.category)')},
clus AS (SELECT p.*, coalesce(l.cluster, -1) AS cluster FROM posd p
         LEFT JOIN comp c ON p.position = c.node LEFT JOIN lab l ON c.root = l.root),
scored AS (SELECT *, in_keywords * 0.2 + focus * 0.4 + extender * 0.15 + attachments * 0.15
                     + ln(1 + gpos) * 0.05 AS sort_cri FROM clus),
groups AS (SELECT category, cluster, round(sum(sort_cri), 9) AS total, round(max(sort_cri), 9) AS top FROM scored
           WHERE cluster > -1 GROUP BY category, cluster),
bound AS (SELECT category, round(quantile_cont(total, 0.2), 9) AS q FROM groups GROUP BY category),
kept AS (SELECT g.*, row_number() OVER (PARTITION BY g.category ORDER BY total DESC, top DESC, cluster) - 1 AS group_rank
         FROM groups g JOIN bound b ON b.category = g.category WHERE total > b.q)"""

ORACLE["q_digest_by_source"] = f"""WITH RECURSIVE {GROUPED_DIGEST},
g AS (SELECT s.category, s.cluster, k.group_rank, s.pid,
             row_number() OVER (PARTITION BY s.cluster ORDER BY s.sort_cri DESC, s.pid) AS in_rank,
             count(*) OVER (PARTITION BY s.cluster) AS size
      FROM scored s JOIN kept k ON s.cluster = k.cluster),
ng AS (SELECT category, count(*) AS n FROM kept GROUP BY category),
sg AS (SELECT s.*, row_number() OVER (PARTITION BY s.category ORDER BY s.sort_cri DESC, s.pid) AS in_rank, coalesce(ng.n, 0) AS n
       FROM scored s LEFT JOIN ng ON ng.category = s.category WHERE s.cluster < 0)
SELECT category, cluster, cast(group_rank AS bigint) AS group_rank, in_rank, pid FROM g
WHERE in_rank <= CASE WHEN size < 4 THEN size ELSE floor(size / 2) END
UNION ALL SELECT category, cluster, NULL, in_rank, pid FROM sg WHERE in_rank <= CASE WHEN n < 25 THEN 25 - n ELSE 5 END"""

ORACLE["q_cluster_rank_by_source"] = (f"WITH RECURSIVE {GROUPED_DIGEST} "
    "SELECT category, cluster, round(total, 6) AS total, round(top, 6) AS top, group_rank FROM kept")


ORACLE["q_singles"] = f"""WITH RECURSIVE {DIGEST_CTE_FIXED},
ng AS (SELECT count(*) AS n FROM kept),
sg AS (SELECT pid, sort_cri, row_number() OVER (ORDER BY sort_cri DESC, pid) - 1 AS srank
       FROM scored WHERE cluster < 0)
SELECT pid, round(sort_cri, 6) AS sort_cri FROM sg
WHERE srank < (SELECT CASE WHEN n < 25 THEN 25 - n ELSE 5 END FROM ng)"""


ORACLE["q_keyword_hits"] = r"""WITH kw AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS keyword FROM benchmark),
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS keyword FROM documents)
SELECT t.doc_id, t.keyword, count(*) AS hits FROM t JOIN kw ON t.keyword = kw.keyword GROUP BY t.doc_id, t.keyword"""

from quire.plans.catalog_more import MORE_ORACLE  # noqa: E402

ORACLE.update(MORE_ORACLE)
