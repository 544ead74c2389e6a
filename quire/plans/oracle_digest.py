"""DuckDB twins of the summary, group-prompt and digest queries."""

from quire.plans.oracle import DIGEST_CTE
from quire.plans.oracle_enrich import answers_sql, ranked_sql, weights_sql

NOTES = "('事件摘要: ' || n_an.what_happen_200 || chr(10) || '關鍵事件: ' || n_an.key_facts || chr(10) || '立場文: ' || n_an.stance)"


EXTRACTIVE = f"""WITH {weights_sql("documents", "text")}, {ranked_sql("a", "documents", "doc_id", "text")}
SELECT key AS doc_id, substr(string_agg(sentence, ' ' ORDER BY sidx), 1, 200) AS summary, count(*) AS n_sentences
FROM a_rk WHERE rank = 1 OR used <= 200 GROUP BY key"""

PICKS = f"""{weights_sql("documents", "text")}, {answers_sql("n", "scored", "pid", "article")},
g AS (SELECT s.cluster, k.group_rank, s.pid, s.h1, {NOTES} AS notes,
             row_number() OVER (PARTITION BY s.cluster ORDER BY s.sort_cri DESC, s.pid) AS in_rank,
             count(*) OVER (PARTITION BY s.cluster) AS size
      FROM scored s JOIN kept k ON s.cluster = k.cluster JOIN n_an ON n_an.key = s.pid),
picks AS (SELECT * FROM g WHERE in_rank <= CASE WHEN size < 4 THEN size ELSE floor(size / 2) END),
gb AS (SELECT cluster, min(group_rank) AS group_rank, string_agg(h1, ' | ' ORDER BY in_rank) AS titles,
              string_agg(notes, chr(10) || chr(10) ORDER BY in_rank) AS body
       FROM picks GROUP BY cluster)"""


ORACLE_DIGEST = {
    "q_extractive": EXTRACTIVE,
    "q_prompt_group": f"WITH RECURSIVE {DIGEST_CTE}, {PICKS} SELECT cluster, group_rank, titles, body FROM gb",
    "q_digest": f"""WITH RECURSIVE {DIGEST_CTE}, {PICKS},
ng AS (SELECT count(*) AS n FROM kept),
sg AS (SELECT pid, h1, {NOTES} AS notes, row_number() OVER (ORDER BY sort_cri DESC, pid) - 1 AS srank
       FROM scored JOIN n_an ON n_an.key = pid WHERE cluster < 0),
entry AS (SELECT group_rank AS digest_rank, 'group' AS kind, cast(cluster AS varchar) AS key, titles, body FROM gb
  UNION ALL SELECT srank + (SELECT n FROM ng), 'single', pid, h1, notes FROM sg WHERE srank < (SELECT CASE WHEN n < 25 THEN 25 - n ELSE 5 END FROM ng)),
body_ AS (SELECT kind || key AS id, body FROM entry),
{answers_sql("v", "body_", "id", "body")}
SELECT digest_rank, kind, entry.key, titles, what_happen_200 AS ver1, key_facts AS ver2, 'ok' AS status FROM entry JOIN v_an ON v_an.key = kind || entry.key""",
}
