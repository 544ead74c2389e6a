"""DuckDB twins of the document, request, tagging, name and enrichment queries."""

from quire.plans.enrich import ARTICLE_TASKS
from quire.plans.oracle_text import clean_sql


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _tokens(text: str) -> str:
    """Every ideograph is a token of its own, so blanks are put round each."""
    return f"regexp_extract_all(regexp_replace(lower({text}), '(\\p{{Han}})', ' \\1 ', 'g'), '[\\p{{L}}\\p{{N}}_]+')"


def weights_sql(corpus: str, text: str) -> str:
    """CTEs wn and wt: token weights over the texts of a corpus."""
    return f"""wn AS (SELECT count(*) AS n FROM {corpus}),
wt AS (SELECT token, cast(round(ln(cast((SELECT n FROM wn) + 1 AS double) / cast(count(*) + 1 AS double)) * 1000) AS bigint) + 1 AS w
  FROM (SELECT unnest(list_distinct({_tokens(text)})) AS token FROM {corpus}) t GROUP BY token)"""


SENTENCE = r"[^.!?。！？\n]+[.!?。！？]*"


def ranked_sql(p: str, source: str, key: str, text: str) -> str:
    """CTE {p}_rk: every sentence of a source's texts with its score and its rank in its text."""
    return f"""{p}_se AS (SELECT key, sidx, trim(s) AS sentence FROM (SELECT {key} AS key, unnest(m) AS s, unnest(range(len(m))) AS sidx
  FROM (SELECT {key}, regexp_extract_all(coalesce({text}, ''), '{SENTENCE}') AS m FROM {source}) a) b WHERE trim(s) <> ''),
{p}_tk AS (SELECT key, sidx, unnest({_tokens("sentence")}) AS token FROM {p}_se),
{p}_tf AS (SELECT key, token, count(*) AS tf FROM {p}_tk GROUP BY key, token),
{p}_sc AS (SELECT k.key, k.sidx, cast(sum(tf * coalesce(w, cast(round(ln(cast((SELECT n FROM wn) + 1 AS double)) * 1000) AS bigint) + 1)) AS double) / count(*) AS score
  FROM {p}_tk k JOIN {p}_tf f ON f.key = k.key AND f.token = k.token LEFT JOIN wt ON wt.token = k.token GROUP BY k.key, k.sidx),
{p}_rk AS (SELECT s.key, s.sidx, s.sentence, contains(s.sentence, ':') OR contains(s.sentence, '：') OR contains(s.sentence, '"') AS spoken,
  row_number() OVER (PARTITION BY s.key ORDER BY coalesce(score, 0.0) DESC, s.sidx) AS rank,
  sum(length(s.sentence) + 1) OVER (PARTITION BY s.key ORDER BY coalesce(score, 0.0) DESC, s.sidx ROWS UNBOUNDED PRECEDING) - 1 AS used
  FROM {p}_se s LEFT JOIN {p}_sc c ON c.key = s.key AND c.sidx = s.sidx)"""


def answers_sql(p: str, source: str, key: str, text: str) -> str:
    """CTE {p}_an: each text's best sentences in every form of answer, from the whole text."""
    return f"""{ranked_sql(p, source, key, text)},
{p}_sp AS (SELECT key, sidx, row_number() OVER (PARTITION BY key ORDER BY rank) AS srank FROM {p}_rk WHERE spoken),
{p}_fo AS (SELECT r.key,
  substr(string_agg(sentence, ' ' ORDER BY r.sidx) FILTER (rank = 1 OR used <= 50), 1, 50) AS c50,
  substr(string_agg(sentence, ' ' ORDER BY r.sidx) FILTER (rank = 1 OR used <= 200), 1, 200) AS c200,
  string_agg(substr(sentence, 1, 100), chr(10) ORDER BY r.sidx) FILTER (rank <= 5) AS items,
  string_agg(substr(sentence, 1, 100), chr(10) ORDER BY r.sidx) FILTER (srank <= 5) AS said
  FROM {p}_rk r LEFT JOIN {p}_sp x ON x.key = r.key AND x.sidx = r.sidx GROUP BY r.key),
{p}_an AS (SELECT d.{key} AS key, coalesce(c50, '') AS what_happen_50, coalesce(c200, '') AS what_happen_200, coalesce(items, '') AS key_facts,
  coalesce(said, '') AS stance FROM {source} d LEFT JOIN {p}_fo f ON f.key = d.{key})"""


def _prompt(instr: str, body: str) -> str:
    return f"({_q(instr)} || chr(10) || chr(10) || coalesce({body}, ''))"


WORDS = r"regexp_extract_all(text, '[\p{L}\p{N}_]+|[,.]')"
KEPT = ("array_to_string(list_filter(list_transform(w, lambda x: CASE WHEN x IN (',', '.') THEN ' ' "
        "WHEN length(x) >= 3 THEN x END), lambda y: y IS NOT NULL), '')")
ENTS = (r"array_to_string(list_sort(list_distinct(list_filter(w, lambda x: regexp_matches(x, '^\p{Lu}') "
        r"AND length(x) > 1 AND length(x) % 12 NOT IN (1, 3, 6)))), ' ')")

FENCED = "'### ' || role || chr(10) || '```' || chr(10) || coalesce(text, '') || chr(10) || '```'"

ORACLE_ENRICH = {
    "q_json_flatten": f"""SELECT cast(doc_id AS varchar) AS pid,
  timestamp '2024-01-01 00:00:00' + to_minutes(doc_id) AS published_dt,
  split_part(text, chr(10), 1) AS h1,
  {clean_sql("'<p>' || replace(text, chr(10), '</p><p>') || '</p>'")} AS article,
  lang AS keywords, source AS category,
  cast(2 + CASE WHEN n_chars % 2 = 0 THEN 1 ELSE 0 END AS integer) AS extender,
  cast(2 AS integer) AS attachments
FROM documents""",
    "q_requests": """SELECT conv_id, turn,
  CASE WHEN role <> 'assistant' THEN replace(text, chr(10), '') END AS text,
  CASE WHEN role = 'assistant' THEN 'missing: name_list' END AS reason
FROM conversations""",
    "q_pos_filter": f"WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents) SELECT doc_id, {KEPT} AS kept FROM t",
    "q_entities": f"""WITH t AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, {WORDS} AS w FROM documents)
SELECT doc_id, {ENTS} AS entities, title || ' ' || {KEPT} || ' entities: ' || {ENTS} AS embed_text FROM t""",
    "q_name_annotate": """WITH RECURSIVE runs AS (
  SELECT doc_id, lang, regexp_extract_all(text, '\\p{L}+') AS w, regexp_split_to_array(text, '\\p{L}+') AS gap FROM documents),
names AS (
  SELECT name, '（' || min(coalesce(lang, '-')) || '）' AS note
  FROM (SELECT unnest(w) AS name, lang FROM runs) x WHERE length(name) BETWEEN 6 AND 8 GROUP BY name),
vocabulary AS (SELECT DISTINCT unnest(w) AS word FROM runs),
walk AS (
  SELECT word, 1 AS p, '' AS done FROM vocabulary WHERE length(word) >= 6
  UNION ALL
  SELECT k.word, k.p + coalesce(length(a.name), length(b.name), length(c.name), 1),
         k.done || coalesce(a.name || a.note, b.name || b.note, c.name || c.note, substr(k.word, k.p, 1))
  FROM walk k LEFT JOIN names a ON a.name = substr(k.word, k.p, 8)
  LEFT JOIN names b ON b.name = substr(k.word, k.p, 7) LEFT JOIN names c ON c.name = substr(k.word, k.p, 6)
  WHERE k.p <= length(k.word)),
annotated_words AS (SELECT word, done FROM walk WHERE p > length(word)),
places AS (SELECT doc_id, unnest(gap) AS gap, unnest(w) AS word, generate_subscripts(gap, 1) AS i FROM runs),
rebuilt AS (
  SELECT doc_id, string_agg(gap || coalesce(done, places.word, ''), '' ORDER BY i) AS annotated
  FROM places LEFT JOIN annotated_words v ON v.word = places.word GROUP BY doc_id)
SELECT doc_id, cast(coalesce(len(list_distinct(list_filter(w, lambda x: length(x) BETWEEN 6 AND 8))), 0) AS integer) AS n_names, annotated
FROM runs LEFT JOIN rebuilt USING (doc_id)""",
    "q_prompt_articles": "SELECT doc_id, task, md5(p) AS prompt_md5, cast(length(p) AS integer) AS prompt_len FROM ("
        + " UNION ALL ".join(f"SELECT doc_id, {_q(t)} AS task, {_prompt(i, 'text')} AS p FROM documents"
                             for t, i, _ in ARTICLE_TASKS) + ") x",
    "q_enrich_pivot": f"""WITH {weights_sql("documents", "text")}, {answers_sql("a", "documents", "doc_id", "text")}
SELECT key AS doc_id, what_happen_50, what_happen_200, key_facts, stance, 'ok' AS status, '' AS error FROM a_an""",
    "q_topic_abstract": f"""WITH notes_ AS (
  SELECT conv_id, string_agg({FENCED}, chr(10) ORDER BY turn) AS notes, count(*) AS article_num
  FROM conversations GROUP BY conv_id),
{weights_sql("notes_", "notes")}, {answers_sql("a", "notes_", "conv_id", "notes")}
SELECT conv_id, what_happen_200 AS normal, key_facts AS timeline, stance, 'ok' AS status, '' AS error, article_num,
  timestamp '2024-02-01 00:00:00' AS update_dt FROM notes_ JOIN a_an ON key = conv_id""",
    "q_timeline": """SELECT user_id AS tno, cast(ts AS date) AS day,
  string_agg(event_type || ' ' || cast(cast(round(value * 100) AS bigint) AS varchar), ' ' ORDER BY ts, event_id) AS events
FROM events GROUP BY user_id, cast(ts AS date)""",
    "q_timeline_text": """SELECT o_custkey AS tno, day, string_agg(event, ' ' ORDER BY o_orderkey, place) AS events FROM (
  SELECT o_custkey, o_orderkey, 0 AS place, cast(o_orderdate AS date) AS day, strftime(o_orderdate, '%Y年%-m月%-d日') || '下單 ' || o_orderpriority AS event FROM orders
  UNION ALL SELECT o_custkey, o_orderkey, 2, cast(o_orderdate + INTERVAL 5 DAY AS date), '預計' || strftime(o_orderdate + INTERVAL 5 DAY, '%Y年%m月%d日') || '出貨' FROM orders) t
GROUP BY o_custkey, day""",
    "q_stance_text": """SELECT conv_id, role AS party, string_agg(trim(replace(text, chr(10), ' ')), ' ' ORDER BY turn) AS statements
FROM conversations WHERE role <> 'system' AND trim(replace(text, chr(10), ' ')) <> '' GROUP BY conv_id, role""",
    "q_stance": """SELECT conv_id, role, string_agg(text, ' ' ORDER BY turn) AS statements
FROM conversations WHERE role NOT IN ('system') GROUP BY conv_id, role""",
}
