"""DuckDB twins of the sink, sheet and streaming queries."""

KEY = "cast(user_id AS varchar) || '/' || event_type"

ORACLE_IO = {
    "q_sink_roundtrip": """SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 1 AS in_json, cast(2 AS bigint) AS copies
FROM customer""",
    "q_sheet_ops": """WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c_custkey + 2 AS row_num,
  CASE WHEN c_custkey + 2 = 5 THEN lower(c_name) ELSE c_name END AS name,
  CASE WHEN c_custkey + 2 BETWEEN 3 AND 6 THEN NULL ELSE c_mktsegment END AS segment,
  cast(coalesce(n.n, 0) AS varchar) AS orders_n
FROM customer LEFT JOIN n ON c_custkey = n.o_custkey""",
    "q_last_row": """WITH s AS (SELECT c_custkey + 2 AS row_num, c_mktsegment,
         CASE WHEN c_acctbal > 0 THEN c_name ELSE '' END AS name FROM customer),
l AS (SELECT c_mktsegment, max(row_num) AS last_row FROM s WHERE name <> '' GROUP BY c_mktsegment)
SELECT l.last_row, l.c_mktsegment, s.name AS last_name FROM l JOIN s ON l.last_row = s.row_num""",
    "q_stream_ingest": f"""WITH ev AS (SELECT *, {KEY} AS pid FROM events),
k1 AS (SELECT DISTINCT pid FROM ev WHERE ts < timestamp '2024-01-15 00:00:00'
       AND ts < timestamp '2024-01-10 00:00:00' - INTERVAL 30 MINUTE),
k2 AS (SELECT DISTINCT pid FROM ev WHERE ts < timestamp '2024-01-20 00:00:00' - INTERVAL 30 MINUTE
       AND pid NOT IN (SELECT pid FROM k1)),
k3 AS (SELECT DISTINCT pid FROM ev WHERE ts < timestamp '2024-06-01 00:00:00' - INTERVAL 30 MINUTE
       AND pid NOT IN (SELECT pid FROM k1) AND pid NOT IN (SELECT pid FROM k2))
SELECT event_id, pid, ts, 0 AS batch FROM ev WHERE ts < timestamp '2024-01-15 00:00:00' AND pid IN (SELECT pid FROM k1)
UNION ALL
SELECT event_id, pid, ts, 1 AS batch FROM ev WHERE pid IN (SELECT pid FROM k2)
UNION ALL
SELECT event_id, pid, ts, 2 AS batch FROM ev WHERE pid IN (SELECT pid FROM k3)""",
    "q_stream_requests": """SELECT conv_id, turn,
  CASE WHEN role <> 'assistant' THEN replace(text, chr(10), '') END AS text,
  CASE WHEN role = 'assistant' THEN 'missing: name_list' END AS reason,
  CASE WHEN role = 'user' THEN 0 ELSE 1 END AS batch
FROM conversations""",
}
