"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from quire.llm.chat import CONTROL
from quire.llm.quality import LINE_CHAR_LIMIT, LINE_LIMIT, NGRAM_LIMITS

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{CAPITALS}', '{SMALL}')"


def _cover(n: int) -> str:
    """Positions that lie in an n-word window found twice in the text."""
    return f"""g{n} AS (SELECT rid, k, array_to_string(w[k:k + {n} - 1], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - {n} + 2)) AS k FROM d) t),
r{n} AS (SELECT rid, k, count(*) OVER (PARTITION BY rid, g) AS c FROM g{n}),
p{n} AS (SELECT DISTINCT rid, unnest(range(k, k + {n})) AS p FROM r{n} WHERE c > 1),
c{n} AS (SELECT p{n}.rid, count(*) AS n_cover, sum(length(d.w[p])) AS chars FROM p{n} JOIN d ON d.rid = p{n}.rid GROUP BY p{n}.rid)"""


QUALITY = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
ln AS (SELECT rid, line, row_number() OVER (PARTITION BY rid, line) AS nth
       FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) t WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
ls AS (SELECT rid, count(*) AS n_lines, count_if(nth > 1) AS dup, coalesce(sum(CASE WHEN nth > 1 THEN length(line) END), 0) AS chars FROM ln GROUP BY rid),
{", ".join(_cover(n) for n in (3, *NGRAM_LIMITS))},
m AS (SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(ls.dup, 0) AS n_dup_lines, coalesce(c3.n_cover, 0) AS n_repeat_words,
  coalesce(ls.n_lines, 0) AS n_lines, coalesce(ls.chars, 0) AS dup_line_chars,
  {", ".join(f"cast(coalesce(c{n}.chars, 0) AS double) / greatest(1, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)) AS cover_{n}" for n in NGRAM_LIMITS)}
  FROM d LEFT JOIN ls ON ls.rid = d.rid {" ".join(f"LEFT JOIN c{n} ON c{n}.rid = d.rid" for n in (3, *NGRAM_LIMITS))}),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, cast(n_words AS bigint) AS n_words, cast(word_chars AS bigint) AS word_chars, cast(n_symbols AS bigint) AS n_symbols,
  cast(n_dup_lines AS bigint) AS n_dup_lines, cast(n_repeat_words AS bigint) AS n_repeat_words, cast(n_lines AS bigint) AS n_lines,
  cast(dup_line_chars AS bigint) AS dup_line_chars, {", ".join(f"cover_{n}" for n in NGRAM_LIMITS)}, base_failed,
  NOT base_failed AND NOT (n_dup_lines > {LINE_LIMIT} * n_lines OR dup_line_chars > {LINE_CHAR_LIMIT} * word_chars
    OR {" OR ".join(f"cover_{n} > {most}" for n, most in NGRAM_LIMITS.items())}) AS kept FROM b"""

JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(text=_lower("text"))} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
l AS (SELECT a, b FROM pr JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 90 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(node, root) AS (SELECT a, a FROM e UNION SELECT e.b, r.root FROM reach r JOIN e ON r.node = e.a),
comp AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT d.doc_id, cast(coalesce(n.n, 0) AS bigint) AS n_shingles, coalesce(least(comp.root, d.doc_id), d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.node = d.doc_id"""

_ITEM_WORDS = rf"regexp_extract_all({_lower('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT cast(item_id AS varchar) AS item, w, least(10, len(w)) AS n FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) t WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM b) t),
dw AS (SELECT rid, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM win) s) t),
hit AS (SELECT rid, k, dw.n, item FROM dw JOIN win ON win.n = dw.n AND win.g = dw.g),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hit) t GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS s FROM hit GROUP BY rid)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(n_hit, 0) AS bigint) AS n_hit, cast(coalesce(n_items, 0) AS bigint) AS n_items,
  coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov ON cov.rid = d.rid LEFT JOIN it ON it.rid = d.rid"""


def _pattern(extra: str = "") -> str:
    quoted = ["".join("\\" + c if c in "[]|<>/\\ #" else c for c in s) for s in (*CONTROL, "\\", *extra)]
    return "|".join(quoted)


def _escaped_chars(text: str, extra: str = "") -> str:
    return f"length({text}) + len(regexp_extract_all({text}, '{_pattern(extra)}'))"


CHAT = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r))
SELECT cast(conv_id AS bigint) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  cast(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  cast(sum(14 + {_escaped_chars('role', ':')} + {_escaped_chars('text')}) AS bigint) AS formatted_chars
FROM c GROUP BY conv_id"""



def _crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text, bit by bit from its reversed polynomial."""
    step = "CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END"
    byte = f"list_reduce([xor(c, b)] || [{', '.join(['0'] * 8)}], lambda c, z: {step})"
    return f"""xor(4294967295, list_reduce([cast(4294967295 AS bigint)] || list_transform(string_split({text}, ''), lambda x: cast(ascii(x) AS bigint)),
  lambda c, b: {byte}))"""


def _written(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(cast({column} AS varchar)) || ':' || cast({column} AS varchar) END"


def _climb(name: str, start: str, nodes: str) -> str:
    """From a leaf to its root: the folded hash and the siblings passed."""
    return f"""{name}(rid, tree, lvl, i, n, h, proof) AS ({start} UNION ALL
  SELECT w.rid, w.tree, w.lvl + 1, w.i // 2, (w.n + 1) // 2,
    sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END), w.proof || coalesce(s.h, '')
  FROM {name} w LEFT JOIN {nodes} s ON s.tree = w.tree AND s.lvl = w.lvl AND s.i = xor(w.i, 1) WHERE w.n > 1)"""


def _grow(name: str, start: str) -> str:
    return f"""{name}(tree, lvl, i, h, n) AS ({start} UNION ALL
  SELECT tree, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY tree, lvl, i // 2, n)"""


_LEAF = "sha256(" + " || ".join(_written(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"
MERKLE = f"""WITH RECURSIVE d AS (SELECT *, row_number() OVER () AS rid, {_LEAF.format(n_chars="n_chars")} AS leaf,
  CASE WHEN {_crc32("cast(doc_id AS varchar)")} % 7 = 0 THEN {_LEAF.format(n_chars="(n_chars + 1)")} END AS tampered FROM documents),
l AS (SELECT *, cast(dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS bigint) AS tree, count(*) OVER (PARTITION BY lang) AS n,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM d),
{_grow("node", "SELECT tree, 0, r, leaf, n FROM l")},
sub AS (SELECT tree, h FROM node WHERE n = 1),
{_grow("over_", "SELECT 0, 0, tree, h, (SELECT count(*) FROM sub) FROM sub")},
{_climb("low", "SELECT rid, tree, 0, r, n, coalesce(tampered, leaf), '' FROM l", "node")},
{_climb("high", "SELECT rid, 0, 0, tree, (SELECT count(*) FROM sub), h, proof FROM low WHERE n = 1", "over_")}
SELECT l.doc_id, l.leaf, sub.h AS subroot, o.h AS root, sha256(high.proof) AS proof_sha256, high.h AS folded_root, high.h = o.h AS verified
FROM l JOIN sub ON sub.tree = l.tree JOIN high ON high.rid = l.rid AND high.n = 1 CROSS JOIN (SELECT h FROM over_ WHERE n = 1) o"""

_VISIBLE = r"[^\x20\x09-\x0D]"
REPAIR = f"""WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("(coalesce(cast(conv_id AS varchar), ' ') || ':' || coalesce(cast(turn AS varchar), ' '))")} % 20 AS f FROM conversations),
dam AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
  CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
convs AS (SELECT DISTINCT conv_id, coalesce(cast(conv_id AS varchar), ' ') AS c FROM src),
num AS (SELECT coalesce(cast(conv_id AS varchar), ' ') AS c, turn, role, text, left(role, 1) AS l,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM dam),
flag AS (SELECT *, NOT regexp_matches(text, '{_VISIBLE}') AS blank, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
  NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS open, lag(l) OVER (PARTITION BY c ORDER BY i) AS prev FROM num),
r AS (SELECT *, blank OR again AS gone, CASE WHEN NOT blank AND NOT again AND open THEN 3 ELSE 0 END AS pen FROM flag),
stat AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
  count_if(NOT blank AND again) AS duplicate, count_if(pen > 0) AS truncated,
  count_if(prev IS NOT NULL AND prev || l NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY c),
nxt(st, nx, nm) AS (VALUES ('-', 'u', 'user:'), ('s', 'u', 'user:'), ('u', 'a', 'assistant:'), ('a', 'u', 'user:')),
ins AS (SELECT st, st AS s2, 0 AS cost, '' AS a, cast([] AS varchar[]) AS o FROM nxt
  UNION ALL SELECT st, nx, 3, 'I', [nm] FROM nxt
  UNION ALL SELECT x.st, y.nx, 6, 'II', [x.nm, y.nm] FROM nxt x JOIN nxt y ON y.st = x.nx),
dp(c, i, st, best) AS (SELECT c, 0, '-', {{'cost': 0, 'audit': '', 'lines': cast([] AS varchar[])}} FROM stat
  UNION ALL SELECT c, i + 1, s3, min({{'cost': cost, 'audit': audit, 'lines': lines}}) FROM (
    SELECT dp.c, dp.i, e.s3, dp.best.cost + ins.cost + e.cost AS cost, dp.best.audit || ins.a || e.a AS audit,
      list_concat(list_concat(dp.best.lines, ins.o), e.o) AS lines
    FROM dp JOIN ins ON ins.st = dp.st JOIN r ON r.c = dp.c AND r.i = dp.i + 1 JOIN nxt ON nxt.st = ins.s2, LATERAL (
      SELECT ins.s2 AS s3, 4 AS cost, 'D' AS a, cast([] AS varchar[]) AS o
      UNION ALL SELECT r.l, r.pen, 'K', [r.role || ':' || r.text] WHERE NOT r.gone AND (r.l = nxt.nx OR r.l = 's' AND ins.s2 = '-')
      UNION ALL SELECT nxt.nx, r.pen + 3, 'R', [nxt.nm || r.text] WHERE NOT r.gone) e) t GROUP BY c, i, s3),
fin AS (SELECT dp.c, min({{'cost': best.cost + ins.cost, 'audit': best.audit || ins.a, 'lines': list_concat(best.lines, ins.o)}}) AS best
  FROM dp JOIN stat ON stat.c = dp.c AND stat.n = dp.i JOIN ins ON ins.st = dp.st AND ins.s2 IN ('-', 'a') GROUP BY dp.c)
SELECT conv_id, cast(coalesce(gaps, 0) AS bigint) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cast(coalesce(best.cost, 0) AS bigint) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM convs LEFT JOIN stat ON stat.c = convs.c LEFT JOIN fin ON fin.c = convs.c"""

ORACLE = {"op2_quality_rules": QUALITY, "op4_ngram_jaccard": JACCARD, "op5_decontamination": DECONTAMINATION, "op10_chat_formatting": CHAT,
          "op12_conversation_repair": REPAIR, "op13_merkle_manifest": MERKLE}
