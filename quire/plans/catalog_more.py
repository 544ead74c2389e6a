"""Registered queries of the small operators that no chain above shows on its
own, with their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.plans.oracle_text import ORDERS_STORY, rel_sql
from quire.session import checkpoint_dir, prepare
from quire.sources.tables import headline, table


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_topic_items(spark: SparkSession, sf: str) -> DataFrame:
    """Topic documents landed as JSON files and read back (A6), flattened to
    items; documents without items go to quarantine with a reason (A4)."""
    prepare(spark)
    from quire.schemas import TOPIC_JSON_SCHEMA
    from quire.sources.json_docs import flatten_topics, read_json
    d = table(spark, sf, "documents")
    item = lambda mark: F.struct(F.concat(F.col("doc_id").cast("string"), F.lit(mark)).alias("Id"),
                                 F.col("source").alias("CreateTime"), headline(F.col("text")).alias("HeadLine"))
    items = F.when(F.col("n_chars") % 7 != 0, F.array(item("a"), item("b")))
    landed = _scratch(spark, "topics")
    d.select(F.col("doc_id").alias("tno"), F.struct(items.alias("Items")).alias("ResultData")).write.json(landed)
    flat, bad = flatten_topics(read_json(spark, landed, TOPIC_JSON_SCHEMA))
    return (flat.withColumn("reason", F.lit(None).cast("string"))
            .unionByName(bad.select("tno", "reason"), allowMissingColumns=True))


def q_headline_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct ids of the links into a section of all pages."""
    prepare(spark)
    from quire.sources.html import headline_ids
    return headline_ids(table(spark, sf, "pages"), section="/t", id_pattern=r"^/(t\w+)")


def q_table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A table written, then replaced (A11); the fixed columns of a published table."""
    prepare(spark)
    from quire.sources.sinks import overwrite, publish_columns
    d, path = table(spark, sf, "documents"), _scratch(spark, "replaced")
    overwrite(d.filter("n_chars > 1000"), path)
    overwrite(publish_columns(d.filter("n_chars <= 1000"), ["doc_id", "lang", "absent", "n_chars"]), path)
    return spark.read.parquet(path)


def q_cell(spark: SparkSession, sf: str) -> DataFrame:
    """One cell of the customer sheet."""
    prepare(spark)
    from quire.sources.sinks import cell
    sheet = table(spark, sf, "customer").select((F.col("c_custkey") + 2).alias("row_num"), "c_name")
    return cell(sheet, 9, "c_name")


def q_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of an ordered result, some fields only."""
    prepare(spark)
    from quire.sources.scans import preview
    return preview(table(spark, sf, "documents").orderBy(F.desc("n_chars"), "doc_id"), 20, ["doc_id", "lang", "absent"])


def _trends(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select("ts", F.col("event_type").alias("title"),
                    F.concat(F.lit("user "), (F.col("user_id") % 5).cast("string"), F.lit(", "), F.col("event_type")).alias("related"))


def q_trend_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct terms of recent trends, titles and related ones."""
    prepare(spark)
    from quire.functions.keywords import trend_terms
    return trend_terms(_trends(spark, sf), "2024-01-15 00:00:00", dt_col="ts")


# Terms looked for in the driver's texts.
TERMS = ["the", "eau", "sch", "ción", "^Er", "\\d{3}"]


def q_trend_matches(spark: SparkSession, sf: str) -> DataFrame:
    """How many of the terms occur in each text (I11), and which of a list of
    words, as plain text (C11)."""
    prepare(spark)
    from quire.functions.keywords import keywords_in_text, trend_match_count
    words = F.array(F.lit("the"), F.lit("que"), F.lit(""), F.col("lang"))
    return table(spark, sf, "documents").select(
        "doc_id", trend_match_count(F.col("text"), TERMS).alias("terms"),
        F.array_join(keywords_in_text(F.col("text"), words), "|").alias("words"))


MORE_FILTERS = [{"type": "exists", "field": "lang", "value": True}, {"type": "prefix", "field": "source", "value": "src1"},
                {"type": "wildcard", "field": "text", "value": "*th?t*"}]


def q_filter_more(spark: SparkSession, sf: str) -> DataFrame:
    """Exists, prefix and wildcard filters (B8), then a condition of the caller's own."""
    prepare(spark)
    from quire.operators.predicates import adhoc, compile_filters
    kept = table(spark, sf, "documents").filter(compile_filters(MORE_FILTERS))
    return adhoc(kept, "n_chars BETWEEN 200 AND 9000 OR lang = 'de'").select("doc_id", "source")


def q_people(spark: SparkSession, sf: str) -> DataFrame:
    """A person list without the excluded roles (B16), and a comma list as items."""
    prepare(spark)
    from quire.functions.text import exclude_roles, split_keywords
    d = table(spark, sf, "documents")
    people = split_keywords(F.concat_ws(" , ", "lang", "source", F.lit(""), "lang"))
    return d.select("doc_id", F.size(people).alias("n_items"), F.array_join(exclude_roles(people, ["en", "src3"]), "|").alias("people"))


def q_parsed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors stored as JSON text, parsed."""
    prepare(spark)
    from quire.functions.text import parse_embedding
    e = table(spark, sf, "embeddings").select("vec_id", F.to_json(F.col("embedding").cast("array<double>")).alias("j"))
    v = e.select("vec_id", parse_embedding(F.col("j"), True).alias("v"))
    return v.select("vec_id", F.size("v").alias("dim"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def q_tagger_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tagger input and output tables (K15, I15): nested token arrays by
    sentence joined back; an article that the tagger lost keeps its row."""
    prepare(spark)
    from quire.plans.catalog_text import tagged_docs
    from quire.plans.topic import join_tagger_output
    nested = lambda c: F.array(F.slice(c, 1, 3), F.slice(c, 4, 1 << 30))
    tagged = (tagged_docs(spark, sf).filter(F.col("doc_id") % 10 != 3)
              .select(F.col("doc_id").cast("string").alias("pid"), nested("words").alias("cut"), nested("tags").alias("pos"), nested("entities").alias("entity")))
    articles = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("pid"), headline(F.col("text")).alias("h1"))
    return join_tagger_output(articles, tagged).select("pid", "embed_text", "tag_status")


def q_normalised(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with concrete dates (K14): story date, relative words and day mentions."""
    prepare(spark)
    from quire.plans.catalog import _orders_story
    from quire.plans.topic import normalise_articles
    o = _orders_story(spark, sf).select("pid", F.col("dt").alias("published_dt"), F.concat(F.lit("<p>"), F.col("content"), F.lit("</p>")).alias("content"))
    return normalise_articles(o).select("pid", "story_dt", F.regexp_replace("article", "^（[^）]*日（[^）]*）電）|^（[^）]*電）", "").alias("article"))


def letter_shares(texts):
    """An embedder that SQL can repeat: the shares of four letters in a text."""
    return [[t.count(c) / max(1, len(t)) for c in "aeio"] for t in texts]


def q_embed_with(spark: SparkSession, sf: str) -> DataFrame:
    """An injected embedder over all documents."""
    prepare(spark)
    from quire.plans.embed import embed_with
    e = embed_with(table(spark, sf, "documents"), "doc_id", "text", letter_shares)
    return e.select("doc_id", *[F.floor(F.col("embedding")[i] * 1000000).alias(f"v{i}") for i in range(4)])


def q_times(spark: SparkSession, sf: str) -> DataFrame:
    """Times written in every form and read back."""
    prepare(spark)
    from quire.functions.dates import TIME_FORMATS, format_time, parse_time
    o = table(spark, sf, "orders")
    ts = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(13), F.lit(5))
    form = F.element_at(F.array(*[format_time(ts, f) for f in TIME_FORMATS]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return o.select("o_orderkey", form.alias("written"), parse_time(form).alias("ts"))


MORE_QUERIES = {f.__name__: f for f in (
    q_topic_items, q_headline_ids, q_table_overwrite, q_cell, q_preview, q_trend_terms, q_trend_matches, q_filter_more,
    q_people, q_parsed_vectors, q_tagger_tables, q_normalised, q_embed_with, q_times)}

_W = r"regexp_extract_all(text, '[\p{L}\p{N}_]+|[,.]')"
_KEPT = ("array_to_string(list_filter(list_transform(w, lambda x: CASE WHEN x IN (',', '.') THEN ' ' WHEN length(x) >= 3 THEN x END), "
         "lambda y: y IS NOT NULL), '')")
_ENTS = (r"array_to_string(list_sort(list_distinct(list_filter(w, lambda x: regexp_matches(x, '^\p{Lu}') AND length(x) > 1 "
         r"AND length(x) % 12 NOT IN (1, 3, 6)))), ' ')")

MORE_ORACLE = {
    "q_topic_items": """SELECT doc_id AS tno, cast(doc_id AS varchar) || m AS pid, source AS published_dt,
  split_part(text, chr(10), 1) AS h1, cast(NULL AS varchar) AS reason
FROM documents, (VALUES ('a'), ('b')) t(m) WHERE n_chars % 7 <> 0
UNION ALL SELECT doc_id, NULL, NULL, NULL, 'missing ResultData.Items' FROM documents WHERE n_chars % 7 = 0""",
    "q_headline_ids": r"""SELECT DISTINCT regexp_extract(h, '^/(t[A-Za-z0-9_]+)', 1) AS pid
FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS h FROM pages) t
WHERE contains(h, '/t') AND regexp_extract(h, '^/(t[A-Za-z0-9_]+)', 1) <> ''""",
    "q_table_overwrite": "SELECT doc_id, lang, n_chars FROM documents WHERE n_chars <= 1000",
    "q_cell": "SELECT c_name AS value FROM customer WHERE c_custkey = 7",
    "q_preview": "SELECT doc_id, lang FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20",
    "q_trend_terms": """SELECT DISTINCT term FROM (
  SELECT event_type AS term FROM events WHERE ts >= timestamp '2024-01-15 00:00:00'
  UNION ALL SELECT 'user ' || cast(user_id % 5 AS varchar) FROM events WHERE ts >= timestamp '2024-01-15 00:00:00') t""",
    "q_trend_matches": "SELECT doc_id, cast("
        + " + ".join(f"CASE WHEN regexp_matches(text, '{t}') THEN 1 ELSE 0 END" for t in TERMS)
        + """ AS bigint) AS terms, array_to_string(list_filter(['the', 'que', lang], lambda k: contains(text, k)), '|') AS words
FROM documents""",
    "q_filter_more": """SELECT doc_id, source FROM documents WHERE lang IS NOT NULL AND starts_with(source, 'src1')
  AND regexp_matches(text, '(?s)th.t') AND (n_chars BETWEEN 200 AND 9000 OR lang = 'de')""",
    "q_people": """SELECT doc_id, cast(3 AS integer) AS n_items,
  array_to_string(list_filter([lang, source], lambda x: x NOT IN ('en', 'src3')), '|') AS people FROM documents""",
    "q_parsed_vectors": """SELECT vec_id, cast(len(embedding) AS integer) AS dim,
  round(list_sum(cast(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
    "q_tagger_tables": f"""WITH t AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, {_W} AS w FROM documents)
SELECT cast(doc_id AS varchar) AS pid,
  CASE WHEN doc_id % 10 <> 3 THEN title || ' ' || {_KEPT} || ' entities: ' || {_ENTS} END AS embed_text,
  CASE WHEN doc_id % 10 <> 3 THEN 'ok' ELSE 'missing' END AS tag_status FROM t""",
    "q_normalised": f"""WITH {ORDERS_STORY}
SELECT pid, story_v2 AS story_dt,
  {rel_sql("split_part(content, '電）', 2)", 'story_v2')} AS article FROM w""",
    "q_embed_with": "SELECT doc_id, " + ", ".join(
        f"cast(floor(cast(length(text) - length(replace(text, '{c}', '')) AS double) / greatest(1, length(text)) * 1000000) AS bigint) AS v{i}"
        for i, c in enumerate("aeio")) + " FROM documents",
    "q_times": """WITH o AS (SELECT o_orderkey, o_orderkey % 4 AS k, o_orderdate + INTERVAL 13 HOUR + INTERVAL 5 MINUTE AS t FROM orders)
SELECT o_orderkey,
  CASE k WHEN 0 THEN strftime(t, '%Y/%m/%d %H:%M') WHEN 1 THEN strftime(t, '%Y-%m-%d %H:%M:%S')
         WHEN 2 THEN strftime(t, '%Y-%m-%d') ELSE strftime(t, '%Y%m%d') END AS written,
  CASE WHEN k = 0 THEN date_trunc('minute', t) WHEN k = 1 THEN date_trunc('second', t) ELSE date_trunc('day', t) END AS ts FROM o""",
}
