"""Registered queries for documents, requests, tagging, names and enrichment."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import prepare
from quire.sources.tables import ARTICLE_EPOCH, headline, table

# The photo separator used when landing article documents.
SEP = "|$@$|"
# Clock passed to the topic abstract job.
UPDATE_DT = _dt.datetime(2024, 2, 1, 0, 0)


def _r(c, n=6):
    return F.round(F.col(c), n)


def article_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Article JSON documents landed from the documents table (one per doc)."""
    d = table(spark, sf, "documents")
    created = F.date_format(F.to_timestamp_ntz(F.lit(ARTICLE_EPOCH))
                            + F.make_dt_interval(F.lit(0), F.lit(0), F.col("doc_id").cast("int")),
                            "yyyy/MM/dd HH:mm")
    photos = F.array(
        F.struct(F.lit("extender").alias("iType"),
                 F.concat(F.lit("u"), F.col("doc_id").cast("string"), F.lit(SEP), F.lit("v"),
                          F.col("doc_id").cast("string")).alias("Photo")),
        F.struct(F.when(F.col("n_chars") % 2 == 0, F.lit("extender")).otherwise(F.lit("photo")).alias("iType"),
                 F.lit(None).cast("string").alias("Photo")))
    news = F.struct(F.col("doc_id").cast("string").alias("Id"), headline(F.col("text")).alias("Title"),
                    F.concat(F.lit("<p>"), F.replace(F.col("text"), F.lit("\n"), F.lit("</p><p>")),
                             F.lit("</p>")).alias("Content"),
                    F.col("lang").alias("Keywords"), F.col("source").alias("TypeName"), photos.alias("Photos"))
    doc = F.struct(F.struct(news.alias("News"), F.struct(created.alias("DateCreated")).alias("MetaData"))
                   .alias("ResultData"))
    return d.select(F.to_json(doc).alias("json"))


def q_json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.sources.json_docs import flatten_articles, parse_article_json
    flat = flatten_articles(parse_article_json(article_docs(spark, sf), "json"))
    return flat.select("pid", "published_dt", "h1", "article", "keywords", "category", "extender", "attachments")


def requests_table(spark: SparkSession, sf: str) -> DataFrame:
    """Service requests landed from conversations: one per turn; assistant
    turns carry no name_list (so they are incomplete)."""
    c = table(spark, sf, "conversations")
    body = F.struct(F.split(F.col("text"), "\n", -1).alias("content"),
                    F.create_map(F.lit("keywords"), F.array(F.col("role"))).alias("entity_list"),
                    F.when(F.col("role") != "assistant", F.array(F.col("role"))).alias("name_list"))
    return c.select("conv_id", "turn", F.to_json(body).alias("body"))


def q_requests(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.sources.json_docs import validate_requests
    valid, bad = validate_requests(requests_table(spark, sf), "body", ["conv_id", "turn"])
    return (valid.select("conv_id", "turn", "text", F.lit(None).cast("string").alias("reason"))
                 .unionByName(bad.select("conv_id", "turn", F.lit(None).cast("string").alias("text"), "reason")))


# Pseudo tagging of driver text (tagger output stand-in).
TAGGER_CLASSES = ["LOC", "CARDINAL", "ORG", "NORP", "GPE", "DATE", "PRODUCT", "PERSON", "EVENT", "FAC", "LAW", "WORK_OF_ART"]
TOKEN_OR_PUNCT = r"[\p{L}\p{N}_]+|[,.]"


def tagged_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    words = F.regexp_extract_all(F.col("text"), F.lit(TOKEN_OR_PUNCT), 0)
    tags = F.transform(words, lambda w: F.when(w == ",", "COMMACATEGORY").when(w == ".", "PERIODCATEGORY")
                       .when(F.length(w) >= 6, "Na").when(F.length(w) >= 4, "VE")
                       .when(F.length(w) == 3, "D").otherwise("P"))
    ents = F.transform(F.filter(words, lambda w: w.rlike(r"^\p{Lu}")),
                       lambda w: F.struct(w.alias("text"),
                                          F.element_at(F.array(*map(F.lit, TAGGER_CLASSES)),
                                                       F.length(w) % len(TAGGER_CLASSES) + 1).alias("type")))
    return d.select("doc_id", headline(F.col("text")).alias("title"), words.alias("words"),
                    tags.alias("tags"), ents.alias("entities"))


def q_pos_filter(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.functions.text import pos_filter
    t = tagged_docs(spark, sf)
    return t.select("doc_id", pos_filter(F.col("words"), F.col("tags")).alias("kept"))


def q_entities(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.functions.text import embedding_text, entity_words, pos_filter
    t = tagged_docs(spark, sf)
    ents = entity_words(F.col("entities"))
    return t.select("doc_id", ents.alias("entities"),
                    embedding_text(F.col("title"), pos_filter(F.col("words"), F.col("tags")), ents)
                    .alias("embed_text"))


def q_name_annotate(spark: SparkSession, sf: str) -> DataFrame:
    """Person-name pass (K10): the name list of a document, one entry a line, holds its
    words of six to eight letters with the document's language as title. The lists of
    all documents are parsed (I17) into one dictionary, and every name of it is
    annotated wherever it stands in any whole text (C10), inside longer words too."""
    prepare(spark)
    from quire.plans.topic import person_name_pass
    words = F.filter(F.regexp_extract_all(F.col("text"), F.lit(r"(\p{L}+)"), 1),
                     lambda w: F.length(w).between(6, 8))
    raw = F.array_join(F.transform(F.array_sort(F.array_distinct(words)),
                                   lambda w: F.concat(w, F.lit("|"), F.coalesce(F.col("lang"), F.lit("-")))), "\n")
    d = table(spark, sf, "documents").select("doc_id", "text", raw.alias("name_list"))
    return person_name_pass(d, "text", "name_list").select("doc_id", "n_names", "annotated")


def q_prompt_articles(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.plans.enrich import task_prompts
    p = task_prompts(table(spark, sf, "documents"), "doc_id", "text")
    return p.select("doc_id", "task", F.md5(F.col("prompt")).alias("prompt_md5"),
                    F.length("prompt").alias("prompt_len"))


def q_enrich_pivot(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.plans.enrich import ARTICLE_TASKS, complete, responses_to_columns, task_prompts, with_order
    from quire.plans.summarise import token_weights
    docs = table(spark, sf, "documents").select("doc_id", "text")
    p = task_prompts(with_order(docs, "doc_id", "text", token_weights(docs, "text")), "doc_id", "text")
    return responses_to_columns(complete(p, "doc_id"), "doc_id", [t[0] for t in ARTICLE_TASKS])


def q_topic_abstract(spark: SparkSession, sf: str) -> DataFrame:
    """Topic abstract record per conversation (K3, K9, D7): the turns are
    fenced and concatenated in turn order, three tasks run through the
    completer, and the item count and update time are attached."""
    prepare(spark)
    from quire.plans.enrich import TOPIC_TASKS, complete, fenced, ordered_concat, responses_to_columns, task_prompts, with_order
    from quire.plans.summarise import token_weights
    c = table(spark, sf, "conversations")
    notes = ordered_concat(c, ["conv_id"], ["turn"], fenced(F.col("role"), F.col("text")), "\n", "notes")
    notes = with_order(notes, "conv_id", "notes", token_weights(notes, "notes"))
    counts = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("article_num"))
    prompts = task_prompts(notes, "conv_id", "notes", TOPIC_TASKS)
    wide = responses_to_columns(complete(prompts, "conv_id"), "conv_id", [t[0] for t in TOPIC_TASKS])
    return wide.join(counts, "conv_id").withColumn("update_dt", F.lit(UPDATE_DT).cast("timestamp_ntz"))


def q_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """Same-day events merged per topic and date, in time order."""
    prepare(spark)
    from quire.plans.enrich import ordered_concat
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    item = F.concat(F.col("event_type"), F.lit(" "), F.round(F.col("value") * 100).cast("long").cast("string"))
    merged = ordered_concat(e, ["user_id", "day"], ["ts", "event_id"], item, " ", "events")
    return merged.select(F.col("user_id").alias("tno"), "day", "events")


# Statement kinds left out of the stance table.
STANCE_EXCLUDE = ["system"]


def q_stance(spark: SparkSession, sf: str) -> DataFrame:
    """Statements merged per party (role) and topic, exclusions removed."""
    prepare(spark)
    from quire.plans.enrich import ordered_concat
    c = table(spark, sf, "conversations").filter(~F.col("role").isin(STANCE_EXCLUDE))
    return ordered_concat(c, ["conv_id", "role"], ["turn"], F.col("text"), " ", "statements")


def q_timeline_text(spark: SparkSession, sf: str) -> DataFrame:
    """Dates taken from event texts, events merged per topic and day."""
    prepare(spark)
    from quire.plans.enrich import timeline
    later = F.col("o_orderdate") + F.make_dt_interval(F.lit(5))
    text = F.concat(F.date_format("o_orderdate", "yyyy年M月d日"), F.lit("下單 "), F.col("o_orderpriority"), F.lit("。沒有日期的一句。預計"),
                    F.date_format(later, "yyyy年MM月dd日"), F.lit("出貨。"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("tno"), "o_orderkey", text.alias("facts"))
    return timeline(o, "tno", "facts", ["o_orderkey"])


def q_stance_text(spark: SparkSession, sf: str) -> DataFrame:
    """Parties parsed from lines of text, their words merged, one kind left out."""
    prepare(spark)
    from quire.plans.enrich import stances
    said = F.concat(F.col("role"), F.lit("："), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("\n沒有說話者的一行"))
    c = table(spark, sf, "conversations").select("conv_id", "turn", said.alias("stance"))
    return stances(c, "conv_id", "stance", ["turn"], STANCE_EXCLUDE)


TEXT_QUERIES = {
    "q_timeline_text": q_timeline_text,
    "q_stance_text": q_stance_text,
    "q_json_flatten": q_json_flatten,
    "q_requests": q_requests,
    "q_pos_filter": q_pos_filter,
    "q_entities": q_entities,
    "q_name_annotate": q_name_annotate,
    "q_prompt_articles": q_prompt_articles,
    "q_enrich_pivot": q_enrich_pivot,
    "q_topic_abstract": q_topic_abstract,
    "q_timeline": q_timeline,
    "q_stance": q_stance,
}
