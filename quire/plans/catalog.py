"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables in full; its twin in ``oracle.py`` is the
same computation in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.scoring import score_articles
from quire.session import prepare
from quire.sources.tables import articles, headline, table

# The keyword list used by the article queries on driver data.
DEMO_KEYWORDS = ["the", "que", "der"]


def _r(c, n=6):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def q_keyword_score(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.scoring import tag_keywords
    a = tag_keywords(articles(spark, sf), DEMO_KEYWORDS)
    return a.select("pid", "in_keywords", "keywords_tag")


def q_keyword_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Token hits of a keyword table (C4): every distinct token of every
    benchmark text against the counted tokens of every document."""
    prepare(spark)
    from quire.functions.keywords import token_hits
    from quire.functions.tokens import tokens
    kw = table(spark, sf, "benchmark").select(F.explode(tokens(F.col("text"))).alias("kw"))
    return token_hits(table(spark, sf, "documents"), "doc_id", "text", kw).select("doc_id", "keyword", "hits")


def q_article_score(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    s = score_articles(articles(spark, sf), DEMO_KEYWORDS)
    return s.select("pid", "in_keywords", "keywords_tag", "position",
                    _r("position_score").alias("position_score"), _r("sort_cri").alias("sort_cri"))


def q_article_top(spark: SparkSession, sf: str) -> DataFrame:
    """Top-20 report of the article score (the limit is the feature)."""
    s = q_article_score(spark, sf)
    return s.orderBy(F.desc("sort_cri"), F.asc("pid")).limit(20).select("pid", "sort_cri")


# Fixed values for the driver's 64-dim unit embeddings: their nearest
# distances lie near 1.0, so the clustering band and eps are set there.
EPS = 1.05
EPS_WIDE = 1.1
BAND = (1.2, 1.0)
DEMO_EXCLUDE = r"^(Der|Le) "


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


def q_nn_distance(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.pairs import nearest_distance
    nn = nearest_distance(_emb(spark, sf), "vec_id", "embedding")
    return nn.select(F.col("id").alias("vec_id"), _r("nn_dist").alias("nn_dist"))


def q_edges(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.pairs import range_edges
    e = range_edges(_emb(spark, sf), "vec_id", "embedding", EPS_WIDE)
    return e.select("a", "b", _r("dist").alias("dist"))


def q_eps(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.cluster import eps_drops, select_eps
    from quire.operators.pairs import nearest_distance
    from quire.session import cut_lineage
    nn = cut_lineage(nearest_distance(_emb(spark, sf), "vec_id", "embedding"))
    eps = select_eps(nn, *BAND)
    d = eps_drops(nn, *BAND)
    return d.select(_r("d").alias("d"), _r("next_d").alias("next_d"), _r("drop").alias("drop"),
                    (F.col("d") == F.lit(eps)).alias("chosen"))


def q_dbscan(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.cluster import dbscan
    return dbscan(_emb(spark, sf), "vec_id", "embedding", EPS).select("vec_id", "cluster")


def q_dbscan_auto(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.cluster import dbscan, select_eps
    from quire.operators.pairs import nearest_distance
    emb = _emb(spark, sf)
    eps = select_eps(nearest_distance(emb, "vec_id", "embedding"), *BAND)
    return dbscan(emb, "vec_id", "embedding", eps).select("vec_id", "cluster")


def q_dbscan_two_stage(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.cluster import dbscan_two_stage
    return dbscan_two_stage(_emb(spark, sf), "vec_id", "embedding", EPS_WIDE, EPS).select(
        "vec_id", "cluster", "cluster2")


def q_dbscan_minpts(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.cluster import dbscan
    return dbscan(_emb(spark, sf), "vec_id", "embedding", EPS_WIDE, min_samples=3).select(
        "vec_id", "cluster")


def q_dbscan_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """DBSCAN inside each source: vectors are only neighbours within their group."""
    prepare(spark)
    from quire.operators.cluster import dbscan
    src = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "source")
    emb = _emb(spark, sf).join(src, "vec_id", "inner")
    return dbscan(emb, "vec_id", "embedding", EPS_WIDE, group_col="source").select("vec_id", "source", "cluster")


def _slim_articles(spark, sf):
    """Articles with their vectors, excluded and tagged; their texts stay behind (``_with_texts`` brings them back)."""
    from quire.plans.digest import exclude_and_tag

    def early(a):
        tagged = exclude_and_tag(a, DEMO_KEYWORDS, DEMO_EXCLUDE)
        return tagged.withColumn("text_key", F.xxhash64("article")).drop("h1", "article", "text")
    return articles(spark, sf, with_embeddings=True, early=early)


def _with_texts(spark, sf, rows):
    """``rows`` of ``_slim_articles`` with h1 and article: only the texts of these rows are kept, and of
    rows that repeat an id each finds its own by the text's fingerprint."""
    key = ["doc_id", "text_key"]
    texts = table(spark, sf, "documents").select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").alias("article"))
    found = texts.join(rows.select(*key), key, "left_semi").dropDuplicates(key)
    return rows.join(found, key).withColumn("h1", headline(F.col("article")))


def _scored_clusters(spark, sf, eps=None):
    """Articles with cluster and score, without their texts."""
    from quire.plans.digest import tag_cluster_score
    return tag_cluster_score(_slim_articles(spark, sf), DEMO_KEYWORDS, eps=eps, band=BAND, tagged=True)[0]


def q_cluster_rank_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking chain run per source (as per day in production): eps,
    positions, quantile and ranks are each source's own, and neighbours never
    cross sources."""
    prepare(spark)
    from quire.plans.digest import rank_groups
    g = rank_groups(_scored_by_source(spark, sf), group_col="category")
    return g.select("category", "cluster", _r("total").alias("total"), _r("top").alias("top"), "group_rank")


def _scored_by_source(spark, sf):
    from quire.plans.digest import tag_cluster_score
    return tag_cluster_score(_slim_articles(spark, sf), DEMO_KEYWORDS, band=BAND, group_col="category", tagged=True)[0]


def q_digest_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """What each source's digest is made of: the picked articles of its ranked
    clusters (E2, E3), then its best single ones up to its own quota (E4)."""
    prepare(spark)
    from quire.plans.digest import pick_in_groups, pick_singles_by_group, rank_groups
    from quire.session import cut_lineage
    s = cut_lineage(_scored_by_source(spark, sf).select("category", "cluster", "pid", "sort_cri"))
    ranked = cut_lineage(rank_groups(s, group_col="category"))
    picks = pick_in_groups(s, ranked).select("category", "cluster", F.col("group_rank").cast("long").alias("group_rank"),
                                             F.col("in_rank").cast("long").alias("in_rank"), "pid")
    singles = pick_singles_by_group(s, ranked, "category").select(
        "category", "cluster", F.lit(None).cast("long").alias("group_rank"), F.col("single_rank").cast("long").alias("in_rank"), "pid")
    return picks.unionByName(singles)


def q_singles(spark: SparkSession, sf: str) -> DataFrame:
    """Best unclustered articles up to the quota set by the group count."""
    prepare(spark)
    from quire.plans.digest import pick_singles, rank_groups
    from quire.session import cut_lineage
    s = cut_lineage(_scored_clusters(spark, sf, EPS_WIDE).select("cluster", "pid", "sort_cri"))
    n_groups = rank_groups(s).count()
    return pick_singles(s, n_groups).select("pid", _r("sort_cri").alias("sort_cri"))


def q_photo_count(spark: SparkSession, sf: str) -> DataFrame:
    """Photo entries per page built from its list items: capitalised items
    are 'extender' entries, long titles carry two URLs (D11, D12)."""
    prepare(spark)
    from quire.functions.text import PHOTO_SEP, attachment_count, photo_url_count
    from quire.sources.html import LIST_ITEM
    p = table(spark, sf, "pages")
    items = F.arrays_zip(F.regexp_extract_all("html", F.lit(LIST_ITEM), 1).alias("u"),
                         F.regexp_extract_all("html", F.lit(LIST_ITEM), 2).alias("t"))
    photos = F.transform(items, lambda x: F.struct(
        F.when(x["t"].rlike(r"^\p{Lu}"), F.lit("extender")).otherwise(F.lit("photo")).alias("iType"),
        F.when(F.length(x["t"]) > 5, F.concat(x["u"], F.lit(PHOTO_SEP), x["u"])).otherwise(x["u"]).alias("Photo")))
    return p.select("page_id", photos.alias("photos")).select(
        "page_id", photo_url_count(F.col("photos")).alias("extender"),
        attachment_count(F.col("photos")).alias("attachments"))


def q_cluster_rank_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Group ranking with a fixed eps (many groups on driver data)."""
    prepare(spark)
    from quire.plans.digest import rank_groups
    g = rank_groups(_scored_clusters(spark, sf, EPS_WIDE))
    return g.select("cluster", _r("total").alias("total"), _r("top").alias("top"), "group_rank")


def q_cluster_pick_fixed(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.plans.digest import pick_in_groups, rank_groups
    from quire.session import cut_lineage
    s = cut_lineage(_scored_clusters(spark, sf, EPS_WIDE).select("cluster", "pid", "sort_cri"))
    p = pick_in_groups(s, rank_groups(s))
    return p.select("cluster", "group_rank", "pid", "in_rank", "size")


def q_cluster_articles(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    s = _scored_clusters(spark, sf)
    return s.select("pid", "position", "cluster", "in_keywords", _r("sort_cri").alias("sort_cri"))


def q_cluster_rank(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.plans.digest import rank_groups
    g = rank_groups(_scored_clusters(spark, sf))
    return g.select("cluster", _r("total").alias("total"), _r("top").alias("top"), "group_rank")


def q_cluster_pick(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.plans.digest import pick_in_groups, rank_groups
    from quire.session import cut_lineage
    s = cut_lineage(_scored_clusters(spark, sf).select("cluster", "pid", "sort_cri"))
    p = pick_in_groups(s, rank_groups(s))
    return p.select("cluster", "group_rank", "pid", "in_rank", "size")


# Search parameters used on driver data.
MATCH_QUERY = "the elle und"
FILTERS = [
    {"type": "term", "field": "lang", "value": ["en", "fr"]},
    {"type": "match", "field": "text", "value": ["elle", "the"]},
    {"type": "match_phrase", "field": "text", "value": "of the"},
    {"type": "range", "field": "n_chars", "value": {"gte": 200, "lte": 5000}},
]
HYBRID_KEYWORDS = [
    {"field": "text", "keywords": ["the", "elle"], "weight": 2.0},
    {"field": "text", "keywords": ["und die"], "weight": 0.5},
]
HYBRID_FILTERS = [{"type": "range", "field": "n_chars", "value": {"gte": 100}},
                  {"type": "match", "field": "text", "value": "de"}]


def _vdocs(spark, sf):
    docs = table(spark, sf, "documents")
    # all documents: corpus figures count those without a vector too
    return docs.join(table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id", "left")


def _qvec(spark, sf):
    from quire.operators.search import query_vector
    emb = table(spark, sf, "embeddings")
    first = emb.agg(F.min("vec_id")).first()[0]
    return query_vector(emb, "embedding", F.col("vec_id") == F.lit(first))


def _hits(df, id_col="doc_id"):
    return df.select(id_col, _r("score").alias("score"))


def q_match(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.search import match_search
    hits, total = match_search(table(spark, sf, "documents"), "doc_id", "text", MATCH_QUERY)
    return _hits(hits).withColumn("total", F.lit(total).cast("long"))


def q_index_search(spark: SparkSession, sf: str) -> DataFrame:
    """The same BM25 match as q_match, answered from a token-ordered
    postings table written to the shared checkpoint folder."""
    prepare(spark)
    import uuid
    from quire.operators.index import build_postings, corpus_figures, index_search, read_postings, write_postings
    from quire.session import checkpoint_dir
    docs = table(spark, sf, "documents")
    path = f"{checkpoint_dir(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
    write_postings(build_postings(docs, "doc_id", "text"), path)
    n, avgdl = corpus_figures(docs, "text")
    hits, total = index_search(read_postings(spark, path), n, avgdl, MATCH_QUERY)
    return hits.select(F.col("id").alias("doc_id"), _r("score").alias("score"),
                       F.lit(total).cast("long").alias("total"))


def q_term(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.search import term_search
    return _hits(term_search(table(spark, sf, "documents"), "doc_id", "source", "src1"))


def q_vector(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.search import vector_search
    emb = table(spark, sf, "embeddings")
    return _hits(vector_search(emb, "vec_id", "embedding", _qvec(spark, sf)), "vec_id")


def q_vector_term(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.search import vector_term_search
    return _hits(vector_term_search(_vdocs(spark, sf), "doc_id", "embedding", _qvec(spark, sf),
                                    "source", "src2"))


def q_vector_filtered(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.search import filtered_vector_search
    return _hits(filtered_vector_search(_vdocs(spark, sf), "doc_id", "embedding", _qvec(spark, sf),
                                        FILTERS, k=20))


def q_hybrid(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.operators.search import weighted_search
    return _hits(weighted_search(_vdocs(spark, sf), "doc_id", "embedding", _qvec(spark, sf),
                                 HYBRID_KEYWORDS, HYBRID_FILTERS))


def q_filter_spec(spark: SparkSession, sf: str) -> DataFrame:
    """All documents passing the filter spec (B3-B8), no ranking."""
    prepare(spark)
    from quire.operators.predicates import compile_filters
    return table(spark, sf, "documents").filter(compile_filters(FILTERS)).select("doc_id", "lang", "n_chars")


def _orders_story(spark, sf):
    """Dated stories composed from orders: article time, a dateline whose day
    may differ from the article day, and relative-date words."""
    o = table(spark, sf, "orders")
    dt = (F.col("o_orderdate")
          + F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 24).cast("int"),
                               (F.col("o_orderkey") % 60).cast("int")))
    dline = F.dayofmonth(F.col("o_orderdate") - F.make_dt_interval((F.col("o_custkey") % 40).cast("int")))
    content = F.concat(F.lit("（晨光社台北"), dline.cast("string"), F.lit("日電）"), F.col("o_orderstatus"),
                       F.lit("：今天與昨天，明後天，本月、上個月及去年"))
    return o.select(F.col("o_orderkey").cast("string").alias("pid"), dt.alias("dt"), content.alias("content"))


def q_story_date(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.functions.dates import story_date
    o = _orders_story(spark, sf)
    return o.select("pid", story_date(F.col("dt"), F.col("content"), "v1").alias("story_v1"),
                    story_date(F.col("dt"), F.col("content"), "v2").alias("story_v2"),
                    story_date(F.col("dt"), F.col("content"), "calendar").alias("story_cal"))


def q_relative_date(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.functions.dates import resolve_relative_dates, story_date
    # the story date is a column of its own so the eleven replacements reuse it
    o = _orders_story(spark, sf).withColumn("story", story_date(F.col("dt"), F.col("content"), "v2"))
    return o.select("pid", resolve_relative_dates(F.col("content"), F.col("story")).alias("resolved"))


def q_day_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Relative words, month-day and bare-day mentions resolved against the
    story date (I3, I4, the date part of K14)."""
    prepare(spark)
    from quire.functions.dates import resolve_day_mentions, resolve_relative_dates, story_date
    o = _orders_story(spark, sf).join(
        table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("pid"), "o_orderdate"), "pid")
    text = F.concat(F.col("content"), F.lit("，"), F.month("o_orderdate").cast("string"), F.lit("月"),
                    F.dayofmonth("o_orderdate").cast("string"), F.lit("日開會，另於3日表決"))
    o = o.withColumn("story", story_date(F.col("dt"), F.col("content"), "v2")).withColumn("t", text)
    o = o.withColumn("rel", resolve_relative_dates(F.col("t"), F.col("story")))
    return o.select("pid", resolve_day_mentions(F.col("rel"), F.col("story")).alias("resolved"))


def q_html_text(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.functions.text import clean_article
    return table(spark, sf, "pages").select("page_id", clean_article(F.col("html")).alias("text"))


def q_list_items(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.sources.html import list_items
    return list_items(table(spark, sf, "pages"), "page_id", "html").select("page_id", "pos", "url", "title")


# Share channel per page language on driver data.
LANG_CHANNEL = {"en": "FB", "fr": "LINE", "de": "YOUTUBE", "es": "IG"}


def q_url_ids(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.functions.text import article_id, topic_id, utm_url
    p = table(spark, sf, "pages").select("page_id", "url")
    lang = F.regexp_extract(F.col("url"), r"^https?://[^/]+/([a-z]{2})/", 1)
    chan = F.create_map(*[x for k, v in LANG_CHANNEL.items() for x in (F.lit(k), F.lit(v))])
    return p.select("page_id", topic_id(F.col("url")).alias("topic_id"),
                    article_id(F.col("url"), r"/(\d+)").alias("article_id"),
                    utm_url(F.col("url"), F.coalesce(F.try_element_at(chan, lang), F.lit(""))).alias("share_url"))


# Scan day, range and the polling clock on the events table.
SCAN_DAY = "2024-01-02"
SCAN_RANGE = ("2024-01-03", "2024-01-05")
NOW = "2024-01-04 12:00:00"


def _events(spark, sf):
    return table(spark, sf, "events")


def _story_key():
    """A story id with several hits: one per (user, event type)."""
    return F.concat(F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"))


def q_day_scan(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.sources.scans import day_scan, hit_count
    e = _events(spark, sf)
    page = day_scan(e, "ts", SCAN_DAY, [F.col("ts"), F.col("event_id")])
    total = hit_count(day_scan(e, "ts", SCAN_DAY, [F.col("event_id")], limit=None)).first()[0]
    return page.select("event_id", "ts", "user_id", F.lit(total).cast("long").alias("total"))


def q_date_range(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.sources.scans import date_range_scan, hit_count
    e = _events(spark, sf)
    found = date_range_scan(e, "ts", *SCAN_RANGE, order=[F.col("ts"), F.col("event_id")])
    total = hit_count(found).first()[0]
    return found.select("event_id", "ts", "event_type", F.lit(total).cast("long").alias("total"))


def q_settled_new(spark: SparkSession, sf: str) -> DataFrame:
    """All hits of stories with a settled, not-yet-done hit; done = stories
    already seen before the scan day (pid = user/event type)."""
    prepare(spark)
    from quire.sources.scans import settled_new
    e = _events(spark, sf).withColumn("pid", _story_key())
    done = e.filter(F.col("ts") < F.lit(SCAN_DAY).cast("timestamp_ntz")).select("pid")
    return settled_new(e, done, "pid", "ts", NOW).select("event_id", "pid", "ts")


def q_settled_reference(spark: SparkSession, sf: str) -> DataFrame:
    """Same selection with the repeated-hit multiplicity of the original poller."""
    prepare(spark)
    from quire.sources.scans import settled_new
    e = _events(spark, sf).withColumn("pid", _story_key())
    done = e.filter(F.col("ts") < F.lit(SCAN_DAY).cast("timestamp_ntz")).select("pid")
    out = settled_new(e, done, "pid", "ts", NOW, multiplicity="reference")
    return out.groupBy("pid").agg(F.count(F.lit(1)).alias("n_rows"))


def q_projection_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Article projection with defaults and the focus flag."""
    prepare(spark)
    from quire.plans.digest import flag_membership
    a = articles(spark, sf)
    focus_ids = table(spark, sf, "labels").filter(F.col("toxic") == 1).select("doc_id")
    a = flag_membership(a, focus_ids, "pid", "focus")
    return a.select("pid", "dt", "h1", "focus", "extender", "attachments", "category")


def q_exclude_regex(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.plans.digest import exclude_routine
    return exclude_routine(articles(spark, sf), DEMO_EXCLUDE).select("pid")


def q_topic_score(spark: SparkSession, sf: str) -> DataFrame:
    """Topic-article scoring on orders: topic = customer, published date =
    order date, extender = line count of the order (D3, E5, I13, B11)."""
    prepare(spark)
    from quire.operators.scoring import topic_article_score
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("extender"))
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("tno"), F.col("o_orderkey").alias("l_orderkey"),
        F.to_date("o_orderdate").alias("published_dt"))
    o = o.join(li, "l_orderkey", "left").fillna({"extender": 0})
    s = topic_article_score(o.withColumnRenamed("l_orderkey", "pid"), "tno", "published_dt", "extender", "pid")
    return s.select("tno", "pid", "date_weight", _r("score").alias("score"))


def _related(spark, sf, mode):
    from quire.plans.related import related_articles
    a = articles(spark, sf, with_embeddings=True)
    done = table(spark, sf, "labels").filter(F.col("quality") == 1).select(F.col("doc_id").cast("string").alias("pid"))
    rel = related_articles(a.filter(F.col("category") != "src0"), a.filter(F.col("category") == "src0"), done,
                           "doc_id", "embeddings", 3, threshold=0.3, mode=mode)
    return rel.select("pid", "rank", "related_url", _r("sim").alias("sim"))


def q_related(spark: SparkSession, sf: str) -> DataFrame:
    """Top-3 related articles (cosine > threshold, self excluded) for every
    not-done article among current and earlier articles (C8, G1, C1, E7)."""
    prepare(spark)
    return _related(spark, sf, "default")


def q_related_reference(spark: SparkSession, sf: str) -> DataFrame:
    """The original ranking: self included, low similarities clamped to 0, ranks 2..4."""
    prepare(spark)
    return _related(spark, sf, "reference")


def q_token_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Token count per document and budget totals per source."""
    prepare(spark)
    from quire.functions.tokens import token_count
    d = table(spark, sf, "documents").select("source", token_count(F.col("text")).alias("n_tokens"))
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"),
                                   F.max("n_tokens").alias("max_tokens"))


QUERIES = {
    "q_keyword_score": q_keyword_score,
    "q_keyword_hits": q_keyword_hits,
    "q_article_score": q_article_score,
    "q_article_top": q_article_top,
    "q_nn_distance": q_nn_distance,
    "q_edges": q_edges,
    "q_eps": q_eps,
    "q_dbscan": q_dbscan,
    "q_dbscan_auto": q_dbscan_auto,
    "q_dbscan_two_stage": q_dbscan_two_stage,
    "q_dbscan_minpts": q_dbscan_minpts,
    "q_dbscan_grouped": q_dbscan_grouped,
    "q_cluster_articles": q_cluster_articles,
    "q_cluster_rank": q_cluster_rank,
    "q_cluster_pick": q_cluster_pick,
    "q_cluster_rank_fixed": q_cluster_rank_fixed,
    "q_singles": q_singles,
    "q_photo_count": q_photo_count,
    "q_cluster_rank_by_source": q_cluster_rank_by_source,
    "q_digest_by_source": q_digest_by_source,
    "q_cluster_pick_fixed": q_cluster_pick_fixed,
    "q_match": q_match,
    "q_term": q_term,
    "q_index_search": q_index_search,
    "q_vector": q_vector,
    "q_vector_term": q_vector_term,
    "q_vector_filtered": q_vector_filtered,
    "q_hybrid": q_hybrid,
    "q_filter_spec": q_filter_spec,
    "q_story_date": q_story_date,
    "q_relative_date": q_relative_date,
    "q_day_mentions": q_day_mentions,
    "q_html_text": q_html_text,
    "q_list_items": q_list_items,
    "q_url_ids": q_url_ids,
    "q_day_scan": q_day_scan,
    "q_date_range": q_date_range,
    "q_settled_new": q_settled_new,
    "q_settled_reference": q_settled_reference,
    "q_projection_defaults": q_projection_defaults,
    "q_exclude_regex": q_exclude_regex,
    "q_topic_score": q_topic_score,
    "q_related": q_related,
    "q_related_reference": q_related_reference,
    "q_token_stats": q_token_stats,
}

from quire.plans.catalog_text import TEXT_QUERIES  # noqa: E402

QUERIES.update(TEXT_QUERIES)

from quire.plans.catalog_digest import DIGEST_QUERIES  # noqa: E402

QUERIES.update(DIGEST_QUERIES)

from quire.plans.catalog_io import IO_QUERIES  # noqa: E402

QUERIES.update(IO_QUERIES)

from quire.plans.catalog_more import MORE_QUERIES  # noqa: E402

QUERIES.update(MORE_QUERIES)
