"""Hand-worked literal cases for the scalar text and date expressions."""

import datetime as dt

from pyspark.sql import functions as F

from quire.functions import dates, text


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys()))
    return df.select(expr.alias("r")).first()["r"]


def ts(s):
    return dt.datetime.strptime(s, "%Y/%m/%d %H:%M")


def _story(spark, created, content, variant):
    df = spark.createDataFrame([(created, content)], "created string, content string")
    return df.select(dates.story_date(dates.parse_minute_time(F.col("created")), F.col("content"),
                                      variant).alias("r")).first()["r"]


def test_story_date_variants(spark):
    cases = [
        ("2024/10/15 13:07", "（晨光社台北15日電）", "2024/10/15 13:07", "2024/10/15 13:07", "2024/10/15 13:07"),
        ("2024/10/15 13:07", "（晨光社台北14日電）", "2024/10/14 13:07", "2024/10/14 13:07", "2024/10/14 13:07"),
        ("2024/11/01 09:00", "（晨光社台北31日電）", "2024/12/01 09:00", "2024/11/01 09:00", "2024/10/31 09:00"),
        ("2024/11/02 09:00", "（晨光社台北30日電）", "2024/11/30 09:00", "2024/10/30 09:00", "2024/10/30 09:00"),
        ("2024/10/15 13:07", "no day here", "2024/10/15 13:07", "2024/10/15 13:07", "2024/10/15 13:07"),
        ("2024/10/15 13:07", "x" * 40 + "3日", "2024/10/15 13:07", "2024/10/15 13:07", "2024/10/15 13:07"),
    ]
    for created, content, v1, v2, cal in cases:
        assert _story(spark, created, content, "v1") == ts(v1)
        assert _story(spark, created, content, "v2") == ts(v2)
        assert _story(spark, created, content, "calendar") == ts(cal)


def test_relative_dates(spark):
    df = spark.createDataFrame([(ts("2024/10/15 00:00"), "前天昨天今天明天明後天本月上個月下個月今年去年明年"),
                                (ts("2024/03/31 00:00"), "上個月、下個月")], "s timestamp_ntz, t string")
    got = [r[0] for r in df.select(dates.resolve_relative_dates(F.col("t"), F.col("s"))).collect()]
    assert got[0] == ("前天（2024年10月13日）昨天（2024年10月14日）今天（2024年10月15日）明天（2024年10月16日）"
                      "明後天（2024年10月16日、2024年10月17日）本月10月上個月（09月）下個月（11月）"
                      "今年（2024年）去年（2023年）明年（2025年）")
    assert got[1] == "上個月（02月）、下個月（04月）"


def test_day_mentions(spark):
    df = spark.createDataFrame([(ts("2024/10/15 00:00"), "台北15日電 本月10月9日 另於2日 與11月15日")],
                               "s timestamp_ntz, t string")
    got = df.select(dates.resolve_day_mentions(F.col("t"), F.col("s"))).first()[0]
    assert got == ("台北15日（2024年10月15日）電 本月10月9日（2024年10月09日） 另於2日（2024年10月02日） "
                   "與11月15日（2024年11月15日）")


def test_byline_removal(spark):
    df = spark.createDataFrame([("內文。（編輯：王甲／李乙）1131015",), ("內文（註）後文",), ("內文 (abc)",)], "c string")
    got = [r[0] for r in df.select(text.clean_article(F.col("c"))).collect()]
    assert got == ["內文。", "內文（註）後文", "內文 "]


def test_strip_tags_and_marker(spark):
    html = '<p>a(*#*)b &amp; c</p><script>var t="</p>";</script><!-- x --><style>p{}</style>d'
    df = spark.createDataFrame([(html,)], "c string")
    assert df.select(text.clean_article(F.col("c"))).first()[0] == "ab & cd"


def test_photo_count(spark):
    df = spark.createDataFrame(
        [([("extender", "u1|$@$|u2"), ("extender", None), ("photo", "u3")],)],
        "photos array<struct<iType:string,Photo:string>>")
    assert df.select(text.photo_url_count(F.col("photos"))).first()[0] == 3
    assert df.select(text.attachment_count(F.col("photos"))).first()[0] == 3


def test_topic_and_article_id(spark):
    df = spark.createDataFrame([("https://h/topic/newstopic/4604.aspx",), ("https://h/news/1.aspx",)], "u string")
    got = [r[0] for r in df.select(text.topic_id(F.col("u"))).collect()]
    assert got == ["4604", None]


def test_utm(spark):
    df = spark.createDataFrame([("http://x/1", "FB"), ("http://x/1?a=1", "IG"), ("http://x/1", "")], "u string, c string")
    got = [r[0] for r in df.select(text.utm_url(F.col("u"), F.col("c"))).collect()]
    assert got == ["http://x/1?utm_source=site.facebook&utm_medium=share&utm_campaign=fbuser",
                   "http://x/1?a=1&utm_source=instagram&utm_medium=share", "http://x/1"]


def test_pos_filter_and_entities(spark):
    words = ["總統", "今天", "在", "台北", "，", "宣布", "不", "的", "。"]
    tags = ["Na", "Nd", "P", "Nc", "COMMACATEGORY", "VE", "D", "DE", "PERIODCATEGORY"]
    ents = [("台北", "GPE"), ("王", "PERSON"), ("台北", "GPE"), ("六", "CARDINAL"), ("中研院", "ORG")]
    df = spark.createDataFrame([(words, tags, ents)],
                               "w array<string>, t array<string>, e array<struct<text:string,type:string>>")
    assert df.select(text.pos_filter(F.col("w"), F.col("t"))).first()[0] == "總統今天台北 宣布不 "
    assert df.select(text.entity_words(F.col("e"))).first()[0] == "中研院 台北"


def test_name_list_and_annotation(spark):
    bracket = "['王甲|部長', '約翰|John|執行長']"
    lines = "王甲|部長\n\n約翰|John|執行長 \n"
    df = spark.createDataFrame([(bracket,), (lines,), ("[not json",)], "s string")
    got = [r[0] for r in df.select(text.parse_name_list(F.col("s"))).collect()]
    assert got[0] == got[1] == ["王甲|部長", "約翰|John|執行長"]
    assert got[2] == []
    df2 = spark.createDataFrame([("約翰見王甲", ["王甲|部長", "約翰|John|執行長"])], "t string, n array<string>")
    got = df2.select(text.annotate_names(F.col("t"), text.name_entries(F.col("n")))).first()[0]
    assert got == "約翰（John，執行長）見王甲（部長）"


def test_category_url(spark):
    df = spark.createDataFrame([("政治", "1"), ("x", "2")], "c string, p string")
    got = [r[0] for r in df.select(text.category_url(F.col("c"), F.col("p"))).collect()]
    assert got == ["aipl/1", "None/2"]
