"""Canonical schemas and defaults."""

from __future__ import annotations

from pyspark.sql import types as T

# (column, default) of the article table; None = no default.
ARTICLE_COLUMNS = [
    ("pid", None),
    ("dt", None),
    ("h1", ""),
    ("article", ""),
    ("text", ""),
    ("embeddings", None),
    ("focus", 0),
    ("extender", 0),
    ("attachments", 0),
    ("category", ""),
]

ARTICLE_SCHEMA = T.StructType([
    T.StructField("pid", T.StringType()),
    T.StructField("dt", T.TimestampNTZType()),
    T.StructField("h1", T.StringType()),
    T.StructField("article", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("embeddings", T.ArrayType(T.FloatType())),
    T.StructField("focus", T.IntegerType()),
    T.StructField("extender", T.IntegerType()),
    T.StructField("attachments", T.IntegerType()),
    T.StructField("category", T.StringType()),
])

PHOTO = T.StructType([T.StructField("iType", T.StringType()), T.StructField("Photo", T.StringType())])

ARTICLE_JSON_SCHEMA = T.StructType([
    T.StructField("ResultData", T.StructType([
        T.StructField("News", T.StructType([
            T.StructField("Id", T.StringType()),
            T.StructField("Title", T.StringType()),
            T.StructField("Content", T.StringType()),
            T.StructField("Keywords", T.StringType()),
            T.StructField("TypeName", T.StringType()),
            T.StructField("Photos", T.ArrayType(PHOTO)),
        ])),
        T.StructField("MetaData", T.StructType([T.StructField("DateCreated", T.StringType())])),
    ])),
])

TOPIC_JSON_SCHEMA = T.StructType([
    T.StructField("tno", T.LongType()),
    T.StructField("ResultData", T.StructType([
        T.StructField("Items", T.ArrayType(T.StructType([
            T.StructField("Id", T.StringType()),
            T.StructField("CreateTime", T.StringType()),
            T.StructField("HeadLine", T.StringType()),
        ]))),
    ])),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("content", T.ArrayType(T.StringType())),
    T.StructField("entity_list", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("name_list", T.ArrayType(T.StringType())),
])
