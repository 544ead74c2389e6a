"""Batch embedding of a text column.

``embed_with`` runs an injected embedder (pandas Series of text -> list of
vectors) in ``mapInPandas``, so model calls are batched by Arrow and spread
over tasks. The built-in embedder is the pyspark.ml chain HashingTF -> IDF ->
Normalizer on our tokens: the IDF fit is one aggregate of a fixed-size
vector, and the transform is per row.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.tokens import tokens

Embedder = Callable[[pd.Series], list]


def embed_hashed(df: DataFrame, key: str, text_col: str, dim: int = 256) -> DataFrame:
    """(key, embedding array<double>) with unit-length TF-IDF hashed vectors."""
    t = df.select(key, tokens(F.col(text_col)).alias("_tok"))
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim).transform(t)
    idf = IDF(inputCol="_tf", outputCol="_tfidf").fit(tf).transform(tf)
    unit = Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0).transform(idf)
    return unit.select(key, vector_to_array("_unit").alias("embedding"))


def embed_with(df: DataFrame, key: str, text_col: str, embedder: Embedder) -> DataFrame:
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            vecs = embedder(b[text_col])
            yield pd.DataFrame({key: b[key], "embedding": [list(map(float, v)) for v in vecs]})
    return df.select(key, text_col).mapInPandas(run, f"{key} {key_type}, embedding array<double>")
