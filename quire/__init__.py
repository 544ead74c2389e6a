"""quire: a Spark-native engine for searching, clustering and digesting article corpora.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``DataFrame.transform``) or a function that builds a ``Column``. Work runs as
Spark jobs; Python code inside tasks is limited to small per-batch helpers.
"""

__version__ = "0.1.0"
