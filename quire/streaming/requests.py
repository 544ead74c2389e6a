"""Streaming request validation (L2): request files arrive in a landing
directory; each micro-batch is split into valid requests and a quarantine
with the reason, written per batch id (idempotent on replay)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.sources.json_docs import validate_requests


def run_request_stream(spark: SparkSession, landing: str, schema, state: str,
                       json_col: str = "body", key_cols: list[str] | None = None) -> None:
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        valid, bad = validate_requests(batch, json_col, key_cols)
        for df, name in ((valid, "valid"), (bad, "quarantine")):
            # a folder of its own for each batch, with a file even if there are no rows: what is empty can be read
            df.write.mode("overwrite").parquet(f"{state}/{name}/batch={batch_id}")

    q = (spark.readStream.schema(schema).parquet(landing).writeStream
         .foreachBatch(on_batch).trigger(availableNow=True)
         .option("checkpointLocation", f"{state}/_checkpoint").start())
    q.awaitTermination()
