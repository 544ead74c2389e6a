"""Registered queries for sinks, sheet-style edits, streaming and embeddings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import checkpoint_dir, prepare
from quire.sources.tables import table

# The three polling clocks of the streaming ingest and the
# instant the landing directory receives its second drop.
STREAM_NOW = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-06-01 00:00:00")
SECOND_DROP = "2024-01-15 00:00:00"


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _sheet(spark, sf):
    c = table(spark, sf, "customer")
    return c.select((F.col("c_custkey") + 2).alias("row_num"), F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("segment"), "c_custkey")


def q_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """TSV and JSON sinks, create-with-suffix and append, read back."""
    prepare(spark)
    from quire.sources import sinks
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    base = _scratch(spark, "sink")
    sinks.write_tsv(c, f"{base}/tsv")
    sinks.write_json_records(c, f"{base}/json")
    first = sinks.create_with_suffix(spark, c, f"{base}/table")
    second = sinks.create_with_suffix(spark, c, f"{base}/table")
    sinks.append(spark, c, second)
    tsv = sinks.read_tsv(spark, f"{base}/tsv", c.schema)
    js = spark.read.schema(c.schema).json(f"{base}/json").select(F.col("c_custkey"), F.lit(1).alias("in_json"))
    copies = (spark.read.parquet(second).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("copies")))
    assert first.endswith("/table") and second.endswith("/table_1")
    return tsv.join(js, "c_custkey").join(copies, "c_custkey")


def q_sheet_ops(spark: SparkSession, sf: str) -> DataFrame:
    """Point transform (A16), range clear (A17) and a column-mapped write
    of per-customer order counts (A13) on the customer sheet."""
    prepare(spark)
    from quire.sources import sinks
    sheet = _sheet(spark, sf)
    sheet = sinks.update_cell(sheet, "row_num", 5, "name", lambda c: F.lower(c))
    sheet = sinks.clear_range(sheet, 3, 6, ["segment"])
    counts = (table(spark, sf, "customer").join(
        table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")),
        F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(F.col("c_custkey").alias("_src_row"), F.coalesce("n", F.lit(0)).alias("n")))
    out = sinks.column_mapped_write(sheet.drop("c_custkey"), counts, ["orders_n"], start_row=2)
    return out.select("row_num", "name", "segment", "orders_n")


def q_last_row(spark: SparkSession, sf: str) -> DataFrame:
    """Last non-blank row per segment, blanks = non-positive balances (A18),
    plus one cell lookup (A15)."""
    prepare(spark)
    from quire.sources import sinks
    c = table(spark, sf, "customer")
    sheet = c.select((F.col("c_custkey") + 2).alias("row_num"), "c_mktsegment",
                     F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(F.lit("")).alias("name"))
    last = sinks.last_non_blank_row(sheet, ["name"], ["c_mktsegment"])
    return last.join(sheet.select(F.col("row_num").alias("last_row"), F.col("name").alias("last_name")),
                     "last_row")


def _land(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Three availableNow runs over a landing directory that grows before the
    second only; the third releases what has settled meanwhile (L1)."""
    prepare(spark)
    from quire.streaming.ingest import run_settled_ingest, selected
    ev = table(spark, sf, "events")
    base = _scratch(spark, "ingest")
    key = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"))
    cut = F.lit(SECOND_DROP).cast("timestamp_ntz")
    _land(ev.filter(F.col("ts") < cut), f"{base}/landing")
    run_settled_ingest(spark, f"{base}/landing", ev.schema, f"{base}/state", key, "ts", STREAM_NOW[0])
    _land(ev.filter(F.col("ts") >= cut), f"{base}/landing")
    for now in STREAM_NOW[1:]:
        run_settled_ingest(spark, f"{base}/landing", ev.schema, f"{base}/state", key, "ts", now)
    runs = F.array(*[F.lit(n).cast("timestamp_ntz") for n in STREAM_NOW])
    return selected(spark, f"{base}/state").select("event_id", "pid", "ts", (F.array_position(runs, F.col("run_at")) - 1).cast("int").alias("batch"))


def q_stream_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Request validation over a landing directory, two drops (L2)."""
    prepare(spark)
    from quire.plans.catalog_text import requests_table
    from quire.streaming.requests import run_request_stream
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    req = requests_table(spark, sf).join(conv, ["conv_id", "turn"])
    base = _scratch(spark, "requests")
    schema = req.drop("role").schema
    for cond in (F.col("role") == "user", F.col("role") != "user"):
        _land(req.filter(cond).drop("role"), f"{base}/landing")
        run_request_stream(spark, f"{base}/landing", schema, f"{base}/state", "body", ["conv_id", "turn"])
    valid = spark.read.parquet(f"{base}/state/valid").select(
        "conv_id", "turn", "text", F.lit(None).cast("string").alias("reason"), "batch")
    bad = spark.read.parquet(f"{base}/state/quarantine").select(
        "conv_id", "turn", F.lit(None).cast("string").alias("text"), "reason", "batch")
    return valid.unionByName(bad)


def q_embed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Hashed TF-IDF embeddings of every document (K11); checked by rows."""
    prepare(spark)
    from quire.plans.embed import embed_hashed
    e = embed_hashed(table(spark, sf, "documents"), "doc_id", "text", 256)
    return e.select("doc_id", F.size("embedding").alias("dim"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm2"))


IO_QUERIES = {
    "q_sink_roundtrip": q_sink_roundtrip,
    "q_sheet_ops": q_sheet_ops,
    "q_last_row": q_last_row,
    "q_stream_ingest": q_stream_ingest,
    "q_stream_requests": q_stream_requests,
    "q_embed_text": q_embed_text,
}
