"""Table sinks and sheet-style table edits.

A "sheet" is a table with a 1-based ``row_num`` column (row 1 is the header
in the spreadsheet this replaces, so data starts at 2). Edits are keyed
DataFrame transformations; writes go to Hadoop paths through the
DataFrameWriter so they land on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TSV = {"sep": "\t", "header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "lineSep": "\n",
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Tab-separated UTF-8 with a header (A9); a dated run partitions by ``dt=``.
    Line breaks, quotes and outer blanks of a text come back as they were; an
    empty text is written quoted, which tells it from null."""
    w = df.write.mode(mode).options(**TSV)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_tsv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**TSV, multiLine=True).csv(path)


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, UTF-8 unescaped (A10)."""
    df.write.mode(mode).json(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table contents."""
    df.write.mode("overwrite").format(fmt).save(path)


def append(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows; when the table exists its columns are matched by name."""
    if path_exists(spark, path):
        existing = spark.read.format(fmt).load(path).columns
        missing = set(existing) ^ set(df.columns)
        if missing:
            raise ValueError(f"column mismatch on append: {sorted(missing)}")
        df = df.select(*existing)
    df.write.mode("append").format(fmt).save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def create_with_suffix(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Create ``path``, or ``path_1`` if it is taken (A14); returns the path used."""
    target = path if not path_exists(spark, path) else f"{path}_1"
    if path_exists(spark, target):
        raise FileExistsError(target)
    df.write.mode("errorifexists").format(fmt).save(target)
    return target


def column_mapped_write(target: DataFrame, source: DataFrame, to_cols: list[str], start_row: int = 2) -> DataFrame:
    """The i-th source column goes to ``to_cols[i]`` from ``start_row`` on (A13):
    source rows are numbered from ``start_row`` and joined on ``row_num``;
    rows outside the written range keep their values."""
    if "_src_row" not in source.columns:
        raise ValueError("source needs a 0-based _src_row column giving its order")
    data = [c for c in source.columns if c != "_src_row"]
    if len(to_cols) > len(data):
        raise ValueError("more target columns than source columns")
    src = source.select(*[F.col(c).alias(f"_src{i}") for i, c in enumerate(data[:len(to_cols)])],
                        (F.col("_src_row") + F.lit(start_row)).alias("row_num"))
    out = target.join(src, "row_num", "full_outer")
    for i, c in enumerate(to_cols):
        cur = F.col(c) if c in target.columns else F.lit(None)
        out = out.withColumn(c, F.coalesce(F.col(f"_src{i}").cast("string"), cur.cast("string")))
    return out.drop(*[f"_src{i}" for i in range(len(to_cols))])


def publish_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fixed column subset before a write, e.g. without the embeddings."""
    return df.select(*[c for c in columns if c in df.columns])


def cell(df: DataFrame, row_num: int, column: str) -> DataFrame:
    """One cell as a one-row table."""
    return df.filter(F.col("row_num") == row_num).select(F.col(column).alias("value"))


def update_cell(df: DataFrame, key_col: str, key, column: str,
                value: Column | Callable[[Column], Column]) -> DataFrame:
    """Write a value, or a ``Column -> Column`` function of the current
    value (M2), into one keyed cell (A16)."""
    new = value(F.col(column)) if callable(value) else value
    return df.withColumn(column, F.when(F.col(key_col) == F.lit(key), new).otherwise(F.col(column)))


def clear_range(df: DataFrame, first_row: int, last_row: int | None, columns: list[str]) -> DataFrame:
    """Blank the cells of ``columns`` in rows ``first_row..last_row`` (A17);
    ``last_row=None`` runs to the end (``A2:Z`` keeps the header)."""
    in_range = F.col("row_num") >= first_row
    if last_row is not None:
        in_range = in_range & (F.col("row_num") <= last_row)
    for c in columns:
        df = df.withColumn(c, F.when(in_range, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return df


def last_non_blank_row(df: DataFrame, columns: list[str], group: list[str] | None = None) -> DataFrame:
    """Largest row number with any non-blank cell (A18); null when none."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")) != "" for c in columns]
    any_cell = blank[0]
    for b in blank[1:]:
        any_cell = any_cell | b
    rows = df.filter(any_cell)
    if group:
        return rows.groupBy(*group).agg(F.max("row_num").alias("last_row"))
    return rows.agg(F.max("row_num").alias("last_row"))
