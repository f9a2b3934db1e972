"""Bronze partitions and silver/gold tables as partitioned Parquet.

Layout: ``<root>/source=<s>/ingest_date=<yyyy-mm-dd>/part-*.parquet``.  Writes use
dynamic partition overwrite, so re-landing a (source, ingest_date) replaces
exactly that partition (idempotent) and leaves the others alone.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bronze(df: DataFrame, root: str, source: str | None = None, ingest_date=None,
                 ingest_ts: dt.datetime | None = None) -> None:
    """Add audit columns and overwrite the touched (source, ingest_date) partitions only.

    ``source``/``ingest_date`` may be constants or already be columns of ``df``
    (many partitions in one write)."""
    ts = ingest_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = df
    if source is not None:
        out = out.withColumn("source", F.lit(source))
    if ingest_date is not None:
        out = out.withColumn("ingest_date", F.lit(str(ingest_date)))
    out = out.withColumns({"_ingest_date": F.col("ingest_date"), "_ingest_ts": F.lit(ts)})
    # rebalance: rows of a partition meet, but a large partition is split over tasks and files
    (out.hint("rebalance", F.col("source"), F.col("ingest_date"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy("source", "ingest_date").parquet(root))


def read_bronze(spark: SparkSession, root: str, source: str | None = None, start=None, end=None,
                require: bool = False) -> DataFrame:
    """Partition-pruned read of [start, end] (inclusive) on ``ingest_date``."""
    df = spark.read.option("basePath", root).parquet(root)
    if source is not None:
        df = df.where(F.col("source") == source)
    d = F.col("ingest_date").cast("string")
    if start is not None:
        df = df.where(d >= str(start))
    if end is not None:
        df = df.where(d <= str(end))
    if require and df.limit(1).count() == 0:
        raise FileNotFoundError(f"no bronze partitions for {source} in [{start}, {end}]")
    return df


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_partitions(spark: SparkSession, root: str, source: str | None = None) -> DataFrame:
    """The (source, ingest_date) keys, from the folder names alone; no file is opened."""
    fs, p = _file_system(spark, f"{root}/source=*/ingest_date=*")
    keys = [tuple(unquote(x.partition("=")[2]) for x in str(s.getPath()).rsplit("/", 2)[1:]) for s in fs.globStatus(p) or ()]
    return spark.createDataFrame([k for k in keys if source in (None, k[0])], "source string, ingest_date string")


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Replace a silver/gold table (never the path it is read from)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Rows, columns, size in MB (from the file system's listing), min/max date of a written table."""
    fs, p = _file_system(spark, path)
    df = read_table(spark, path)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("n_columns"), F.lit(",".join(df.columns)).alias("columns"),
                  F.lit(round(fs.getContentSummary(p).getLength() / 1e6, 2)).alias("size_mb"),
                  F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def truncation_warnings(bronze: DataFrame, limit: int = 1000) -> DataFrame:
    """Partitions whose row count reaches the API page size (may be cut)."""
    return (bronze.groupBy("source", "ingest_date").agg(F.count(F.lit(1)).alias("rows"))
                  .where(F.col("rows") >= limit))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with header."""
    df.write.mode("overwrite").option("header", True).csv(path)
