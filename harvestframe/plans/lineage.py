"""L1-L3: run records, dataset digest, pipeline metrics - as rows, not as a tracking server."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestframe.config import Config
from harvestframe.operators.stats import cumulative_buckets


#: Seeds of the two 64-bit halves of a row's hash.
SEEDS = (0x5EED, 0xD16E57)


def row_hashes(cols: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row. Spark's hash skips NULLs, so each column goes in with its place and whether it is NULL."""
    parts = [x for i, c in enumerate(cols) for x in (F.lit(i), F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in SEEDS]


def digest_of(cols: Sequence[str]) -> Column:
    """Sums and exclusive ors of the row hashes: the sums count repeated rows, neither knows an order."""
    sums = [F.sum(h.cast("decimal(38,0)")).cast("string") for h in row_hashes(cols)]
    xors = [F.bit_xor(h).cast("string") for h in row_hashes(cols)]
    return F.concat_ws(":", *sums, *xors)


def dataset_digest(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """L2: order-insensitive content digest (rows, digest) of a multiset of rows.

    Same rows in any order or partitioning give the same digest; one pass, partial
    aggregation, nothing collected. Rows that differ in where a NULL is, or in how often
    they occur, give another one. No rows: an empty sum."""
    return df.agg(F.count(F.lit(1)).alias("rows"), digest_of(list(cols or df.columns)).alias("digest"))


def run_record(run_id: str, metrics: dict, params: dict, gold: DataFrame, code_version: str) -> DataFrame:
    """L1: one row describing a training run; append it to a Parquet ``runs`` table."""
    mp = F.create_map(*[x for k, v in metrics.items() for x in (F.lit(k), F.lit(float(v)))]) if metrics \
        else F.create_map().cast("map<string,double>")
    pp = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]) if params \
        else F.create_map().cast("map<string,string>")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return gold.agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("start_date"),
                    F.max("date").alias("end_date"), digest_of(gold.columns).alias("digest")).select(
        F.lit(run_id).alias("run_id"), F.lit(now).alias("created_at"), F.lit(code_version).alias("code_version"),
        mp.alias("metrics"), pp.alias("params"), "rows", "start_date", "end_date", "digest")


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def pipeline_metrics(silver: DataFrame, feature_cols: Sequence[str], verdict: DataFrame) -> DataFrame:
    """L3 gauges: silver rows, feature count, quality 1/0 (all series passed)."""
    s = silver.select(F.lit(1).alias("__r"), F.lit(None).cast("boolean").alias("__p"))
    q = verdict.where(F.col("check") == "overall").select(F.lit(0).alias("__r"), F.col("passed").alias("__p"))
    return s.unionByName(q).agg(
        F.sum("__r").cast("bigint").alias("silver_rows"),
        F.lit(len(feature_cols)).cast("bigint").alias("gold_features"),
        F.coalesce(F.bool_and("__p"), F.lit(False)).cast("bigint").alias("quality_passed"))


def prediction_histogram(pred: DataFrame, col: str = "prediction", cfg: Config = Config(),
                         keys: Sequence[str] = ()) -> DataFrame:
    """L3 histogram of predictions with the reference's bucket edges (cumulative counts)."""
    v = F.col(col)
    aggs = cumulative_buckets(v, cfg.model.prediction_buckets) + [F.sum(v).alias("sum")]
    return pred.groupBy(*keys).agg(*aggs) if keys else pred.agg(*aggs)
