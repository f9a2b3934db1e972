"""File-source stream -> bronze, idempotent per (source, ingest_date), late corrections allowed.

``readStream`` over the landing folder with ``Trigger.AvailableNow`` processes
whatever arrived since the last checkpoint and stops; ``foreachBatch`` writes with
dynamic partition overwrite.  Landing is laid out like bronze, by partition, so a
micro-batch re-reads only the partitions it touches, not the folder's history.  Of
rows with one natural key the latest landed file counts: a correction replaces the
row.  A replayed batch (after an executor or driver loss) rewrites the same
partitions with the same rows, so the sink stays exactly-once in effect.  Row-frame
windows are not supported on streams: features run in batch on the bronze output.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestframe.operators.reshape import dedupe_keep
from harvestframe.sources.bronze import write_bronze


def land_stream(spark: SparkSession, landing: str, schema: T.StructType, bronze_root: str, checkpoint: str,
                natural_key: Sequence[str], fmt: str = "parquet", partition_cols=("source", "ingest_date")):
    """Start an AvailableNow stream; returns the StreamingQuery (call ``awaitTermination``)."""
    stream = spark.readStream.schema(schema).format(fmt).load(landing)
    keys = [*partition_cols, *natural_key]

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        touched = batch.select(*partition_cols).distinct().collect()  # partitions of one micro-batch
        if not touched:
            return
        here = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c) == r[c] for c in partition_cols]) for r in touched])
        full = spark.read.schema(schema).format(fmt).load(landing).where(here)
        full = full.select("*", F.col("_metadata.file_modification_time").alias("__landed"), F.col("_metadata.file_path").alias("__file"))
        write_bronze(dedupe_keep(full, keys, ["__landed", "__file"], "last").drop("__landed", "__file"), bronze_root)

    return (stream.writeStream.foreachBatch(upsert)
                  .option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())
