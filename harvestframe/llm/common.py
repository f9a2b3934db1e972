"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Only a local session without the setting gets a folder of its own; on a cluster a missing
    setting is an error, since a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="harvestframe-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: later jobs, and tasks rerun after an executor is lost, start from the files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that a run of very long texts stays small in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def utf8(texts: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow string array, nulls kept."""
    return texts.cast(pa.large_binary()).to_pylist()


def n_words(text):
    """The number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the like that is no column of ``df`` in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(df: DataFrame) -> Column:
    """SHA-256 (32 bytes) of all columns of a row, nulls and their places included: equal for equal rows alone."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]),
                                    {"ignoreNullFields": "false"}), 256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_worker(key: str, build):
    """What ``build()`` returns, made once in each Python worker process and kept over its tasks."""
    store = sys.modules.setdefault("_harvestframe_worker", types.ModuleType("_harvestframe_worker")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]
