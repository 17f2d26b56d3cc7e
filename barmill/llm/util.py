"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python task turns into objects at a time, and bytes, but for one row that is larger.
SLICE, SLICE_BYTES = 256, 4 << 20

#: Rows of an Arrow batch between Spark and a Python task, where the session leaves Spark's default: whole texts are large.
BATCH, BATCH_KEY, BATCH_DEFAULT = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, else one inside the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends there, and lost executors lose nothing."""
    path = f"{scratch(df.sparkSession).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: Column) -> Column:
    """Text with null as the empty text."""
    return F.coalesce(text, F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            if part.nbytes <= size:
                yield part
                continue
            at, n = 0, 1
            while at < part.num_rows:
                while at + n < part.num_rows and part.slice(at, n + 1).nbytes <= size:
                    n += 1
                yield part.slice(at, n)
                at, n = at + n, 1


def findable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver found it."""
    env = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, env.get("PYTHONPATH"))))


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow for functions of this package."""
    findable(df.sparkSession)
    if df.sparkSession.conf.get(BATCH_KEY) == BATCH_DEFAULT:
        df.sparkSession.conf.set(BATCH_KEY, str(BATCH))
    return df.mapInArrow(run, schema)
