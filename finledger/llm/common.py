"""Shared helpers of the training-data operators: tables, the shared folder, numpy pieces."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from finledger.session import in_one_process

# The words of the contracts are runs of anything but these six bytes. ``bytes.split()``
# without an argument splits at exactly these, so words are cut on UTF-8 bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset and everything runs in one
    process, as in tests, a folder is made and set for the rest of the session; on a cluster that is
    an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not in_one_process(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="finledger-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in the shared folder: the lineage ends here, so a lost
    executor costs a read instead of a recomputation, and nothing is computed twice."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, null as empty."""
    values = batch.column(column).cast(pa.large_binary())
    return [v or b"" for v in values.to_pylist()]


def strings_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch as strings, null as empty."""
    return [v or "" for v in batch.column(column).to_pylist()]


def batches(arrays: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for columns in arrays:
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
        )


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambler of unsigned 64-bit numbers (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(31))
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))
