"""The list of runnable queries: a Spark function each, and the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.session import SETTINGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Data:
    """The tables of one data folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        schema = getattr(self, name).schema
        return (
            self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .parquet(self.path)
        )


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison only; the library keeps them exact."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def query(sql: str | None = None):
    def register(fn: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, path: str) -> DataFrame:
            for key in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
                spark.conf.set(key, SETTINGS[key])
            return plain(fn(Data(spark, path)))

        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql.strip()
        return fn

    return register
