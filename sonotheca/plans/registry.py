"""The registered queries: each operator over the given tables, with its SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given tables as attributes, for example ``Tables(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable:
    """Register a function of ``Tables`` under its own name, with the equivalent SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(Tables(spark, folder))

        QUERIES[build.__name__] = run
        if sql:
            ORACLE[build.__name__] = sql
        return build

    return register
