"""Registered queries and the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from logloom.session import ship_package, use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = ship_package(use_utc(spark)), folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        # times without a zone are UTC
        naive = [f.name for f in table.schema if isinstance(f.dataType, TimestampNTZType)]
        return table.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else table

    def wide(self, name: str) -> DataFrame:
        """A table whose rows cost much work each, spread over all cores.

        Only a scan with fewer partitions than cores (one small file) is shuffled;
        a table of many files is already spread and stays as it is.
        """
        table, cores = getattr(self, name), self.spark.sparkContext.defaultParallelism
        return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLE[name] = sql
        return fn

    return register
