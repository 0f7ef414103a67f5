"""Where queries are registered, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smoothway.plans.adapters import spark_view

Read = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of (read) -> DataFrame, where read gives a view by name."""

    def add(f: Callable[[Read], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda view: spark_view(spark, sf_dir, view))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """All fractions to some places, as sums over partitions have no fixed order."""
    return df.select(*[F.round(c, places).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])
