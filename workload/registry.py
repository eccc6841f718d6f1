"""Where queries and their SQL are registered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.session import tune
from workload.views import with_views

QUERIES: dict = {}
CHECKS: dict = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a key, with the SQL that must give the same rows."""

    def keep(fn):
        if key in QUERIES:
            raise ValueError(f"{key} registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            CHECKS[key] = with_views(sql)
        return fn

    return keep


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating results, as sums differ in the last bits between engines."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
