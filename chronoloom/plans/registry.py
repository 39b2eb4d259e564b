"""All queries of the library and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


#: Added before rounding where values are exact fractions: a half then goes up whatever the order of sums.
OFF_TIES = 1.37e-8


def query(sql: str | None = None) -> Callable:
    """Register a function under its name, with the SQL that must give the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded, as both engines add in their own order."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


from chronoloom.plans import assembly, astrometry, catalogue, curves, groups, models, more, points, regions, series, tracks, values  # noqa: E402, F401
