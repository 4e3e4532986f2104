"""Registry of checked queries: a Spark callable and, where SQL can say the same, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obolus.catalog.oracle import with_tables
from obolus.plans.bindings import Bound

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def edge(df: DataFrame) -> DataFrame:
    """Types two engines print alike: money as double, dates as ISO text, arrays joined."""
    out = []
    for f in df.schema.fields:
        col, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DecimalType):
            col = col.cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(t, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.ArrayType):
            col = F.array_join(F.transform(col, lambda x: x.cast("string")), "|")
        out.append(col.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register ``fn(bound) -> DataFrame`` under ``name``."""
    def add(fn: Callable[[Bound], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: edge(fn(Bound(spark, folder)))
        if sql is not None:
            ORACLES[name] = with_tables(sql, extra)
        return fn
    return add
