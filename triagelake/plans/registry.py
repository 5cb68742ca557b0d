"""Registration of the query catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def presentable(df: DataFrame) -> DataFrame:
    """Zoned times as plain UTC times and arrays as comma lists, the forms the SQL side gives."""
    columns = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, ",")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same result."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return presentable(build(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
