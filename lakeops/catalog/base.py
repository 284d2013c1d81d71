"""Registry of the runnable queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import new_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_TIME = "'%Y-%m-%d %H:%M:%S.%f'"


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types that every client compares alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TIME_TEXT)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, *covers: str, sql: str | None = None):
    """Register a query under ``name`` with the inventory ids it covers."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        COVERS[name] = covers
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rnd(col: Column | str, digits: int = 6) -> Column:
    return F.round(col, digits)


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column."""
    return df.withColumns(
        {
            f.name: F.round(f"`{f.name}`", special.get(f.name, digits))
            for f in df.schema.fields
            if isinstance(f.dataType, T.DoubleType)
        }
    )


def scratch_db(spark: SparkSession) -> str:
    """A fresh database in the shared folder."""
    path = new_dir(spark, "db")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name
