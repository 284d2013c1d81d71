"""Batch scans and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True, **options
) -> DataFrame:
    """CSV file or folder.  Without a schema the types are inferred by a second pass."""
    reader = spark.read.option("header", header).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = False, **options
) -> DataFrame:
    """JSON lines, or whole-file JSON (array or pretty-printed object) with ``multiline``."""
    reader = spark.read.option("multiLine", multiline).options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name_or_sql: str) -> DataFrame:
    """A catalog table by name, or the result of a statement."""
    words = name_or_sql.split(None, 1)
    if len(words) > 1 and words[0].lower() in ("select", "with", "from"):
        return spark.sql(name_or_sql)
    return spark.table(name_or_sql)


def create_external_table(
    spark: SparkSession, name: str, ddl: str, fmt: str, path: str, **options: str
) -> DataFrame:
    """(Re)create a SQL table that reads the raw files in place."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    pairs = {"path": path, **options}
    listed = ", ".join(f"{k} '{v}'" for k, v in pairs.items())
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING {fmt} OPTIONS ({listed})")
    return spark.table(name)


def ensure_layers(spark: SparkSession, layers: Sequence[str], root: str | None = None) -> None:
    """Create one database per layer, under ``root`` when given."""
    for layer in layers:
        place = f" LOCATION '{root.rstrip('/')}/{layer}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{place}")


def latest_file_per_key(
    spark: SparkSession,
    path: str,
    key: str,
    schema: StructType | str,
    fmt: str = "json",
    dated_by: str | None = None,
    **options,
) -> DataFrame:
    """Rows of the newest file of each key.

    ``dated_by`` names the date column of a ``key=/date=`` layout; without it
    dated file paths sort by their date.  The newest date per key is found from
    the key and the date alone, then the rows are kept by an equi join.
    """
    rows = spark.read.schema(schema).options(**options).format(fmt).load(path)
    dated = rows.withColumn("_at", F.col(dated_by) if dated_by else F.col("_metadata.file_path"))
    newest = dated.groupBy(key).agg(F.max("_at").alias("_at"))
    return dated.join(newest, [key, "_at"], "left_semi").drop("_at")


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every nested struct field becomes a top-level column named ``a.b``."""

    def leaves(kind: StructType, path: tuple[str, ...]):
        for f in kind.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    return df.select(
        *[
            F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))
            for path in leaves(df.schema, ())
        ]
    )
