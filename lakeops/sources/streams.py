"""Streaming sources; incremental file ingest is in :mod:`lakeops.sources.ingest`."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.sources.ingest import ingest_available, tracked_schema  # noqa: F401
from lakeops.sources.messages import parse_json_tolerant


def stream_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Each record of a folder of text files as one string column ``value``."""
    return spark.readStream.options(**options).text(path)


def stream_messages(spark: SparkSession, options: dict[str, str], starting: str = "earliest") -> DataFrame:
    """Messages of a broker topic as text (needs the Kafka connector on the class path)."""
    source = spark.readStream.format("kafka").options(**options).option("startingOffsets", starting)
    return source.load().select(F.col("value").cast("string").alias("value"))


def files_there(spark: SparkSession, source: str, place: str) -> DataFrame:
    """The files of a folder at the first call, kept under ``place`` and read from there afterwards."""
    kind = "file STRING"
    try:
        return spark.read.schema(kind).parquet(place)
    except AnalysisException:
        listing = spark.read.format("binaryFile").load(source).select(F.col("_metadata.file_path").alias("file"))
        listing.write.mode("errorifexists").parquet(place)
    return spark.read.schema(kind).parquet(place)


def stream_json(
    spark: SparkSession,
    source: str | dict[str, str],
    schema: StructType | str,
    starting: str = "earliest",
    start_kept_at: str | None = None,
    **options,
) -> DataFrame:
    """Typed columns from a stream of JSON messages; unparsable messages are left out.

    ``source`` is a folder of JSON-line files, or the options of a broker topic.
    ``starting='latest'`` passes over what is there at the first start.  A broker keeps that
    position in the checkpoint; for a folder the files there are listed once under
    ``start_kept_at``, a place beside the checkpoint, so that a restart of the same stream
    reads what arrived while it was down.  Any other ``starting`` (``yyyy-MM-dd HH:mm:ss``,
    session time zone) leaves out files changed up to that moment.
    """
    if isinstance(source, dict):
        lines = stream_messages(spark, {**source, **options}, starting)
    elif starting == "earliest":
        lines = stream_lines(spark, source, **options)
    else:
        read = spark.readStream.options(**options).format("text").load(source)
        if starting == "latest":
            if start_kept_at is None:
                raise ValueError("starting='latest' on a folder needs start_kept_at, or a restart would lose what arrived before it")
            before = files_there(spark, source, start_kept_at)
            placed = read.select("value", F.col("_metadata.file_path").alias("file"))
            lines = placed.join(before, "file", "left_anti").select("value")
        else:
            since = F.lit(starting).cast("timestamp")
            lines = read.filter(F.col("_metadata.file_modification_time") > since).select("value")
    good, _ = parse_json_tolerant(lines, "value", schema)
    return good


def consume_at_most(df: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    """The first ``n`` records by a total order: the bounded read of a topic's backlog."""
    from lakeops.operators.topk import top_n

    return top_n(df, order, n)
