"""Aggregations.  All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.cases import indicator
from lakeops.functions.times import text_seconds_between
from lakeops.operators.ordered import names
from lakeops.operators.topk import top_ranked
from lakeops.session import materialise


def dominance(
    df: DataFrame,
    entity: str | Sequence[str],
    points: str,
    min_rows: int,
    years: tuple[int, int] | None = None,
    year: str = "race_year",
) -> DataFrame:
    """Race count, total and average points per entity with at least ``min_rows`` rows."""
    if years:
        df = df.filter(F.col(year).between(*years))
    return (
        df.groupBy(*names(entity))
        .agg(
            F.count(F.lit(1)).alias("total_races"),
            F.sum(points).alias("total_points"),
            F.avg(points).alias("avg_points"),
        )
        .filter(F.col("total_races") >= min_rows)
    )


def standings(df: DataFrame, dims: Sequence[str], points: str, position: str) -> DataFrame:
    """Total points and number of wins (position 1) per group."""
    return df.groupBy(*dims).agg(
        F.sum(points).alias("total_points"), F.count(F.when(F.col(position) == 1, True)).alias("wins")
    )


def category_counters(
    df: DataFrame, keys: str | Sequence[str] | Sequence[Column], col: str, values: dict[str, str]
) -> DataFrame:
    """One counter column per category value: ``{value: output name}``."""
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return df.groupBy(*keys).agg(
        *[F.sum(indicator(F.col(col) == v)).alias(name) for v, name in values.items()]
    )


def top_entity_series(
    df: DataFrame, entity: str, year: str, points: str, n: int, min_rows: int = 1
) -> DataFrame:
    """Yearly totals of the n entities with the best average points."""
    # one pass over the input: sums per (year, entity) hold everything the ranking needs
    sums = df.groupBy(year, entity).agg(
        F.count(F.lit(1)).alias("total_races"),
        F.count(points).alias("_n"),
        F.sum(points).alias("total_points"),
    )
    sums = materialise(sums, "series")
    total = F.sum("total_points") / F.sum("_n")
    ranked = sums.groupBy(entity).agg(F.sum("total_races").alias("rows"), total.alias("avg_points"))
    best = top_ranked(ranked.filter(F.col("rows") >= min_rows), ["-avg_points"], n).select(entity)
    kept = sums.join(best, entity, "left_semi")
    return kept.withColumn("avg_points", F.col("total_points") / F.col("_n")).drop("_n")


def distinct_dim(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*cols).distinct()


def with_keys_of(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is among the values of ``keys``; the key list stays in the cluster."""
    return df.join(keys.select(col).distinct(), col, "left_semi")


def avg_between(df: DataFrame, col: str, date: str, lo, hi) -> DataFrame:
    return df.filter(F.col(date).between(F.lit(lo), F.lit(hi))).agg(F.avg(col).alias(f"avg_{col}"))


def trip_summary(
    df: DataFrame,
    keys: Sequence[str] = ("trip_id", "vehicle_id", "driver_id"),
    ts: str = "event_time",
    delta: str = "delta_m",
    speed: str = "speed_kmph",
) -> DataFrame:
    """First and last time as text, duration, count, distance and speeds per trip."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    start, end = F.min(ts), F.max(ts)
    return df.groupBy(*keys).agg(
        F.date_format(start, fmt).alias("trip_start"),
        F.date_format(end, fmt).alias("trip_end"),
        text_seconds_between(start, end, fmt).alias("trip_duration_sec"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum(delta).alias("distance_m"),
        (F.sum(delta) / 1000.0).alias("distance_km"),
        F.avg(speed).alias("avg_speed"),
        F.min(speed).alias("min_speed"),
        F.max(speed).alias("max_speed"),
    )


def rollup_time(
    df: DataFrame, ts: str, unit: str, dims: Sequence[str], measures: dict[str, Column], out: str = "bucket"
) -> DataFrame:
    """Aggregates per time bucket (minute, hour, day …) and dimensions."""
    return df.groupBy(F.date_trunc(unit, F.col(ts)).alias(out), *dims).agg(
        *[m.alias(name) for name, m in measures.items()]
    )


def filtered_group(df: DataFrame, cond: Column, dims: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    return df.filter(cond).groupBy(*dims).agg(*[m.alias(name) for name, m in measures.items()])


def _as_number(c: Column, kind: T.DataType) -> Column:
    """The numbers in a column of any type; what is no number is null."""
    if isinstance(kind, T.NumericType):
        return c
    if isinstance(kind, T.StringType):
        return c.try_cast("double")
    return c.cast("double") if isinstance(kind, T.BooleanType) else F.lit(None).cast("double")


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row per column of any type: count, nulls, the mean, sample deviation, minimum and maximum
    of its numbers, and its least and greatest value as text (null for types without an order).

    Texts that read as numbers count as such; an empty table has null statistics.
    """
    stats = []
    for name in cols:
        c, kind = F.col(f"`{name}`"), df.schema[name].dataType
        number = _as_number(c, kind)
        ordered = F.lit(None).cast("string") if isinstance(kind, (T.MapType, T.VariantType)) else c
        stats.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count(F.when(c.isNull(), True)).alias("null_count"),
                F.avg(number).cast("double").alias("mean"),
                F.stddev_samp(number).alias("stddev"),
                F.min(number).cast("double").alias("min"),
                F.max(number).cast("double").alias("max"),
                F.min(ordered).cast("string").alias("least"),
                F.max(ordered).cast("string").alias("greatest"),
            )
        )
    one = df.agg(F.array(*stats).alias("_s"))
    return one.select(F.explode("_s").alias("_s")).select("_s.*")


def keyed_totals(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Plain group-by."""
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
