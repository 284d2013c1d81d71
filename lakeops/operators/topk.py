"""Orders, limits, top-k, latest rows and tagged unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.ordered import bare, names, sort_columns


def top_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First n rows of a total order (each task keeps its own n, then they meet)."""
    return df.orderBy(*sort_columns(order)).limit(n)


def top_n_per_group(
    df: DataFrame, group: str | Sequence[str], order: Sequence[str], n: int, out: str | None = None
) -> DataFrame:
    """First n rows per group.

    The ``row_number <= n`` filter lets the optimizer cut every map task's rows
    to n per group before the shuffle, so a hot group costs n rows per task.  It does
    so up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 unless raised;
    ``build_session`` raises it.
    """
    name = out or "_rn"
    w = Window.partitionBy(*names(group)).orderBy(*sort_columns(order))
    kept = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return kept if out else kept.drop(name)


def top_ranked_per_group(
    df: DataFrame, group: str | Sequence[str], order: Sequence[str], n: int, out: str = "rank"
) -> DataFrame:
    """Rows with ``rank() <= n`` per group (ties included), cut before the shuffle."""
    w = Window.partitionBy(*names(group)).orderBy(*sort_columns(order))
    return df.withColumn(out, F.rank().over(w)).filter(F.col(out) <= n)


def top_ranked(df: DataFrame, order: Sequence[str], n: int, out: str = "rank") -> DataFrame:
    """Rows whose overall rank is at most n, ties included.

    The first n order keys come from bounded lists that tasks keep and merge; they are
    ranked among themselves, and the rows with one of those keys are the result, so
    nothing is ranked that does not stay.
    """
    keys = bare(order)
    first = df.select(*keys).orderBy(*sort_columns(order)).limit(n)
    ranked = first.withColumn(out, F.rank().over(Window.orderBy(*sort_columns(order)))).distinct()
    places = F.broadcast(ranked.select(F.struct(*keys).alias("_key"), out))  # at most n rows
    rows = df.withColumn("_key", F.struct(*keys))
    return rows.join(places, "_key").drop("_key")


def dedup_keep_first(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[str], drop_null: bool = False
) -> DataFrame:
    """First row per key along ``order``; map tasks already keep one row per key.

    A hash of the key leads the grouping, so that sorting compares long texts
    only when their hashes agree.
    """
    keys = names(keys)
    if drop_null:
        df = df.dropna(subset=keys)
    return top_n_per_group(df.withColumn("_h", F.xxhash64(*keys)), ["_h", *keys], order, 1).drop("_h")


def latest_by_key(df: DataFrame, keys: str | Sequence[str], ts: str) -> DataFrame:
    """Row with the highest ``ts`` per key; ties fall to the greatest remaining values."""
    keys = names(keys)
    rest = [c for c in df.columns if c not in (*keys, ts)]
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in rest])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def arg_extreme(df: DataFrame, key: str | Sequence[str], value: str, at: str, kind: str = "max") -> DataFrame:
    """Where the extreme value of each key lies; the earliest position wins ties."""
    keys = names(key)
    if kind == "min":
        pick = F.min_by(F.col(at), F.struct(value, at))
        best = F.min(value)
    else:
        best = F.max(value)
        # greatest value first, then the smallest position
        pick = F.min_by(F.col(at), F.struct(-F.col(value), F.col(at)))
    return df.groupBy(*keys).agg(pick.alias(f"{kind}_at"), best.alias(f"{kind}_value"))


def union_tagged(frames: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """UNION ALL of frames with a constant column that names the origin."""
    out = None
    for name, frame in frames.items():
        tagged = frame.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def ordered_by(df: DataFrame, order: Sequence[str], cols: Sequence[str | Column] | None = None) -> DataFrame:
    """Total sort, then a projection."""
    out = df.orderBy(*sort_columns(order))
    return out.select(*cols) if cols else out
