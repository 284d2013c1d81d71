"""Window operators, written over :mod:`lakeops.operators.ordered`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.geo import haversine_m
from lakeops.operators.ordered import (
    BLOCK,
    ROW,
    block_window,
    drop_halo,
    fill_backward,
    fill_forward,
    names,
    ranks,
    row_numbers,
    split_blocks,
    time_chunk,
    with_previous,
)
from lakeops.operators.topk import top_n_per_group


def rank_within(
    df: DataFrame, by: str | Sequence[str], order: Sequence[str], out: str = "rank", chunk=None, stage: bool = False
) -> DataFrame:
    """Rank with gaps inside each group, e.g. standings per year by points and wins.

    ``stage`` is for inputs that are small but dear to compute, such as aggregates.
    """
    return ranks(df, by, order, out, chunk, stage)


def rank_overall(df: DataFrame, order: Sequence[str], out: str = "rank", chunk=None, stage: bool = False) -> DataFrame:
    """Rank with gaps over the whole table without a single-task window; ``stage`` as in :func:`rank_within`."""
    return ranks(df, None, order, out, chunk, stage)


def batch_ids(df: DataFrame, order: Sequence[str], size: int = 20, out: str = "batch_id", chunk=None) -> DataFrame:
    """Number rows along a total order and cut them into batches of ``size``."""
    numbered = row_numbers(df, None, order, "row_num", chunk)
    return numbered.withColumn(out, F.floor((F.col("row_num") - 1) / size).cast("long"))


def with_lags(df: DataFrame, key, ts, cols: Sequence[str], chunk=None, tie: Sequence[str] = ()) -> DataFrame:
    """Previous row's columns per key (``prev_*``)."""
    return with_previous(df, key, [ts, *tie], cols, _chunk(df, ts, chunk))


def with_delta_m(
    df: DataFrame,
    key: str = "vehicle_id",
    ts: str = "event_time",
    trip: str = "trip_id",
    tie: Sequence[str] = (),
    chunk=None,
    out: str = "delta_m",
) -> DataFrame:
    """Distance to the previous point of the key.

    0 for the first point, for a null or blank trip and after a trip change.  A
    null previous trip is not a change: the distance is computed.
    """
    prev = with_lags(df, key, ts, ["lat", "lon", trip], chunk, tie)
    return prev.withColumn(out, delta_expr(trip)).drop("prev_lat", "prev_lon", f"prev_{trip}")


def delta_expr(trip: str = "trip_id") -> Column:
    """The distance rule over ``lat, lon, trip`` and their ``prev_`` twins."""
    t, pt = F.col(trip), F.col(f"prev_{trip}")
    reset = F.col("prev_lat").isNull() | F.col("prev_lon").isNull() | t.isNull() | (t == "") | (t != pt)
    return F.when(reset, F.lit(0.0)).otherwise(
        haversine_m(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon"))
    )


def rolling_mean(
    df: DataFrame, key, ts: str, col: str, n: int, out: str | None = None, chunk=None, size: int = 100_000
) -> DataFrame:
    """Mean of the last n rows, with as many as there are at the start."""
    blocks = split_blocks(df, key, [ts], n - 1, max(size, n), _chunk(df, ts, chunk))
    return drop_halo(blocks.withColumn(out or f"{col}_mean{n}", F.avg(col).over(block_window(key, n))))


def diff(df: DataFrame, key, ts: str, col: str, out: str = "diff", chunk=None) -> DataFrame:
    prev = with_lags(df, key, ts, [col], chunk)
    return prev.withColumn(out, F.col(col) - F.col(f"prev_{col}")).drop(f"prev_{col}")


def pct_change(df: DataFrame, key, ts: str, col: str, out: str = "pct_change", chunk=None) -> DataFrame:
    prev = with_lags(df, key, ts, [col], chunk)
    return prev.withColumn(out, F.try_divide(F.col(col), F.col(f"prev_{col}")) - 1).drop(f"prev_{col}")


def ffill(df: DataFrame, key, ts: str, cols: Sequence[str], default=None, chunk=None) -> DataFrame:
    """Forward fill, then a constant where nothing came before."""
    out = fill_forward(df, key, [ts], cols, _chunk(df, ts, chunk))
    return out if default is None else out.fillna(default, subset=list(cols))


def bfill(df: DataFrame, key, ts: str, cols: Sequence[str], chunk=None) -> DataFrame:
    return fill_backward(df, key, [ts], cols, _chunk(df, ts, chunk))


def ema_halo(span: int) -> int:
    """Rows of warm-up after which older rows weigh less than 1e-17."""
    return 20 * (span + 1)


def ema(
    df: DataFrame, key, ts: str, cols_spans: dict[str, tuple[str, int]], chunk=None, size: int = 100_000
) -> DataFrame:
    """Exponential moving averages ``{out: (column or earlier out, span)}``.

    alpha = 2/(span+1), seeded with the first value.  Each block of a key starts
    ``ema_halo`` rows early, so its own rows agree with the full recursion to
    double precision and blocks run in parallel.
    """
    halo = sum(ema_halo(s) for _, s in cols_spans.values())
    blocks = split_blocks(df, key, [ts], halo, max(size, halo), _chunk(df, ts, chunk))
    return drop_halo(ema_in_blocks(blocks, key, cols_spans))


def ema_in_blocks(blocks: DataFrame, key, outputs: dict[str, tuple[str, int] | tuple[str, str]]) -> DataFrame:
    """Add the averages inside blocks; a pair of names means their difference."""
    schema = T.StructType([*blocks.schema.fields, *[T.StructField(o, T.DoubleType()) for o in outputs]])

    def run(pdf):
        pdf = pdf.sort_values(ROW)
        for out, (source, rule) in outputs.items():
            if isinstance(rule, str):
                pdf[out] = pdf[source] - pdf[rule]
            else:
                pdf[out] = pdf[source].ewm(span=rule, adjust=False).mean()
        return pdf

    return blocks.groupBy(*names(key), BLOCK).applyInPandas(run, schema)


def tail_n(df: DataFrame, key, ts: str, n: int) -> DataFrame:
    """Last n rows per key."""
    return top_n_per_group(df, key, [f"-{ts}"], n)


def max_normalise(df: DataFrame, group: str | Sequence[str], col: str, out: str = "norm_score") -> DataFrame:
    """Value over the group's maximum, which counts as at least 1."""
    best = df.groupBy(*names(group)).agg(F.greatest(F.max(col), F.lit(1.0)).alias("_best"))
    joined = df.join(best, names(group))
    return joined.withColumn(out, F.col(col) / F.col("_best")).drop("_best")


def _chunk(df: DataFrame, ts: str, chunk) -> Column | None:
    if chunk is not None:
        return F.col(chunk) if isinstance(chunk, str) else chunk
    kind = df.schema[ts].dataType
    if isinstance(kind, T.DateType):
        return time_chunk(ts, "month")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return time_chunk(ts, "hour")
    return None
