"""Forecasts per symbol.

The fits are least squares through their normal equations: Spark sums the
products of the features per symbol (map-side combined, any history length),
and only one small row per symbol reaches numpy for the solve.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import pi

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.times import next_days
from lakeops.operators.ordered import HALO, block_window, join_null_safe, row_numbers, split_blocks
from lakeops.operators.series import DATE, SYMBOL, indicators
from lakeops.operators.windows import _chunk, bfill
from lakeops.session import materialise

MIN_ROWS, MIN_ROWS_FOREST = 10, 20


def _products(features: Sequence[str], target: str) -> list[Column]:
    """Sums of the upper triangle of X'X, row by row, then X'y."""
    k = len(features)
    xx = [F.sum(F.col(features[i]) * F.col(features[j])) for i in range(k) for j in range(i, k)]
    xy = [F.sum(F.col(f) * F.col(target)) for f in features]
    return [F.array(*xx).alias("xx"), F.array(*xy).alias("xy")]


def solve(xx: Sequence[float], xy: Sequence[float]) -> np.ndarray:
    """Coefficients from the packed normal equations (least-norm when singular)."""
    k = len(xy)
    full = np.zeros((k, k))
    full[np.triu_indices(k)] = xx
    full = full + np.triu(full, 1).T
    return np.linalg.lstsq(full, np.asarray(xy, dtype=float), rcond=None)[0]


def _usable(xx, xy) -> bool:
    return xx is not None and xy is not None and all(v is not None for v in (*xx, *xy))


def _future(df: DataFrame, horizon: int) -> DataFrame:
    """Explode per-symbol value arrays onto the next calendar days."""
    pairs = F.arrays_zip(next_days(F.to_date("last_date"), horizon).alias("date"), F.col("_f").alias("forecast"))
    return df.select(SYMBOL, F.posexplode(pairs).alias("_i", "_p")).select(
        SYMBOL, (F.col("_i") + 1).alias("step"), F.col("_p.date").alias("date"), F.col("_p.forecast").alias("forecast")
    )


def _solve_rows(df: DataFrame, predict, horizon: int) -> DataFrame:
    """Apply ``predict(row, horizon)`` to one row per symbol."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [predict(row, horizon) for row in pdf.itertuples(index=False)]
            yield pd.DataFrame({SYMBOL: pdf[SYMBOL], "last_date": pdf["last_date"], "_f": out})

    kind = df.schema["last_date"].dataType.simpleString()
    return df.mapInPandas(run, f"{SYMBOL} string, last_date {kind}, _f array<double>")


def ar_products(df: DataFrame, p: int = 5, symbol=SYMBOL, date=DATE, chunk=None, size=100_000) -> DataFrame:
    """Per symbol: row count, last bars and product sums of the differenced series on its p lags."""
    cut = _chunk(df, date, chunk)
    b = split_blocks(df.select(F.col(symbol).alias(SYMBOL), F.col(date).alias(DATE), "close"), SYMBOL, [DATE],
                     p + 1, size, cut)
    w = block_window(SYMBOL)
    b = b.withColumn("_d", F.col("close") - F.lag("close").over(w))
    b = b.withColumns({f"_l{i}": F.lag("_d", i).over(w) for i in range(1, p + 1)}).filter(~F.col(HALO))
    lags = [f"_l{i}" for i in range(1, p + 1)]
    complete = F.col(lags[-1]).isNotNull()
    b = b.withColumns({c: F.when(complete, F.col(c)) for c in lags})
    recent = F.struct("close", F.array("_d", *lags[:-1]).alias("steps"))
    return b.groupBy(SYMBOL).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(DATE).alias("last_date"),
        F.max_by(recent, F.col(DATE)).alias("_last"),
        *_products(lags, "_d"),
    ).select(SYMBOL, "n", "last_date", "_last.close", "_last.steps", "xx", "xy")


def _predict_ar(row, horizon: int) -> list[float]:
    if row.n < MIN_ROWS or not _usable(row.xx, row.xy):
        return [float(row.close)] * horizon
    coef = solve(row.xx, row.xy)
    steps = [0.0 if s is None else float(s) for s in row.steps]
    level, out = float(row.close), []
    for _ in range(horizon):
        step = float(np.dot(coef, steps))
        level += step
        out.append(level)
        steps = [step, *steps[:-1]]
    return out


def forecast_ar(df: DataFrame, p: int = 5, horizon: int = 30, symbol=SYMBOL, date=DATE, chunk=None) -> DataFrame:
    """Autoregression of order p on first differences; under 10 rows the last price is held."""
    return _future(_solve_rows(ar_products(df, p, symbol, date, chunk), _predict_ar, horizon), horizon)


def _seasonal(t: Column, periods: Sequence[float]) -> list[Column]:
    waves = [f(t * (2 * pi / p)) for p in periods for f in (F.sin, F.cos)]
    return [F.lit(1.0), t, *waves]


def trend_products(
    df: DataFrame, periods: Sequence[float] = (7.0, 30.0), symbol=SYMBOL, date=DATE
) -> DataFrame:
    """Per symbol: product sums of close on a linear trend and Fourier terms.

    Time is days since the symbol's first bar over its whole span, so the
    features stay of order one.
    """
    src = df.select(F.col(symbol).alias(SYMBOL), F.col(date).alias(DATE), F.col("close").alias("close"))
    days = F.unix_micros(F.col(DATE).cast("timestamp")) / F.lit(86_400e6)
    ends = src.groupBy(SYMBOL).agg(F.min(days).alias("_t0"), F.max(days).alias("_t1"))
    timed = join_null_safe(src, ends, [SYMBOL]).withColumn("_t", days - F.col("_t0"))
    span = F.greatest(F.col("_t1") - F.col("_t0"), F.lit(1.0))
    cols = _seasonal(F.col("_t"), periods)
    cols[1] = F.col("_t") / span
    feats = {f"_x{i}": c for i, c in enumerate(cols)}
    return timed.withColumns(feats).groupBy(SYMBOL).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(DATE).alias("last_date"),
        F.max_by("close", DATE).alias("close"),
        F.max(span).alias("span"),
        F.max("_t").alias("t_last"),
        *_products(list(feats), "close"),
    )


def forecast_trend_seasonal(
    df: DataFrame, horizon: int = 30, periods: Sequence[float] = (7.0, 30.0), symbol=SYMBOL, date=DATE
) -> DataFrame:
    """Linear trend plus Fourier seasonality; under 10 rows the last price is held."""
    waves = list(periods)

    def predict(row, n: int) -> list[float]:
        if row.n < MIN_ROWS or not _usable(row.xx, row.xy):
            return [float(row.close)] * n
        coef = solve(row.xx, row.xy)
        t = row.t_last + np.arange(1, n + 1)
        parts = [np.ones(n), t / row.span]
        for p in waves:
            parts += [np.sin(2 * np.pi * t / p), np.cos(2 * np.pi * t / p)]
        return [float(v) for v in np.column_stack(parts) @ coef]

    return _future(_solve_rows(trend_products(df, periods, symbol, date), predict, horizon), horizon)


def trend_line(df: DataFrame, symbol=SYMBOL, date=DATE) -> DataFrame:
    """Slope per day and intercept of close, by built-in regression aggregates."""
    days = F.unix_micros(F.col(date).cast("timestamp")) / F.lit(86_400e6)
    first = df.agg(F.min(days)).scalar()
    timed = df.withColumn("_t", days - first)
    return timed.groupBy(symbol).agg(
        F.regr_slope("close", "_t").alias("slope"), F.regr_intercept("close", "_t").alias("intercept")
    )


FEATURES = ["ma50", "ma200", "rsi", "macd", "macd_signal"]


def forecast_forest(
    df: DataFrame,
    horizon: int = 30,
    trees: int = 200,
    seed: int = 42,
    hold_out: int = 30,
    symbol=SYMBOL,
    date=DATE,
    chunk=None,
) -> DataFrame:
    """One random forest over all symbols, on five indicators relative to the symbol's own level.

    Prices and price-like indicators are divided by the symbol's last training close, so that
    symbols of any level share one model whose width does not grow with their number.  The last
    ``hold_out`` bars of each symbol (keeping at least five) are left out of the training set.  The
    future holds the last known features, so each symbol gets one predicted level; under 20 rows
    the last price is held.
    """
    src = df.withColumnsRenamed({symbol: SYMBOL, date: DATE}).filter("close is not null")
    cut = _chunk(src, DATE, chunk)
    feats = bfill(indicators(src, chunk=cut), SYMBOL, DATE, FEATURES, cut)
    sizes = src.groupBy(SYMBOL).agg(F.count(F.lit(1)).alias("n"))
    placed = join_null_safe(row_numbers(feats, SYMBOL, [DATE], "_at", cut), sizes, [SYMBOL])
    # the fit reads the features many times: write them once instead of redoing the windows
    placed = materialise(placed, "forest")
    in_train = F.col("_at") <= F.greatest(F.lit(5), F.col("n") - hold_out)
    bases = placed.filter(in_train).groupBy(SYMBOL).agg(F.max_by("close", "_at").alias("_base"))
    scaled = join_null_safe(placed, bases, [SYMBOL])
    relative = {c: F.try_divide(F.col(c), F.col("_base")) for c in FEATURES if c != "rsi"}
    scaled = scaled.withColumns({**relative, "_label": F.try_divide(F.col("close"), F.col("_base"))})
    train = scaled.filter(in_train & F.col("_label").isNotNull())
    last = scaled.filter(F.col("_at") == F.col("n"))
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="_feats", handleInvalid="skip"),
        RandomForestRegressor(featuresCol="_feats", labelCol="_label", numTrees=trees, seed=seed),
    ]
    fitted = Pipeline(stages=stages).fit(train)
    told = fitted.transform(last).select(SYMBOL, (F.col("prediction") * F.col("_base")).alias("_told"))
    level = F.when(F.col("n") < MIN_ROWS_FOREST, F.col("close")).otherwise(F.coalesce("_told", "close"))
    one = join_null_safe(last, told, [SYMBOL]).select(
        SYMBOL, F.col(DATE).alias("last_date"), F.array_repeat(level, horizon).alias("_f")
    )
    return _future(one, horizon)
