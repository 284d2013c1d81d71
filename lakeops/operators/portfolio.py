"""Errors, weights, risk and allocation: one row per symbol, or a few per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.cases import clamp, lookup
from lakeops.operators.ordered import names, with_previous
from lakeops.session import materialise


def rmse(df: DataFrame, by: str | Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Root mean square error over the rows where both values exist; null without any."""
    both = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    error = F.when(both, F.pow(F.col(actual) - F.col(predicted), 2))
    return df.groupBy(*names(by)).agg(F.sqrt(F.avg(error)).alias("rmse"))


def directional_accuracy(
    df: DataFrame, by: str, order: str, actual: str, predicted: str, chunk=None
) -> DataFrame:
    """Share of steps in which actual and predicted move the same way."""
    prev = with_previous(df, by, [order], [actual, predicted], chunk)
    move = (F.col(actual) - F.col(f"prev_{actual}")) * (F.col(predicted) - F.col(f"prev_{predicted}"))
    hit = F.when(move.isNotNull(), F.when(move > 0, 1.0).otherwise(0.0))
    return prev.groupBy(by).agg(F.avg(hit).alias("directional_accuracy"))


def pick_best_model(errors: DataFrame, by: str = "symbol", model: str = "model", error: str = "rmse") -> DataFrame:
    """Model with the smallest error per symbol; the name decides ties."""
    order = F.when(F.col(error).isNotNull(), F.struct(error, model))
    return errors.groupBy(by).agg(F.min_by(model, order).alias("best_model"), F.min(error).alias("best_rmse"))


def weighted_forecast(
    forecasts: DataFrame, by: str = "symbol", error: str = "rmse", value: str = "forecast"
) -> DataFrame:
    """Forecast weighted by 1/error; equal weights when no error is usable."""
    inverse = F.when(F.col(error) > 0, 1.0 / F.col(error)).otherwise(F.lit(0.0))
    w = forecasts.withColumn("_w", inverse)
    total = F.sum("_w")
    return w.groupBy(by).agg(
        F.when(total > 0, F.sum(F.col("_w") * F.col(value)) / F.nullif(total, F.lit(0.0)))
        .otherwise(F.avg(value))
        .alias("weighted_forecast")
    )


def expected_return(forecast: Column, price: Column) -> Column:
    return F.when(price > 0, (forecast - price) / F.nullif(price, F.lit(0.0))).otherwise(F.lit(0.0))


def confidence(ret: Column, strength: Column) -> Column:
    """Strong when the pattern agrees with the sign of the return, else half the return."""
    push = F.lit(0.5) + F.lit(0.5) * F.least(F.lit(1.0), F.abs(ret * 5))
    return F.when((ret > 0) & (strength > 0), push).when((ret < 0) & (strength < 0), -push).otherwise(ret * 0.5)


def risk_category(volatility: Column, range_share: Column) -> Column:
    score = F.coalesce(volatility, F.lit(0.0)) + F.coalesce(range_share, F.lit(0.0))
    return F.when(score < 0.2, "Low").when(score < 0.5, "Medium").otherwise("High")


def decision_text(ret: Column, conf: Column, risk: Column, pattern: Column) -> Column:
    action = F.when(ret > 0, "Potential Buy").when(ret < 0, "Potential Sell").otherwise("Hold")
    share = F.round(F.abs(conf) * 100, 1).cast("string")
    return F.concat_ws(
        " | ",
        action,
        F.concat(F.lit("Confidence: "), share, F.lit("%")),
        F.concat(F.lit("Risk: "), risk),
        F.concat(F.lit("Pattern: "), pattern),
    )


def kelly_fraction(ret: Column, variance: Column) -> Column:
    return F.when(variance <= 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), ret / F.nullif(variance, F.lit(0.0)))
    )


# Weight of each risk category; unknown categories count as medium.
RISK_UNIT = {"Low": 1.0, "Medium": 0.6, "High": 0.3}


def raw_allocation(ret: Column, vol: Column, conf: Column, strength: Column, risk: Column) -> Column:
    """Positive return scaled down by volatility, confidence, pattern and risk; 0 to 100."""
    zero = F.lit(0.0)
    # The scale 100, the damping 10, the halves, and the pattern range -2 to 2.
    gain = F.lit(100.0) * F.greatest(F.coalesce(ret, zero), zero)
    calm = F.lit(1.0) / (F.lit(1.0) + 10.0 * F.greatest(F.coalesce(vol, zero), zero))
    sure = 0.5 + 0.5 * (clamp(F.coalesce(conf, zero), -1.0, 1.0) + 1.0) / 2.0
    shape = 0.5 + 0.5 * clamp((F.coalesce(strength, zero) + 2.0) / 4.0, 0.0, 1.0)
    return clamp(gain * calm * sure * shape * lookup(risk, RISK_UNIT, 0.6), 0.0, 100.0)


def normalise_with_floor(
    df: DataFrame,
    raw: str = "raw_allocation",
    out: str = "allocation_pct",
    floor: float = 3.0,
    by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Shares of 100 with a minimum each; equal shares when nothing has weight.

    The floor falls to 100/n when n floors would exceed 100.  What the floor adds
    is taken from the shares above it in proportion.  Totals are two grouped
    aggregates (per ``by``, or over the table as scalar subqueries).
    """
    by = names(by)
    df = materialise(df, "holdings")  # one row per holding, read by two levels of totals
    first = {"_total": F.sum(F.coalesce(F.col(raw), F.lit(0.0))), "_n": F.count(F.lit(1))}
    base = _with_totals(df, by, first)
    n = F.col("_n").cast("double")
    share = F.when(
        F.col("_total") > 0, F.coalesce(F.col(raw), F.lit(0.0)) / F.nullif(F.col("_total"), F.lit(0.0)) * 100.0
    ).otherwise(100.0 / n)
    low = F.least(F.lit(float(floor)), 100.0 / n)
    base = base.withColumn("_floor", low).withColumn("_a", F.greatest(share, F.col("_floor")))
    second = {"_sum": F.sum("_a"), "_above": F.sum(F.col("_a") - F.col("_floor"))}
    both = _with_totals(base, by, second)
    over = F.col("_a") - F.col("_floor")
    cut = F.when(
        F.col("_above") > 1e-9,
        F.greatest(
            F.col("_floor"),
            F.col("_a") - (F.col("_sum") - 100.0) * over / F.nullif(F.col("_above"), F.lit(0.0)),
        ),
    ).otherwise(100.0 / n)
    final = F.when(F.col("_sum") > 100.0, cut).otherwise(F.col("_a") * 100.0 / F.col("_sum"))
    return both.withColumn(out, final).drop("_total", "_n", "_floor", "_a", "_sum", "_above")


def _with_totals(df: DataFrame, by: list[str], totals: dict[str, Column]) -> DataFrame:
    if by:
        sums = df.groupBy(*by).agg(*[t.alias(n) for n, t in totals.items()])
        return df.join(sums, by)
    return df.withColumns({n: df.agg(t.alias(n)).scalar() for n, t in totals.items()})
