"""From bars to one decision row per symbol: model errors, weighted forecast, risk, allocation.

``forecast_decisions`` runs on fitted models (autoregression, trend with seasons,
forest), chosen and weighted by their error on held-out bars.  ``signals`` alone runs
on three plain predictors of the next close, so that plan has a SQL twin: the last
close, the mean of 5 and the mean of 20.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators import forecast as FC
from lakeops.operators import portfolio as P
from lakeops.operators import series as S
from lakeops.operators.ordered import join_null_safe, row_numbers, with_previous
from lakeops.operators.topk import union_tagged
from lakeops.operators.windows import _chunk
from lakeops.session import materialise

MODELS = {"last": 1, "mean20": 20, "mean5": 5}


def predictions(bars: DataFrame) -> DataFrame:
    """Long table (symbol, date, model, actual, predicted, next) of one-step predictions."""
    means = S.moving_averages(bars.select("symbol", "date", "close"), list(MODELS.values()))
    cols = [f"ma{n}" for n in MODELS.values()]
    prev = with_previous(means, "symbol", ["date"], cols, _chunk(means, "date", None))
    entries = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"), F.col(f"prev_ma{n}").alias("predicted"), F.col(f"ma{n}").alias("next")
            )
            for m, n in MODELS.items()
        ]
    )
    return prev.select("symbol", "date", F.col("close").alias("actual"), F.explode(entries).alias("_e")).select(
        "symbol", "date", "actual", "_e.*"
    )


def model_errors(bars: DataFrame) -> DataFrame:
    return P.rmse(predictions(bars), ["symbol", "model"], "actual", "predicted")


def weighted(bars: DataFrame) -> DataFrame:
    """Next-bar forecast of each symbol, weighted by 1/RMSE of its models."""
    preds = predictions(bars)
    error = F.when(F.col("predicted").isNotNull(), F.pow(F.col("actual") - F.col("predicted"), 2))
    per_model = preds.groupBy("symbol", "model").agg(
        F.sqrt(F.avg(error)).alias("rmse"), F.max_by("next", "date").alias("forecast")
    )
    return P.weighted_forecast(per_model)


HOLD = 30
LEAST = 5


def fitted_forecasts(bars: DataFrame, horizon: int = 30, trees: int = 200) -> DataFrame:
    """Long table (symbol, model, step, date, forecast) of the three fitted models."""
    fitted = {
        "autoregressive": FC.forecast_ar(bars, 5, horizon),
        "forest": FC.forecast_forest(bars, horizon, trees),
        "trend_seasonal": FC.forecast_trend_seasonal(bars, horizon),
    }
    return union_tagged(fitted, "model").select("symbol", "model", "step", "date", "forecast")


def hold_out_errors(bars: DataFrame, hold: int = HOLD, trees: int = 200) -> DataFrame:
    """RMSE per symbol and model over the last ``hold`` bars, fitted on the bars before them.

    At least ``LEAST`` bars stay for the fit; the i-th step of a forecast meets the i-th bar held out.
    """
    sizes = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"))
    numbered = join_null_safe(row_numbers(bars, "symbol", ["date"], "_at"), sizes, ["symbol"])
    numbered = materialise(numbered.withColumn("_fit", F.greatest(F.lit(LEAST), F.col("_n") - hold)), "hold-out")
    train = numbered.filter("_at <= _fit").select(*bars.columns)
    kept = numbered.filter("_at > _fit").select(
        "symbol", (F.col("_at") - F.col("_fit")).cast("int").alias("step"), F.col("close").alias("actual")
    )
    told = fitted_forecasts(train, hold, trees).withColumn("step", F.col("step").cast("int"))
    return P.rmse(told.join(kept, ["symbol", "step"]), ["symbol", "model"], "actual", "forecast")


def forecast_decisions(bars: DataFrame, horizon: int = 30, hold: int = HOLD, trees: int = 200) -> DataFrame:
    """One row per symbol: best fitted model, dates to buy and sell on its forecast, and the decision.

    The forecast of a model is the mean over the horizon; they are weighted by 1/RMSE on the
    held-out bars.  Without held-out bars the first model by name is taken and weights are equal.
    """
    bars = materialise(bars, "bars")
    ahead = materialise(fitted_forecasts(bars, horizon, trees), "forecasts")
    means = ahead.groupBy("symbol", "model").agg(F.avg("forecast").alias("forecast"))
    per_model = materialise(means.join(hold_out_errors(bars, hold, trees), ["symbol", "model"], "left"), "errors")
    order = F.struct(F.coalesce("rmse", F.lit(float("inf"))).alias("e"), F.col("model"))
    best = per_model.groupBy("symbol").agg(F.min_by("model", order).alias("model"), F.min("rmse").alias("best_rmse"))
    path = ahead.join(best, ["symbol", "model"])
    days = path.groupBy("symbol").agg(
        F.first("model").alias("best_model"), F.first("best_rmse").alias("best_rmse"),
        F.min_by("date", F.struct("forecast", "date")).alias("buy_date"),
        F.min_by("date", F.struct(-F.col("forecast"), F.col("date"))).alias("sell_date"),
    )
    return signals(bars, P.weighted_forecast(per_model)).join(days, "symbol")


def signals(bars: DataFrame, forecasts: DataFrame | None = None) -> DataFrame:
    """Expected return, confidence, risk and decision per symbol.

    ``forecasts`` has ``symbol, weighted_forecast``; by default the plain predictors give it.
    """
    bars = materialise(bars, "bars")  # four branches read them
    forecasts = weighted(bars) if forecasts is None else forecasts
    price = S.atr(bars).groupBy("symbol").agg(
        F.max_by("close", "date").alias("current_price"), F.max_by("atr14", "date").alias("atr14")
    )
    base = (
        price.join(forecasts, "symbol")
        .join(S.annualised_volatility(bars), "symbol")
        .join(S.best_pattern(bars), "symbol", "left")
    )
    strength = F.coalesce("pattern_strength", F.lit(0))
    out = base.withColumns(
        {
            "pattern_strength": strength,
            "expected_return": P.expected_return(F.col("weighted_forecast"), F.col("current_price")),
            "atr_share": F.coalesce(F.try_divide(F.col("atr14"), F.col("current_price")), F.lit(0.0)),
        }
    )
    out = out.withColumns(
        {
            "confidence": P.confidence(F.col("expected_return"), F.col("pattern_strength")),
            "risk": P.risk_category(F.col("volatility"), F.col("atr_share")),
        }
    )
    text = P.decision_text(F.col("expected_return"), F.col("confidence"), F.col("risk"), F.col("best_pattern"))
    return out.withColumn("decision", text)


def allocations(sig: DataFrame) -> DataFrame:
    raw = P.raw_allocation(*[F.col(c) for c in ("expected_return", "volatility", "confidence", "pattern_strength", "risk")])
    return sig.withColumn("raw_allocation", raw)


def _mean(n: int) -> str:
    return f"avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


MODELS_SQL = (
    "means AS (SELECT symbol, date, close, close AS n1, "
    + f"{_mean(20)} AS n20, {_mean(5)} AS n5 FROM bars),\n"
    + "long AS ("
    + " UNION ALL ".join(
        f"SELECT symbol, date, close, '{m}' AS model, n{n} AS next, lag(n{n}) OVER (PARTITION BY symbol ORDER BY date) AS predicted FROM means"
        for m, n in MODELS.items()
    )
    + """),
errors AS (SELECT symbol, model, sqrt(avg(pow(close - predicted, 2))) AS rmse, arg_max(next, date) AS forecast
  FROM long GROUP BY 1, 2)"""
)

WEIGHTED_SQL = """weighted AS (SELECT symbol, CASE WHEN sum(CASE WHEN rmse > 0 THEN 1 / rmse ELSE 0 END) > 0
  THEN sum(CASE WHEN rmse > 0 THEN forecast / rmse ELSE 0 END) / sum(CASE WHEN rmse > 0 THEN 1 / rmse ELSE 0 END)
  ELSE avg(forecast) END AS weighted_forecast FROM errors GROUP BY 1)"""

SIGNALS_SQL = """
lastbar AS (SELECT symbol, arg_max(close, date) AS current_price FROM bars GROUP BY 1),
lastatr AS (SELECT symbol, arg_max(atr14, date) AS atr14 FROM atr GROUP BY 1),
sig0 AS (SELECT p.symbol, current_price, weighted_forecast, volatility, best_pattern, coalesce(pattern_strength, 0) AS pattern_strength,
  CASE WHEN current_price > 0 THEN (weighted_forecast - current_price) / current_price ELSE 0 END AS expected_return,
  CASE WHEN current_price <> 0 THEN atr14 / current_price ELSE 0 END AS atr_share
  FROM lastbar p JOIN weighted USING (symbol) JOIN vol USING (symbol) JOIN lastatr USING (symbol) LEFT JOIN best USING (symbol)),
sig1 AS (SELECT *, CASE WHEN expected_return > 0 AND pattern_strength > 0 THEN 0.5 + 0.5 * least(1, abs(expected_return * 5))
  WHEN expected_return < 0 AND pattern_strength < 0 THEN -0.5 - 0.5 * least(1, abs(expected_return * 5))
  ELSE expected_return * 0.5 END AS confidence,
  CASE WHEN volatility + atr_share < 0.2 THEN 'Low' WHEN volatility + atr_share < 0.5 THEN 'Medium' ELSE 'High' END AS risk FROM sig0),
sig AS (SELECT *, concat_ws(' | ', CASE WHEN expected_return > 0 THEN 'Potential Buy' WHEN expected_return < 0 THEN 'Potential Sell' ELSE 'Hold' END,
  'Confidence: ' || round(abs(confidence) * 100, 1)::VARCHAR || '%', 'Risk: ' || risk,
  CASE WHEN best_pattern IS NOT NULL THEN 'Pattern: ' || best_pattern END) AS decision FROM sig1)
"""

RAW_SQL = """least(100, greatest(0, 100 * greatest(expected_return, 0) * (1 / (1 + 10 * greatest(volatility, 0)))
  * (0.5::DOUBLE + 0.5 * (least(1, greatest(-1, confidence)) + 1) / 2)
  * (0.5::DOUBLE + 0.5 * least(1, greatest(0, (pattern_strength + 2.0::DOUBLE) / 4)))
  * CASE risk WHEN 'Low' THEN 1.0::DOUBLE WHEN 'High' THEN 0.3::DOUBLE ELSE 0.6::DOUBLE END))"""
