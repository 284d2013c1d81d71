"""Time-series indicators, risk, forecasts and allocation over hourly bars of the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, rounded, table
from lakeops.operators import forecast as FC
from lakeops.operators import portfolio as P
from lakeops.operators import series as S
from lakeops.operators.ordered import row_numbers
from lakeops.plans import roles as R
from lakeops.plans import signals

AT = "strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date"
W = "WINDOW w AS (PARTITION BY symbol ORDER BY date)"


def _mean(col, n):
    return f"avg({col}) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


@query(
    "bars_from_ticks", "E1", "G5",
    sql=f"WITH {R.BARS_SQL} SELECT symbol, {AT}, open, high, low, close, volume FROM bars",
)
def _(spark, d):
    return R.bars(spark, d)


@query(
    "moving_averages", "L1", "F5",
    sql=f"WITH {R.BARS_SQL} SELECT symbol, {AT}, round({_mean('close', 50)}, 9) AS ma50, round({_mean('close', 200)}, 9) AS ma200 FROM bars",
)
def _(spark, d):
    return rounded(S.moving_averages(R.bars(spark, d), size=300).select("symbol", "date", "ma50", "ma200"), 9)


RSI_SQL = f"""
step AS (SELECT *, close - lag(close) OVER w AS s FROM bars {W}),
gl AS (SELECT *, CASE WHEN s IS NOT NULL THEN greatest(s, 0) END AS g, CASE WHEN s IS NOT NULL THEN greatest(-s, 0) END AS l FROM step),
rs AS (SELECT symbol, date, {_mean('g', 14)} / nullif({_mean('l', 14)}, 0) AS rs FROM gl),
raw AS (SELECT symbol, date, 100 - 100 / (1 + rs) AS r FROM rs),
rsi AS (SELECT symbol, date, coalesce(last_value(r IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING), 50) AS rsi FROM raw)"""


@query("relative_strength", "L2", "F6", "F7", sql=f"WITH {R.BARS_SQL}, {RSI_SQL} SELECT symbol, {AT}, round(rsi, 6) AS rsi FROM rsi")
def _(spark, d):
    return rounded(S.rsi(R.bars(spark, d), size=100).select("symbol", "date", "rsi"))


MACD_SQL = f"""
n AS (SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS i FROM bars),
e AS (SELECT symbol, date, i, close AS f, close AS s, 0.0::DOUBLE AS sig FROM n WHERE i = 1
  UNION ALL
  SELECT symbol, date, i, f, s, sig + (f - s - sig) * (2.0 / 10)::DOUBLE FROM (
    SELECT n.symbol, n.date, n.i, e.f + (n.close - e.f) * (2.0::DOUBLE / 13) AS f, e.s + (n.close - e.s) * (2.0::DOUBLE / 27) AS s, e.sig
    FROM e JOIN n ON n.symbol = e.symbol AND n.i = e.i + 1)),
macd AS (SELECT symbol, date, f - s AS macd, sig AS macd_signal FROM e)"""


@query(
    "macd_and_signal", "L3", "F8", "N3",
    sql=f"WITH RECURSIVE {R.BARS_SQL}, {MACD_SQL} SELECT symbol, {AT}, round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal FROM macd",
)
def _(spark, d):
    return rounded(S.macd(R.bars(spark, d)).select("symbol", "date", "macd", "macd_signal"))


ATR_SQL = f"""
tr AS (SELECT symbol, date, greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr FROM bars {W}),
atr AS (SELECT symbol, date, {_mean('tr', 14)} AS atr14 FROM tr)"""


@query("average_true_range", "L4", sql=f"WITH {R.BARS_SQL}, {ATR_SQL} SELECT symbol, {AT}, round(atr14, 6) AS atr14 FROM atr")
def _(spark, d):
    return rounded(S.atr(R.bars(spark, d), size=100).select("symbol", "date", "atr14"))


@query(
    "close_range_risk", "L5",
    sql=f"""WITH {R.BARS_SQL}, c AS (SELECT symbol, date, close, abs(close - lag(close) OVER w) AS s FROM bars {W}),
    t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 14)
    SELECT symbol, round(avg(s) / arg_max(close, date), 6) AS range_risk FROM t GROUP BY 1""",
)
def _(spark, d):
    return rounded(S.close_range_risk(R.bars(spark, d)))


VOL_SQL = f"""
ret AS (SELECT symbol, date, coalesce(close / lag(close) OVER w - 1, 0) AS ret FROM bars {W}),
vol AS (SELECT symbol, stddev_samp(ret) * sqrt(252) AS volatility FROM ret GROUP BY 1)"""


@query("annualised_volatility", "L6", sql=f"WITH {R.BARS_SQL}, {VOL_SQL} SELECT symbol, round(volatility, 6) AS volatility FROM vol")
def _(spark, d):
    return rounded(S.annualised_volatility(R.bars(spark, d)))


# The SQL twin states each rule once, in definition order.
RULES_SQL = {
    "Bullish Engulfing": ("c1 < o1 AND c0 > o0 AND c0 > c1 AND o0 < o1", 2),
    "Bearish Engulfing": ("c1 > o1 AND c0 < o0 AND c0 < c1 AND o0 > o1", -2),
    "Hammer": ("c0 - l0 > 2 * abs(o0 - c0)", 2),
    "Hanging Man": ("c0 - l0 > 2 * abs(o0 - c0) AND c0 < o0", 0),
    "Inverted Hammer": ("h0 - c0 > 2 * abs(o0 - c0) AND c0 > o0", 0),
    "Shooting Star": ("h0 - c0 > 2 * abs(o0 - c0) AND c0 < o0", -2),
    "Morning Star": ("c2 < o2 AND abs(c1 - o1) / abs(c2 - o2) < 0.5 AND c0 > (o2 + c2) / 2", 2),
    "Evening Star": ("c2 > o2 AND abs(c1 - o1) / abs(c2 - o2) < 0.5 AND c0 < (o2 + c2) / 2", -2),
    "Piercing Line": ("c1 < o1 AND c0 > o0 AND c0 > c1 + (o1 - c1) / 2", 1),
    "Dark Cloud Cover": ("c1 > o1 AND c0 < o0 AND c0 < c1 - (c1 - o1) / 2", -1),
    "Bullish Harami": ("c1 < o1 AND o0 > c1 AND c0 < o1", 1),
    "Bearish Harami": ("c1 > o1 AND o0 < c1 AND c0 > o1", -1),
    "Three White Soldiers": ("c2 > o2 AND c1 > o1 AND c0 > o0 AND c2 < c1 AND c1 < c0", 2),
    "Three Black Crows": ("c2 < o2 AND c1 < o1 AND c0 < o0 AND c2 > c1 AND c1 > c0", -2),
    "Bullish Kicker": ("c1 < o1 AND c0 > o0 AND o0 > c1", 2),
    "Bearish Kicker": ("c1 > o1 AND c0 < o0 AND o0 < c1", -2),
    "Doji": ("h0 = l0 OR abs(c0 - o0) / (h0 - l0) < 0.1", 0),
    "Long-Legged Doji": ("h0 = l0 OR (abs(c0 - o0) / (h0 - l0) < 0.05 AND h0 - l0 > 2 * abs(c0 - o0))", 0),
    "Upside Gap Two Crows": ("c2 < o2 AND c1 < o1 AND o1 > c2 AND c0 < o0 AND o0 < c1", 1),
    "Downside Gap Two Rabbits": ("c2 > o2 AND c1 > o1 AND o1 < c2 AND c0 > o0 AND o0 > c1", -1),
}
LAST3_SQL = f"""
b3 AS (SELECT symbol, date, open AS o0, high AS h0, low AS l0, close AS c0, lag(open) OVER w AS o1, lag(close) OVER w AS c1,
  lag(open, 2) OVER w AS o2, lag(close, 2) OVER w AS c2, row_number() OVER w AS i FROM bars {W}),
last3 AS (SELECT * FROM b3 WHERE i >= 3 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)"""
FOUND_SQL = "found AS (" + " UNION ALL ".join(
    f"SELECT symbol, {i} AS pos, '{p}' AS pattern, {s} AS strength FROM {{src}} WHERE {rule}"
    for i, (p, (rule, s)) in enumerate(RULES_SQL.items())
) + ")"


@query(
    "candle_patterns", "L7",
    sql=f"WITH {R.BARS_SQL}, {LAST3_SQL}, {FOUND_SQL.format(src='last3')} SELECT symbol, pos, pattern, strength FROM found",
)
def _(spark, d):
    return S.detected_patterns(R.bars(spark, d))


BEST_SQL = """best AS (SELECT symbol, arg_min(pattern, (-abs(strength), pos)) AS best_pattern,
  arg_min(strength, (-abs(strength), pos)) AS pattern_strength FROM found GROUP BY 1)"""


@query(
    "best_pattern", "L8",
    sql=f"WITH {R.BARS_SQL}, {LAST3_SQL}, {FOUND_SQL.format(src='last3')}, {BEST_SQL} SELECT * FROM best",
)
def _(spark, d):
    return S.best_pattern(R.bars(spark, d))


DAILY_USER_SQL = """
bars AS (SELECT user_id::VARCHAR AS symbol, date_trunc('day', ts) AS date, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
  min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2)"""


def _daily_user_bars(spark, d):
    ev = R.events(spark, d).withColumn("user_id", F.col("user_id").cast("string"))
    return S.bars_from_ticks(ev, "user_id", "ts", "event_id", "value", "day")


@query(
    "candle_patterns_many_symbols", "L7", "L8",
    sql=f"WITH {DAILY_USER_SQL}, {LAST3_SQL}, {FOUND_SQL.format(src='last3')}, {BEST_SQL} SELECT * FROM best",
)
def _(spark, d):
    return S.best_pattern(_daily_user_bars(spark, d))


@query("forecast_autoregressive", "L9", "N3")
def _(spark, d):
    return rounded(FC.forecast_ar(R.bars(spark, d), horizon=30), 4)


@query("forecast_trend_seasonal", "L10", "N3")
def _(spark, d):
    return rounded(FC.forecast_trend_seasonal(R.bars(spark, d), horizon=30), 4)


@query(
    "trend_line", "L10",
    sql=f"""WITH {R.BARS_SQL}, t AS (SELECT symbol, close, (epoch_us(date) - (SELECT min(epoch_us(date)) FROM bars)) / 86400e6 AS t FROM bars)
    SELECT symbol, round(regr_slope(close, t), 6) AS slope, round(regr_intercept(close, t), 6) AS intercept FROM t GROUP BY 1""",
)
def _(spark, d):
    return rounded(FC.trend_line(R.bars(spark, d)))


@query(
    "forecast_order_one", "L9", "I12",
    sql=f"""WITH {R.BARS_SQL}, n AS (SELECT symbol, date, close, close - lag(close) OVER w AS s FROM bars {W}),
    l AS (SELECT *, lag(s) OVER w AS p FROM n {W}),
    f AS (SELECT symbol, sum(s * p) / sum(p * p) AS phi, arg_max(close, date) AS close, arg_max(s, date) AS s, max(date)::DATE AS last FROM l GROUP BY 1)
    SELECT symbol, h AS step, (last + h::INT)::DATE::VARCHAR AS date, round(close + s * phi * (1 - pow(phi, h)) / (1 - phi), 4) AS forecast
    FROM f, (SELECT unnest(generate_series(1, 30)) AS h)""",
)
def _(spark, d):
    return rounded(FC.forecast_ar(R.bars(spark, d), p=1, horizon=30), 4)


@query(
    "forecast_trend_only", "L10", "I12",
    sql=f"""WITH {R.BARS_SQL}, z AS (SELECT symbol, min(epoch_us(date)) AS z FROM bars GROUP BY 1),
    t AS (SELECT symbol, close, date, (epoch_us(date) - z) / 86400e6 AS t FROM bars JOIN z USING (symbol)),
    f AS (SELECT symbol, regr_slope(close, t) AS a, regr_intercept(close, t) AS b, max(t) AS last_t, max(date)::DATE AS last FROM t GROUP BY 1)
    SELECT symbol, h AS step, (last + h::INT)::DATE::VARCHAR AS date, round(b + a * (last_t + h), 4) AS forecast
    FROM f, (SELECT unnest(generate_series(1, 30)) AS h)""",
)
def _(spark, d):
    return rounded(FC.forecast_trend_seasonal(R.bars(spark, d), horizon=30, periods=()), 4)


@query("forecast_forest", "L11")
def _(spark, d):
    return rounded(FC.forecast_forest(R.bars(spark, d), horizon=30), 4)


@query(
    "forecast_forest_bounds", "L11",
    sql=f"""WITH {R.BARS_SQL}, a AS (SELECT *, row_number() OVER {W.replace('WINDOW w AS ', '')} AS i, count(*) OVER (PARTITION BY symbol) AS n FROM bars),
    t AS (SELECT * FROM a WHERE i <= greatest(5, n - 30)), b AS (SELECT symbol, arg_max(close, i) AS base FROM t GROUP BY 1)
    SELECT symbol, 30 AS steps, 1 AS levels, true AS in_bounds FROM b""",
)
def _(spark, d):
    """A forest cannot leave the range of its training labels, closes relative to each symbol's last one."""
    bars = R.bars(spark, d)
    told = FC.forecast_forest(bars, horizon=30)
    sizes = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    placed = row_numbers(bars, "symbol", ["date"], "i").join(sizes, "symbol").filter("i <= greatest(5, n - 30)")
    base = placed.groupBy("symbol").agg(F.max_by("close", "i").alias("base"))
    ratio = placed.join(base, "symbol").select((F.col("close") / F.col("base")).alias("r"))
    low, high = ratio.agg(F.min("r")).scalar(), ratio.agg(F.max("r")).scalar()
    inside = (F.col("forecast") >= low * F.col("base") - 1e-6) & (F.col("forecast") <= high * F.col("base") + 1e-6)
    return told.join(base, "symbol").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("steps"), F.countDistinct("forecast").alias("levels"), F.bool_and(inside).alias("in_bounds")
    )


@query(
    "forecast_decisions", "L9", "L10", "L11", "L14", "L15", "L16", "L19", "L23", "G5",
    sql=f"""WITH {R.BARS_SQL} SELECT symbol, arg_max(close, date) AS current_price, true AS has_model, true AS has_error,
    true AS dates_ahead, true AS has_decision FROM bars GROUP BY 1""",
)
def _(spark, d):
    """Fitted forecasts, hold-out error, best model, dates on its forecast and decision in one plan."""
    bars = R.bars(spark, d)
    last = bars.groupBy("symbol").agg(F.max("date").cast("date").alias("last"))
    ahead = lambda c: F.col(c).between(F.date_add("last", 1), F.date_add("last", 30))
    return signals.forecast_decisions(bars, trees=50).join(last, "symbol").select(
        "symbol", "current_price",
        F.col("best_model").isin("autoregressive", "forest", "trend_seasonal").alias("has_model"),
        (F.col("best_rmse") >= 0).alias("has_error"),
        (ahead("buy_date") & ahead("sell_date")).alias("dates_ahead"),
        F.col("decision").rlike("^(Potential (Buy|Sell)|Hold) [|] Confidence: ").alias("has_decision"),
    )


# ---- errors, weights, allocation: three simple predictors of the next close ----


@query(
    "model_rmse", "L12",
    sql=f"WITH {R.BARS_SQL}, {signals.MODELS_SQL} SELECT symbol, model, round(rmse, 6) AS rmse FROM errors",
)
def _(spark, d):
    return rounded(signals.model_errors(R.bars(spark, d)))


@query(
    "directional_accuracy", "L13",
    sql=f"""WITH {R.BARS_SQL}, m AS (SELECT symbol, date, close AS actual, {_mean('close', 3)} AS predicted FROM bars),
    s AS (SELECT symbol, (actual - lag(actual) OVER w) * (predicted - lag(predicted) OVER w) AS x FROM m {W})
    SELECT symbol, round(avg(CASE WHEN x IS NULL THEN NULL WHEN x > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS directional_accuracy
    FROM s GROUP BY 1""",
)
def _(spark, d):
    b = S.moving_averages(R.bars(spark, d), [3]).select("symbol", "date", F.col("close").alias("actual"), F.col("ma3").alias("predicted"))
    return rounded(P.directional_accuracy(b, "symbol", "date", "actual", "predicted", F.date_trunc("day", "date")))


@query(
    "best_model", "L14",
    sql=f"""WITH {R.BARS_SQL}, {signals.MODELS_SQL} SELECT symbol, arg_min(model, (rmse, model)) AS best_model,
    round(min(rmse), 6) AS best_rmse FROM errors GROUP BY 1""",
)
def _(spark, d):
    return rounded(P.pick_best_model(signals.model_errors(R.bars(spark, d))))


@query(
    "weighted_forecast", "L15",
    sql=f"""WITH {R.BARS_SQL}, {signals.MODELS_SQL}, {signals.WEIGHTED_SQL}
    SELECT symbol, round(weighted_forecast, 6) AS weighted_forecast FROM weighted""",
)
def _(spark, d):
    return rounded(signals.weighted(R.bars(spark, d)))


_SIGNALS = f"""WITH {R.BARS_SQL}, {signals.MODELS_SQL}, {signals.WEIGHTED_SQL}, {VOL_SQL}, {ATR_SQL}, {LAST3_SQL},
{FOUND_SQL.format(src='last3')}, {BEST_SQL}, {signals.SIGNALS_SQL}"""


@query("expected_return", "L16", sql=_SIGNALS + "SELECT symbol, round(expected_return, 6) AS expected_return FROM sig")
def _(spark, d):
    return rounded(signals.signals(R.bars(spark, d)).select("symbol", "expected_return"))


@query("signal_confidence", "L17", sql=_SIGNALS + "SELECT symbol, pattern_strength, round(confidence, 6) AS confidence FROM sig")
def _(spark, d):
    return rounded(signals.signals(R.bars(spark, d)).select("symbol", "pattern_strength", "confidence"))


@query("risk_category", "L18", sql=_SIGNALS + "SELECT symbol, round(atr_share, 6) AS atr_share, risk FROM sig")
def _(spark, d):
    return rounded(signals.signals(R.bars(spark, d)).select("symbol", "atr_share", "risk"))


@query("decision_text", "L19", sql=_SIGNALS + "SELECT symbol, decision FROM sig")
def _(spark, d):
    return signals.signals(R.bars(spark, d)).select("symbol", "decision")


@query(
    "kelly_fraction", "L20",
    sql=_SIGNALS + """SELECT symbol, round(CASE WHEN volatility * volatility <= 0 THEN 0
    ELSE greatest(0, expected_return / (volatility * volatility)) END, 6) AS kelly FROM sig""",
)
def _(spark, d):
    s = signals.signals(R.bars(spark, d))
    kelly = P.kelly_fraction(F.col("expected_return"), F.col("volatility") * F.col("volatility"))
    return rounded(s.select("symbol", kelly.alias("kelly")))


@query(
    "raw_allocation", "L21",
    sql=_SIGNALS + f"SELECT symbol, round({signals.RAW_SQL}, 6) AS raw_allocation FROM sig",
)
def _(spark, d):
    return rounded(signals.allocations(signals.signals(R.bars(spark, d))).select("symbol", "raw_allocation"))


FLOOR_SQL = """
t AS (SELECT *, sum(raw) OVER (PARTITION BY g) AS total, count(*) OVER (PARTITION BY g) AS n FROM raws),
b AS (SELECT *, least(3.0::DOUBLE, 100.0::DOUBLE / n) AS low,
  greatest(CASE WHEN total > 0 THEN raw / total * 100 ELSE 100.0::DOUBLE / n END, least(3.0::DOUBLE, 100.0::DOUBLE / n)) AS a FROM t),
s AS (SELECT *, sum(a) OVER (PARTITION BY g) AS suma, sum(a - low) OVER (PARTITION BY g) AS above FROM b),
f AS (SELECT *, CASE WHEN suma > 100 THEN CASE WHEN above > 1e-9 THEN greatest(low, a - (suma - 100) * (a - low) / above)
  ELSE 100.0::DOUBLE / n END ELSE a * 100 / suma END AS alloc FROM s)"""


@query(
    "allocation_with_floor", "L22",
    sql=f"""WITH raws AS (SELECT c_custkey, c_nationkey AS g, greatest(c_acctbal, 0) AS raw FROM customer), {FLOOR_SQL}
    SELECT c_custkey, g AS c_nationkey, round(alloc, 6) AS allocation_pct FROM f""",
)
def _(spark, d):
    raws = table(spark, d, "customer").select(
        "c_custkey", "c_nationkey", F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("raw_allocation")
    )
    return rounded(P.normalise_with_floor(raws, by="c_nationkey").drop("raw_allocation"))


@query(
    "allocation_with_floor_one_portfolio", "L22",
    sql=f"""WITH raws AS (SELECT n_name AS symbol, 0 AS g, sum(c_acctbal) AS raw FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
    {FLOOR_SQL} SELECT symbol, round(alloc, 6) AS allocation_pct FROM f""",
)
def _(spark, d):
    raws = (
        table(spark, d, "customer")
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("symbol"))
        .agg(F.sum("c_acctbal").alias("raw_allocation"))
    )
    return rounded(P.normalise_with_floor(raws).drop("raw_allocation"))


@query(
    "indicator_table", "L23", "L1", "L2", "L3", "L4",
    sql=f"""WITH RECURSIVE {R.BARS_SQL}, {RSI_SQL}, {ATR_SQL}, {MACD_SQL},
    ma AS (SELECT symbol, date, close, {_mean('close', 50)} AS ma50, {_mean('close', 200)} AS ma200 FROM bars)
    SELECT symbol, {AT}, round(ma50, 9) AS ma50, round(ma200, 9) AS ma200, round(rsi, 6) AS rsi, round(atr14, 6) AS atr14,
    round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal
    FROM ma JOIN rsi USING (symbol, date) JOIN atr USING (symbol, date) JOIN macd USING (symbol, date)""",
)
def _(spark, d):
    out = S.indicators(R.bars(spark, d))
    return rounded(out.select("symbol", "date", "ma50", "ma200", "rsi", "atr14", "macd", "macd_signal"), ma50=9, ma200=9)


@query(
    "symbol_decisions", "L23", "L16", "L17", "L18", "L19", "L21", "L22",
    sql=_SIGNALS + f""", raws AS (SELECT symbol, decision, current_price, 0 AS g, {signals.RAW_SQL} AS raw FROM sig), {FLOOR_SQL}
    SELECT symbol, current_price, decision, round(alloc, 6) AS allocation_pct FROM f""",
)
def _(spark, d):
    out = P.normalise_with_floor(signals.allocations(signals.signals(R.bars(spark, d))))
    return rounded(out.select("symbol", "current_price", "decision", "allocation_pct"))


# ---- indicators named in documentation only ----


@query(
    "bollinger_bands", "O1",
    sql=f"""WITH {R.BARS_SQL}, b AS (SELECT symbol, date, {_mean('close', 20)} AS m,
    coalesce({_mean('close', 20).replace('avg(', 'stddev_samp(')}, 0) AS s FROM bars)
    SELECT symbol, {AT}, round(m, 6) AS bb_mid, round(m + 2 * s, 6) AS bb_upper, round(m - 2 * s, 6) AS bb_lower FROM b""",
)
def _(spark, d):
    return rounded(S.bollinger(R.bars(spark, d), size=100).select("symbol", "date", "bb_mid", "bb_upper", "bb_lower"))


@query(
    "golden_cross", "O1",
    sql=f"""WITH {R.BARS_SQL}, m AS (SELECT symbol, date, sign(round({_mean('close', 5)} - {_mean('close', 20)}, 9)) AS side FROM bars),
    p AS (SELECT *, lag(side) OVER w AS prev FROM m {W})
    SELECT symbol, {AT}, CASE WHEN prev <= 0 AND side > 0 THEN 1 WHEN prev >= 0 AND side < 0 THEN -1 ELSE 0 END AS "cross" FROM p""",
)
def _(spark, d):
    return S.golden_cross(R.bars(spark, d), 5, 20, size=100).select("symbol", "date", "cross")


@query(
    "on_balance_volume", "O1",
    sql=f"""WITH {R.BARS_SQL}, s AS (SELECT symbol, date, coalesce(sign(close - lag(close) OVER w), 0) * volume AS v FROM bars {W})
    SELECT symbol, {AT}, sum(v) OVER (PARTITION BY symbol ORDER BY date)::DOUBLE AS obv FROM s""",
)
def _(spark, d):
    return S.on_balance_volume(R.bars(spark, d)).select("symbol", "date", "obv")


@query(
    "candle_shape", "O2",
    sql=f"""WITH {R.BARS_SQL} SELECT symbol, {AT}, round(abs(close - open) / nullif(high - low, 0), 6) AS body_size,
    round((high - greatest(open, close)) / nullif(high - low, 0), 6) AS upper_wick,
    round((least(open, close) - low) / nullif(high - low, 0), 6) AS lower_wick FROM bars""",
)
def _(spark, d):
    return rounded(S.candle_shape(R.bars(spark, d)).select("symbol", "date", "body_size", "upper_wick", "lower_wick"))
