"""Indicators over one long table of bars (symbol, date, open, high, low, close, volume).

Trailing windows run per (symbol, block) with a halo of earlier rows, see
:func:`lakeops.operators.ordered.split_blocks`; a symbol with a very long
history is computed by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.ordered import (
    block_window,
    drop_halo,
    fill_forward,
    running,
    split_blocks,
    with_previous,
)
from lakeops.operators.windows import _chunk, ema_halo, ema_in_blocks, tail_n
from lakeops.session import materialise

SYMBOL, DATE = "symbol", "date"


def bars_from_ticks(df: DataFrame, key: str, ts: str, tie: str, value: str, unit: str = "hour") -> DataFrame:
    """Open, high, low, close and volume per key and time bucket."""
    at = F.struct(ts, tie)
    return df.groupBy(F.col(key).alias(SYMBOL), F.date_trunc(unit, F.col(ts)).alias(DATE)).agg(
        F.min_by(value, at).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, at).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def _blocks(df: DataFrame, symbol: str, date: str, halo: int, size: int, chunk) -> DataFrame:
    return split_blocks(df, symbol, [date], halo, max(size, halo), _chunk(df, date, chunk))


def _prev(col: str, symbol: str, n: int = 1) -> Column:
    return F.lag(col, n).over(block_window(symbol))


def _mean(col: str, symbol: str, n: int) -> Column:
    return F.avg(col).over(block_window(symbol, n))


def _add_moving_averages(b: DataFrame, symbol: str, windows: Sequence[int]) -> DataFrame:
    return b.withColumns({f"ma{n}": _mean("close", symbol, n) for n in windows})


def _add_rsi(b: DataFrame, symbol: str, n: int) -> DataFrame:
    """RSI before filling: null where the mean loss is zero and on the first row."""
    step = F.col("_step")
    zero = F.lit(0.0)
    parts = b.withColumn("_step", F.col("close") - _prev("close", symbol)).withColumns(
        {
            "_gain": F.when(step.isNotNull(), F.greatest(step, zero)),
            "_loss": F.when(step.isNotNull(), F.greatest(-step, zero)),
        }
    )
    means = parts.withColumns({"_mg": _mean("_gain", symbol, n), "_ml": _mean("_loss", symbol, n)})
    rs = F.try_divide(F.col("_mg"), F.nullif(F.col("_ml"), zero))
    return means.withColumn("rsi", F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)).drop(
        "_step", "_gain", "_loss", "_mg", "_ml"
    )


def _add_atr(b: DataFrame, symbol: str, n: int) -> DataFrame:
    """Mean true range; on the first row the range is high - low."""
    pc = F.col("_pc")
    true_range = F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - pc), F.abs(F.col("low") - pc)
    )
    return (
        b.withColumn("_pc", _prev("close", symbol))
        .withColumn("_tr", true_range)
        .withColumn(f"atr{n}", _mean("_tr", symbol, n))
        .drop("_pc", "_tr")
    )


def macd_rules(fast: int, slow: int, signal: int) -> dict:
    return {
        "_fast": ("close", fast),
        "_slow": ("close", slow),
        "macd": ("_fast", "_slow"),
        "macd_signal": ("macd", signal),
    }


def macd_halo(slow: int, signal: int) -> int:
    return ema_halo(slow) + ema_halo(signal)


def moving_averages(
    df: DataFrame, windows: Sequence[int] = (50, 200), symbol=SYMBOL, date=DATE, chunk=None, size=100_000
) -> DataFrame:
    b = _blocks(df, symbol, date, max(windows) - 1, size, chunk)
    return drop_halo(_add_moving_averages(b, symbol, windows))


def rsi(df: DataFrame, n: int = 14, symbol=SYMBOL, date=DATE, chunk=None, size=100_000) -> DataFrame:
    """Relative strength from simple means; gaps take the last value, 50 at the start."""
    b = _blocks(df, symbol, date, n, size, chunk)
    raw = materialise(drop_halo(_add_rsi(b, symbol, n)), "rsi")
    return fill_forward(raw, symbol, [date], ["rsi"], _chunk(df, date, chunk)).fillna(50.0, ["rsi"])


def macd(
    df: DataFrame, fast=12, slow=26, signal=9, symbol=SYMBOL, date=DATE, chunk=None, size=100_000
) -> DataFrame:
    b = _blocks(df, symbol, date, macd_halo(slow, signal), size, chunk)
    return drop_halo(ema_in_blocks(b, symbol, macd_rules(fast, slow, signal))).drop("_fast", "_slow")


def atr(df: DataFrame, n: int = 14, symbol=SYMBOL, date=DATE, chunk=None, size=100_000) -> DataFrame:
    return drop_halo(_add_atr(_blocks(df, symbol, date, n, size, chunk), symbol, n))


def close_range_risk(df: DataFrame, n: int = 14, symbol=SYMBOL, date=DATE, chunk=None) -> DataFrame:
    """Mean absolute close change over the last n bars, as a share of the last price."""
    last = _with_prev_close(tail_n(df, symbol, date, n + 1), symbol, date)
    steps = last.withColumn("_d", F.abs(F.col("close") - F.col("prev_close")))
    recent = steps.withColumn("_rn", F.row_number().over(_desc(symbol, date)))
    return recent.groupBy(symbol).agg(
        F.try_divide(
            F.avg(F.when(F.col("_rn") <= n, F.col("_d"))), F.max_by("close", date)
        ).alias("range_risk")
    )


def _desc(symbol: str, date: str):
    from pyspark.sql import Window

    return Window.partitionBy(symbol).orderBy(F.col(date).desc())


def _with_prev_close(df: DataFrame, symbol: str, date: str) -> DataFrame:
    """Previous close within a frame already cut to a few rows per symbol."""
    from pyspark.sql import Window

    w = Window.partitionBy(symbol).orderBy(date)
    return df.withColumn("prev_close", F.lag("close").over(w))


def returns(df: DataFrame, symbol=SYMBOL, date=DATE, chunk=None) -> DataFrame:
    """Bar-to-bar return, 0 on the first bar."""
    prev = with_previous(df, symbol, [date], ["close"], _chunk(df, date, chunk))
    change = F.try_divide(F.col("close"), F.col("prev_close")) - 1
    return prev.withColumn("ret", F.coalesce(change, F.lit(0.0))).drop("prev_close")


def annualised_volatility(df: DataFrame, symbol=SYMBOL, date=DATE, chunk=None) -> DataFrame:
    r = returns(df, symbol, date, chunk)
    return r.groupBy(symbol).agg((F.stddev_samp("ret") * F.sqrt(F.lit(252.0))).alias("volatility"))


# Pattern strengths in definition order; the order breaks ties.
PATTERNS = {
    "Bullish Engulfing": 2,
    "Bearish Engulfing": -2,
    "Hammer": 2,
    "Hanging Man": 0,
    "Inverted Hammer": 0,
    "Shooting Star": -2,
    "Morning Star": 2,
    "Evening Star": -2,
    "Piercing Line": 1,
    "Dark Cloud Cover": -1,
    "Bullish Harami": 1,
    "Bearish Harami": -1,
    "Three White Soldiers": 2,
    "Three Black Crows": -2,
    "Bullish Kicker": 2,
    "Bearish Kicker": -2,
    "Doji": 0,
    "Long-Legged Doji": 0,
    "Upside Gap Two Crows": 1,
    "Downside Gap Two Rabbits": -1,
}


def pattern_conditions() -> dict[str, Column]:
    """Condition of each pattern over ``o0 h0 l0 c0`` (last bar), ``o1 c1`` and ``o2 c2``."""
    o0, h0, l0, c0, o1, c1, o2, c2 = (F.col(x) for x in ("o0", "h0", "l0", "c0", "o1", "c1", "o2", "c2"))
    up0, up1, up2 = c0 > o0, c1 > o1, c2 > o2
    dn0, dn1, dn2 = c0 < o0, c1 < o1, c2 < o2
    body0, span = F.abs(o0 - c0), h0 - l0
    long_lower = (c0 - l0) > 2 * body0
    long_upper = (h0 - c0) > 2 * body0
    small_star = F.try_divide(F.abs(c1 - o1), F.abs(c2 - o2)) < 0.5
    middle2 = (o2 + c2) / 2
    thin = F.try_divide(body0, span)
    # The twenty conditions, and their order, which decides between equal strengths.
    return {
        "Bullish Engulfing": dn1 & up0 & (c0 > c1) & (o0 < o1),
        "Bearish Engulfing": up1 & dn0 & (c0 < c1) & (o0 > o1),
        "Hammer": long_lower,
        "Hanging Man": long_lower & dn0,
        "Inverted Hammer": long_upper & up0,
        "Shooting Star": long_upper & dn0,
        "Morning Star": dn2 & small_star & (c0 > middle2),
        "Evening Star": up2 & small_star & (c0 < middle2),
        "Piercing Line": dn1 & up0 & (c0 > c1 + (o1 - c1) / 2),
        "Dark Cloud Cover": up1 & dn0 & (c0 < c1 - (c1 - o1) / 2),
        "Bullish Harami": dn1 & (o0 > c1) & (c0 < o1),
        "Bearish Harami": up1 & (o0 < c1) & (c0 > o1),
        "Three White Soldiers": up2 & up1 & up0 & (c2 < c1) & (c1 < c0),
        "Three Black Crows": dn2 & dn1 & dn0 & (c2 > c1) & (c1 > c0),
        "Bullish Kicker": dn1 & up0 & (o0 > c1),
        "Bearish Kicker": up1 & dn0 & (o0 < c1),
        "Doji": (span == 0) | (thin < 0.1),
        "Long-Legged Doji": (span == 0) | ((thin < 0.05) & (span > 2 * body0)),
        "Upside Gap Two Crows": dn2 & dn1 & (o1 > c2) & dn0 & (o0 < c1),
        "Downside Gap Two Rabbits": up2 & up1 & (o1 < c2) & up0 & (o0 > c1),
    }


def last_bars(df: DataFrame, symbol=SYMBOL, date=DATE, n: int = 3) -> DataFrame:
    """One row per symbol with its last n bars side by side (0 is the newest)."""
    recent = tail_n(df, symbol, date, n).withColumn("_i", F.row_number().over(_desc(symbol, date)) - 1)
    short = {"open": "o", "high": "h", "low": "l", "close": "c"}
    picks = [
        F.max(F.when(F.col("_i") == i, F.col(c))).alias(f"{s}{i}") for i in range(n) for c, s in short.items()
    ]
    return recent.groupBy(symbol).agg(F.count(F.lit(1)).alias("bars"), *picks)


def candle_patterns(df: DataFrame, symbol=SYMBOL, date=DATE) -> DataFrame:
    """One boolean column per pattern from the last three bars of each symbol with at least three."""
    wide = last_bars(df, symbol, date).filter("bars >= 3")
    conds = pattern_conditions()
    return wide.select(symbol, *[F.coalesce(conds[p], F.lit(False)).alias(p) for p in PATTERNS])


def detected_patterns(df: DataFrame, symbol=SYMBOL, date=DATE) -> DataFrame:
    """Row per symbol and detected pattern, with its strength."""
    flags = candle_patterns(df, symbol, date)
    entries = F.array(
        *[
            F.when(F.col(f"`{p}`"), F.struct(F.lit(i).alias("pos"), F.lit(p).alias("pattern"), F.lit(s).alias("strength")))
            for i, (p, s) in enumerate(PATTERNS.items())
        ]
    )
    return flags.select(symbol, F.explode(F.array_compact(entries)).alias("_p")).select(symbol, "_p.*")


def best_pattern(df: DataFrame, symbol=SYMBOL, date=DATE) -> DataFrame:
    """Pattern of the largest absolute strength; definition order decides ties."""
    found = detected_patterns(df, symbol, date)
    order = F.struct(-F.abs("strength"), F.col("pos"))
    return found.groupBy(symbol).agg(
        F.min_by("pattern", order).alias("best_pattern"), F.min_by("strength", order).alias("pattern_strength")
    )


def bollinger(
    df: DataFrame, n: int = 20, width: float = 2.0, symbol=SYMBOL, date=DATE, chunk=None, size=100_000
) -> DataFrame:
    """Mean of n closes with bands of ``width`` sample deviations."""
    b = _blocks(df, symbol, date, n - 1, size, chunk)
    w = block_window(symbol, n)
    mid, dev = F.avg("close").over(w), F.coalesce(F.stddev_samp("close").over(w), F.lit(0.0))
    out = b.withColumns({"bb_mid": mid, "bb_upper": mid + width * dev, "bb_lower": mid - width * dev})
    return drop_halo(out)


def golden_cross(
    df: DataFrame, fast: int = 50, slow: int = 200, symbol=SYMBOL, date=DATE, chunk=None, size=100_000
) -> DataFrame:
    """Bars where the fast mean crosses the slow one: 1 upwards, -1 downwards."""
    b = _add_moving_averages(_blocks(df, symbol, date, slow, size, chunk), symbol, (fast, slow))
    # means closer than rounding noise count as equal
    b = b.withColumn("_side", F.signum(F.round(F.col(f"ma{fast}") - F.col(f"ma{slow}"), 9)))
    before = F.lag("_side").over(block_window(symbol))
    crossed = F.when((before <= 0) & (F.col("_side") > 0), 1).when((before >= 0) & (F.col("_side") < 0), -1)
    return drop_halo(b.withColumn("cross", F.coalesce(crossed, F.lit(0)))).drop("_side")


def on_balance_volume(df: DataFrame, symbol=SYMBOL, date=DATE, chunk=None) -> DataFrame:
    """Running volume, added on rising and subtracted on falling closes."""
    cut = _chunk(df, date, chunk)
    prev = with_previous(df, symbol, [date], ["close"], cut)
    step = F.coalesce(F.signum(F.col("close") - F.col("prev_close")), F.lit(0.0)) * F.col("volume")
    return running(prev, symbol, [date], {"obv": step}, chunk=cut).drop("prev_close")


def candle_shape(df: DataFrame) -> DataFrame:
    """Body and wick sizes as shares of the bar's range."""
    span = F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    top, bottom = F.greatest("open", "close"), F.least("open", "close")
    return df.withColumns(
        {
            "body_size": F.try_divide(F.abs(F.col("close") - F.col("open")), span),
            "upper_wick": F.try_divide(F.col("high") - top, span),
            "lower_wick": F.try_divide(bottom - F.col("low"), span),
        }
    )


def indicators(
    df: DataFrame, symbol=SYMBOL, date=DATE, chunk=None, size=100_000, macd_too: bool = True
) -> DataFrame:
    """Moving averages, RSI, ATR and MACD of every bar in one block split."""
    halo = max(200, macd_halo(26, 9) if macd_too else 0)
    b = _blocks(df, symbol, date, halo, size, chunk)
    b = _add_atr(_add_rsi(_add_moving_averages(b, symbol, (50, 200)), symbol, 14), symbol, 14)
    if macd_too:
        b = ema_in_blocks(b, symbol, macd_rules(12, 26, 9)).drop("_fast", "_slow")
    out = materialise(drop_halo(b), "indicators")
    return fill_forward(out, symbol, [date], ["rsi"], _chunk(df, date, chunk)).fillna(50.0, ["rsi"])


