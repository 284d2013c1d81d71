"""Window operators and trip aggregates built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, rounded, table
from lakeops.operators import aggregate as A
from lakeops.operators import windows as W
from lakeops.operators.topk import latest_by_key
from lakeops.plans import roles as R


@query(
    "standings_rank", "F1", "E2",
    sql=f"""WITH {R.POINTS_SQL}, s AS (SELECT race_year, n_name, sum(calculated_points)::BIGINT AS total_points,
    count(CASE WHEN position = 1 THEN 1 END) AS wins FROM points GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY race_year ORDER BY total_points DESC, wins DESC) AS rank FROM s""",
)
def _(spark, d):
    s = A.standings(R.race_points(spark, d), ["race_year", "n_name"], "calculated_points", "position")
    return W.rank_within(s, "race_year", ["-total_points", "-wins"], stage=True)


@query(
    "customer_rank_within_year", "F1",
    sql=f"""WITH {R.RACE_SQL}, s AS (SELECT race_year, o_custkey, count(*) AS n, max(l_linenumber) AS m FROM race GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY race_year ORDER BY n DESC, m) AS rank FROM s""",
)
def _(spark, d):
    s = R.race_rows(spark, d).groupBy("race_year", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("m")
    )
    return W.rank_within(s, "race_year", ["-n", "m"], stage=True)


@query(
    "overall_rank_of_averages", "F2",
    sql="""SELECT o_custkey, n, rank() OVER (ORDER BY a DESC) AS rank
    FROM (SELECT o_custkey, avg(o_totalprice) AS a, count(*) AS n FROM orders GROUP BY 1)""",
)
def _(spark, d):
    s = A.keyed_totals(table(spark, d, "orders"), ["o_custkey"], {"avg_price": F.avg("o_totalprice"), "n": F.count(F.lit(1))})
    return W.rank_overall(s, ["-avg_price"], stage=True).drop("avg_price")


@query(
    "rank_by_text_key", "F1", "F2",
    sql="SELECT c_custkey, rank() OVER (ORDER BY c_mktsegment DESC) AS rank, rank() OVER (ORDER BY c_name) AS by_name FROM customer",
)
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_name")
    ranked = W.rank_overall(c, ["-c_mktsegment"])
    return W.rank_overall(ranked, ["c_name"], "by_name").select("c_custkey", "rank", "by_name")


@query(
    "surrogate_key_by_name", "C20", "F3",
    sql="SELECT p_name, p_partkey, row_number() OVER (ORDER BY p_name DESC, p_partkey) AS part_sk FROM part",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_name", "p_partkey")
    return W.batch_ids(parts, ["-p_name", "p_partkey"], 1).select("p_name", "p_partkey", F.col("row_num").alias("part_sk"))


@query(
    "ordered_batch_ids", "F3",
    sql="""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_num,
    ((row_number() OVER (ORDER BY o_orderkey) - 1) // 20) AS batch_id FROM orders""",
)
def _(spark, d):
    return W.batch_ids(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 20)


@query(
    "previous_row_columns", "F4",
    sql="""SELECT event_id, lag(value) OVER w AS prev_value, lag(event_type) OVER w AS prev_event_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def _(spark, d):
    out = W.with_lags(R.events(spark, d), "user_id", "ts", ["value", "event_type"], tie=["event_id"])
    return out.select("event_id", "prev_value", "prev_event_type")


@query(
    "trailing_mean", "F5",
    sql=f"""WITH {R.BARS_SQL} SELECT symbol, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date,
    round(avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW), 6) AS mean14 FROM bars""",
)
def _(spark, d):
    # a small block size so that the blocks really meet in the check
    out = W.rolling_mean(R.bars(spark, d), "symbol", "date", "close", 14, "mean14", size=50)
    return rounded(out.select("symbol", "date", "mean14"))


@query(
    "difference_and_pct_change", "F6",
    sql=f"""WITH {R.BARS_SQL} SELECT symbol, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date, round(close - lag(close) OVER w, 6) AS diff,
    round(close / lag(close) OVER w - 1, 6) AS pct_change FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
)
def _(spark, d):
    b = W.pct_change(W.diff(R.bars(spark, d), "symbol", "date", "close"), "symbol", "date", "close")
    return rounded(b.select("symbol", "date", "diff", "pct_change"))


_GAPPY = f"""{R.BARS_SQL}, gappy AS (SELECT symbol, date, CASE WHEN close > 10 THEN close END AS close FROM bars)"""


def _gappy(spark, d):
    close = F.when(F.col("close") > 10, F.col("close"))
    return R.bars(spark, d).select("symbol", "date", close.alias("close"))


@query(
    "forward_fill_then_constant", "F7",
    sql=f"""WITH {_GAPPY} SELECT symbol, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date,
    coalesce(last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING), 50) AS close FROM gappy""",
)
def _(spark, d):
    return W.ffill(_gappy(spark, d), "symbol", "date", ["close"], default=50.0)


@query(
    "backward_fill", "F12",
    sql=f"""WITH {_GAPPY} SELECT symbol, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date,
    first_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS close
    FROM gappy""",
)
def _(spark, d):
    return W.bfill(_gappy(spark, d), "symbol", "date", ["close"])


@query(
    "exponential_average", "F8",
    sql=f"""WITH RECURSIVE {R.BARS_SQL},
    n AS (SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS i FROM bars),
    e AS (SELECT symbol, date, i, close AS y FROM n WHERE i = 1
      UNION ALL SELECT n.symbol, n.date, n.i, n.close * (2.0 / 13)::DOUBLE + e.y * (11.0 / 13)::DOUBLE
      FROM e JOIN n ON n.symbol = e.symbol AND n.i = e.i + 1)
    SELECT symbol, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date, round(y, 6) AS ema12 FROM e""",
)
def _(spark, d):
    out = W.ema(R.bars(spark, d), "symbol", "date", {"ema12": ("close", 12)}, size=300)
    return rounded(out.select("symbol", "date", "ema12"))


@query(
    "latest_row_per_key", "F9",
    sql="""SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, d):
    return latest_by_key(R.events(spark, d).select("user_id", "ts", "event_id", "event_type", "value"), "user_id", "ts").drop("ts")


@query(
    "max_normalised_score", "F10",
    sql="SELECT event_id, round(value / greatest(max(value) OVER (PARTITION BY event_type), 1.0), 6) AS norm_score FROM events",
)
def _(spark, d):
    return rounded(W.max_normalise(R.events(spark, d), "event_type", "value").select("event_id", "norm_score"))


@query(
    "last_n_rows", "F11",
    sql=f"""WITH {R.BARS_SQL} SELECT symbol, strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date, close FROM bars
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 30""",
)
def _(spark, d):
    return W.tail_n(R.bars(spark, d), "symbol", "date", 30).select("symbol", "date", "close")


SUMMARY_SQL = f"""WITH {R.DELTA_SQL}
SELECT trip_id, vehicle_id, driver_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS trip_start,
  strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS trip_end,
  epoch(date_trunc('second', max(event_time)))::BIGINT - epoch(date_trunc('second', min(event_time)))::BIGINT AS trip_duration_sec,
  count(*) AS event_count, round(sum(delta_m), 4) AS distance_m, round(sum(delta_m) / 1000.0, 4) AS distance_km,
  round(avg(speed_kmph), 6) AS avg_speed, min(speed_kmph) AS min_speed, max(speed_kmph) AS max_speed
FROM delta WHERE trip_id IS NOT NULL AND trip_id <> '' GROUP BY 1, 2, 3"""


@query("trip_summary", "E8", "C9", "I9", sql=SUMMARY_SQL)
def _(spark, d):
    moved = W.with_delta_m(R.telemetry(spark, d), tie=["event_id"])
    return rounded(A.trip_summary(moved.filter("trip_id IS NOT NULL AND trip_id <> ''")), 4, avg_speed=6)
