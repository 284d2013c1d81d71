"""Billing, claims and coverage measures, and layer checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.cases import indicator
from lakeops.operators.joins import range_to_points
from lakeops.operators.ordered import names, running, with_previous
from lakeops.session import materialise


def billed_vs_collected(
    invoices: DataFrame, policy: str, amount: str, status: str, paid: str = "PAID"
) -> DataFrame:
    """Invoiced, paid and open amount per policy."""
    got = F.sum(F.when(F.col(status) == paid, F.col(amount)).otherwise(F.lit(0.0)))
    return invoices.groupBy(policy).agg(
        F.sum(amount).alias("billed"), got.alias("collected"), (F.sum(amount) - got).alias("gap")
    )


def ageing_bucket(days: Column) -> Column:
    return F.when(days <= 30, "0-30").when(days <= 60, "31-60").when(days <= 90, "61-90").otherwise("90+")


def claims_ageing(claims: DataFrame, opened: str, as_of: Column, sla_days: int = 90) -> DataFrame:
    """Age in days, age bucket and whether the limit is exceeded."""
    days = F.datediff(as_of, F.col(opened))
    return claims.withColumns(
        {"age_days": days, "age_bucket": ageing_bucket(days), "sla_breached": indicator(days > sla_days)}
    )


def loss_ratio(
    claims: DataFrame, premiums: DataFrame, by: Sequence[str], claim: str = "claim_amount", premium: str = "premium_amount"
) -> DataFrame:
    """Claims over premium per group; both sides are summed before they meet."""
    c = claims.groupBy(*by).agg(F.sum(claim).alias("claims"))
    p = premiums.groupBy(*by).agg(F.sum(premium).alias("premium"))
    joined = p.join(c, list(by), "left").fillna(0.0, ["claims"])
    return joined.withColumn("loss_ratio", F.try_divide(F.col("claims"), F.col("premium")))


def coverage_timeline(
    policies: DataFrame, holder: str, start: str, end: str, tie: str, chunk=None
) -> DataFrame:
    """Islands of continuous cover per holder, with overlap count and the gap before each.

    A policy opens a new island when it starts after the latest end so far plus
    one day.
    """
    order = [start, tie]
    cut = F.date_trunc("month", F.col(start)) if chunk is None else chunk
    ends = running(policies, holder, order, {"_through": F.col(end)}, "max", cut, inclusive=False)
    opens = F.col("_through").isNull() | (F.col(start) > F.date_add("_through", 1))
    overlaps = F.col("_through").isNotNull() & (F.col(start) <= F.col("_through"))
    marked = ends.withColumns({"_open": indicator(opens), "_over": indicator(overlaps)})
    # the next step reads this twice
    marked = materialise(marked.select(holder, start, end, tie, "_open", "_over"), "cover")
    numbered = running(marked, holder, order, {"_island": F.col("_open")}, "sum", cut)
    islands = numbered.groupBy(holder, "_island").agg(
        F.min(start).alias("cover_start"),
        F.max(end).alias("cover_end"),
        F.count(F.lit(1)).alias("policies"),
        F.sum("_over").alias("overlaps"),
    )
    islands = materialise(islands, "islands")
    year = F.date_trunc("year", F.col("cover_start"))
    prev = with_previous(islands, holder, ["cover_start"], ["cover_end"], year)
    gap = F.datediff("cover_start", "prev_cover_end") - 1
    return prev.withColumn("gap_days", F.coalesce(gap, F.lit(0))).drop("prev_cover_end", "_island")


def active_snapshot(policies: DataFrame, start: str, end: str, dims: Sequence[str] = ()) -> DataFrame:
    """Number of active policies per day.

    Each policy adds one at its start and takes one off after its end; a running
    sum over the daily changes gives the count without listing every day of
    every policy.  Days come from the first start to the last end.
    """
    dims = names(list(dims))
    plus = policies.groupBy(*dims, F.col(start).alias("day")).agg(F.count(F.lit(1)).alias("_c"))
    minus = policies.groupBy(*dims, F.date_add(end, 1).alias("day")).agg((-F.count(F.lit(1))).alias("_c"))
    spans = policies.groupBy(*dims).agg(F.min(start).alias("_lo"), F.max(end).alias("_hi"))
    days = range_to_points(spans, "_lo", "_hi", "day").select(*dims, "day", F.lit(0).cast("bigint").alias("_c"))
    changes = plus.unionByName(minus).unionByName(days)
    daily = changes.groupBy(*dims, "day").agg(F.sum("_c").alias("_c"), F.max(F.col("_c") == 0).alias("_listed"))
    out = running(daily, dims, ["day"], {"active": F.col("_c")}, "sum", F.date_trunc("year", F.col("day")))
    last = policies.agg(F.max(end)).scalar()
    return out.filter(F.col("day") <= last).select(*dims, "day", "active")


def collection_lag(df: DataFrame, billed: str, paid: str, out: str = "lag_days") -> DataFrame:
    """Days from invoice to payment."""
    return df.withColumn(out, F.datediff(paid, billed))


def freshness(df: DataFrame, ts: str, as_of: Column) -> DataFrame:
    """Newest event and its age in seconds."""
    return df.agg(F.max(ts).alias("newest"), F.timestamp_diff("SECOND", F.max(ts), as_of).alias("age_seconds"))


def volume_check(df: DataFrame, ts: str, trailing: int = 7, low: float = 0.5) -> DataFrame:
    """Rows per day against the mean of the days with rows among the ``trailing`` calendar days before.

    Each day's count is handed to the days after it, so no task orders all days.
    """
    daily = df.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("row_count"))
    later = F.explode(F.sequence(F.lit(1), F.lit(trailing))).alias("_k")
    handed = daily.select("day", "row_count", later).select(F.date_add("day", F.col("_k")).alias("day"), "row_count")
    means = handed.groupBy("day").agg(F.avg("row_count").alias("trailing_mean"))
    out = daily.join(means, "day", "left")
    return out.withColumn("low_volume", indicator(F.col("row_count") < F.col("trailing_mean") * low))


def reconcile(left: DataFrame, right: DataFrame, key: str, amount: str, tolerance: float = 1e-9) -> DataFrame:
    """Keys whose row count differs between two layers, or whose sums do by more than their share ``tolerance``.

    Sums of doubles depend on their order; the share allows for that on large keys too.
    """
    l = left.groupBy(key).agg(F.count(F.lit(1)).alias("left_rows"), F.sum(amount).alias("left_sum"))
    r = right.groupBy(key).agg(F.count(F.lit(1)).alias("right_rows"), F.sum(amount).alias("right_sum"))
    both = l.join(r, key, "full_outer")
    a, b = F.coalesce("left_sum", F.lit(0.0)), F.coalesce("right_sum", F.lit(0.0))
    same = F.col("left_rows").eqNullSafe(F.col("right_rows")) & (
        F.abs(a - b) <= F.greatest(F.abs(a), F.abs(b), F.lit(1.0)) * tolerance
    )
    return both.filter(~same)


def distinct_sketch(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Mergeable distinct-count state per key."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col).alias("sketch"))


def merge_sketches(df: DataFrame, keys: Sequence[str], out: str = "distinct_estimate") -> DataFrame:
    merged = df.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("_s"))
    return merged.select(*keys, F.hll_sketch_estimate("_s").alias(out))


def collapse_signs(df: DataFrame, keys: Sequence[str], sign: str, sums: dict[str, str]) -> DataFrame:
    """Net rows per key: each row counts with its sign, keys with no net row go."""
    out = df.groupBy(*keys).agg(
        F.sum(sign).alias("net_rows"), *[F.sum(F.col(sign) * F.col(c)).alias(n) for n, c in sums.items()]
    )
    return out.filter(F.col("net_rows") > 0)


def collapse_versions(df: DataFrame, keys: Sequence[str], version: str, sign: str) -> DataFrame:
    """Latest version per key that still has a net row."""
    live = df.groupBy(*keys, version).agg(F.sum(sign).alias("net_rows")).filter(F.col("net_rows") > 0)
    return live.groupBy(*keys).agg(F.max(version).alias(version))


def trailing_days(df: DataFrame, date: str, as_of: Column, days: int = 7) -> DataFrame:
    """Rows of the ``days`` days before ``as_of``."""
    d = F.to_date(F.col(date))
    return df.filter((d > F.date_sub(as_of, days)) & (d <= as_of))
