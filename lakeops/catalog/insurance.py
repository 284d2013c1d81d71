"""Billing, claims and coverage measures, ad-hoc order metrics, state rollups, layer checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, rounded, table
from lakeops.operators import insurance as I
from lakeops.operators.aggregate import rollup_time
from lakeops.plans import roles as R


@query(
    "billed_vs_collected", "O3",
    sql="""SELECT o_custkey, round(sum(o_totalprice), 2) AS billed, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS collected,
    round(sum(o_totalprice) - sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS gap FROM orders GROUP BY 1""",
)
def _(spark, d):
    return rounded(I.billed_vs_collected(table(spark, d, "orders"), "o_custkey", "o_totalprice", "o_orderstatus", "F"), 2)


@query(
    "claims_ageing", "O4",
    sql=f"""WITH {R.CLAIMS_SQL}, a AS (SELECT *, date_diff('day', loss_date, DATE '2001-10-01') AS age_days FROM claims)
    SELECT policy_id, claim_amount, age_days, CASE WHEN age_days <= 30 THEN '0-30' WHEN age_days <= 60 THEN '31-60'
    WHEN age_days <= 90 THEN '61-90' ELSE '90+' END AS age_bucket, CASE WHEN age_days > 90 THEN 1 ELSE 0 END AS sla_breached FROM a""",
)
def _(spark, d):
    out = I.claims_ageing(R.claims(spark, d), "loss_date", F.lit("2001-10-01").cast("date"))
    return out.drop("loss_date", "claim_status")


@query(
    "loss_ratio", "O5",
    sql=f"""WITH {R.POLICIES_SQL}, {R.CLAIMS_SQL},
    c AS (SELECT product, strftime(loss_date, '%Y-%m') AS month, sum(claim_amount) AS claims FROM claims JOIN policies USING (policy_id) GROUP BY 1, 2),
    p AS (SELECT product, strftime(policy_start_date, '%Y-%m') AS month, sum(premium_amount) AS premium FROM policies GROUP BY 1, 2)
    SELECT product, month, round(premium, 2) AS premium, round(coalesce(claims, 0), 2) AS claims, round(coalesce(claims, 0) / premium, 6) AS loss_ratio
    FROM p LEFT JOIN c USING (product, month)""",
)
def _(spark, d):
    policies = R.policies(spark, d).withColumn("month", F.date_format("policy_start_date", "yyyy-MM"))
    claims = R.claims(spark, d).join(policies.select("policy_id", "product"), "policy_id").withColumn(
        "month", F.date_format("loss_date", "yyyy-MM")
    )
    return rounded(I.loss_ratio(claims, policies, ["product", "month"]), 2, loss_ratio=6)


@query(
    "distinct_user_sketch", "O6",
    sql="SELECT event_type, count(DISTINCT user_id) AS users, 1 AS within_five_percent FROM events GROUP BY 1",
)
def _(spark, d):
    """Daily sketches merged to one estimate per event type, next to the exact count."""
    ev = R.events(spark, d).withColumn("day", F.to_date("ts"))
    merged = I.merge_sketches(I.distinct_sketch(ev, ["event_type", "day"], "user_id"), ["event_type"])
    exact = ev.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    close = F.abs(F.col("distinct_estimate") - F.col("users")) <= 0.05 * F.col("users")
    return exact.join(merged, "event_type").select("event_type", "users", close.cast("int").alias("within_five_percent"))


@query(
    "sign_collapsing_rollup", "O6",
    sql="""SELECT user_id, sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END)::BIGINT AS net_rows,
    round(sum(CASE WHEN event_type = 'error' THEN -value ELSE value END), 4) AS total FROM events GROUP BY 1
    HAVING sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END) > 0""",
)
def _(spark, d):
    signed = R.events(spark, d).withColumn("sign", F.when(F.col("event_type") == "error", -1).otherwise(1))
    return rounded(I.collapse_signs(signed, ["user_id"], "sign", {"total": "value"}), 4)


@query(
    "version_collapsing", "O6",
    sql="""SELECT user_id, max(day)::VARCHAR AS day FROM (SELECT user_id, ts::DATE AS day FROM events GROUP BY 1, 2
    HAVING sum(CASE WHEN event_type IN ('error', 'view') THEN -1 ELSE 1 END) > 0) GROUP BY 1""",
)
def _(spark, d):
    sign = F.when(F.col("event_type").isin("error", "view"), -1).otherwise(1)
    rows = R.events(spark, d).select("user_id", F.to_date("ts").alias("day"), sign.alias("sign"))
    return I.collapse_versions(rows, ["user_id"], "day", "sign")


@query(
    "revenue_by_month", "O7", "E14",
    sql="""SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS bucket, o_orderpriority,
    round(sum(o_totalprice), 2) AS revenue, count(*) AS orders FROM orders GROUP BY 1, 2""",
)
def _(spark, d):
    measures = {"revenue": F.sum("o_totalprice"), "orders": F.count(F.lit(1))}
    return rounded(rollup_time(table(spark, d, "orders"), "o_orderdate", "month", ["o_orderpriority"], measures), 2)


@query(
    "revenue_by_product", "O7",
    sql="""SELECT p_brand, p_type, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2""",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    # sums per part first, so a part with many items is folded before the join
    per_part = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r")
    )
    return rounded(per_part.join(parts, "p_partkey").groupBy("p_brand", "p_type").agg(F.sum("r").alias("revenue")), 4)


@query(
    "orders_of_trailing_week", "O7",
    sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate::DATE > DATE '1998-07-24' AND o_orderdate::DATE <= DATE '1998-07-31'",
)
def _(spark, d):
    out = I.trailing_days(table(spark, d, "orders"), "o_orderdate", F.lit("1998-07-31").cast("date"))
    return out.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "coverage_islands", "O8",
    sql=f"""WITH {R.POLICIES_SQL},
    t AS (SELECT *, max(policy_end_date) OVER (PARTITION BY holder ORDER BY policy_start_date, policy_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS through FROM policies),
    m AS (SELECT *, CASE WHEN through IS NULL OR policy_start_date > through + 1 THEN 1 ELSE 0 END AS opens,
      CASE WHEN through IS NOT NULL AND policy_start_date <= through THEN 1 ELSE 0 END AS over FROM t),
    n AS (SELECT *, sum(opens) OVER (PARTITION BY holder ORDER BY policy_start_date, policy_id ROWS UNBOUNDED PRECEDING) AS island FROM m),
    i AS (SELECT holder, island, min(policy_start_date) AS s, max(policy_end_date) AS e, count(*) AS policies, sum(over)::BIGINT AS n_over FROM n GROUP BY 1, 2)
    SELECT holder, s::DATE::VARCHAR AS cover_start, e::DATE::VARCHAR AS cover_end, policies, n_over AS "overlaps",
    coalesce(date_diff('day', lag(e) OVER (PARTITION BY holder ORDER BY s), s) - 1, 0) AS gap_days FROM i""",
)
def _(spark, d):
    return I.coverage_timeline(R.policies(spark, d), "holder", "policy_start_date", "policy_end_date", "policy_id")


@query(
    "daily_active_policies", "O9",
    sql=f"""WITH {R.POLICIES_SQL},
    spine AS (SELECT unnest(generate_series((SELECT min(policy_start_date) FROM policies), (SELECT max(policy_end_date) FROM policies), INTERVAL 1 DAY))::DATE AS day)
    SELECT day::VARCHAR AS day, count(policy_id) AS active FROM spine LEFT JOIN policies
    ON day BETWEEN policy_start_date AND policy_end_date GROUP BY 1""",
)
def _(spark, d):
    return I.active_snapshot(R.policies(spark, d), "policy_start_date", "policy_end_date")


@query(
    "collection_lag", "O9",
    sql="""SELECT l_orderkey, l_linenumber, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS lag_days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return I.collection_lag(rows, "o_orderdate", "l_shipdate").select("l_orderkey", "l_linenumber", "lag_days")


@query(
    "freshness_monitor", "O10",
    sql="""SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest,
    floor((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 1000000)::BIGINT AS age_seconds FROM events""",
)
def _(spark, d):
    return I.freshness(R.events(spark, d), "ts", F.lit("2024-02-01").cast("timestamp_ntz"))


@query(
    "volume_monitor", "O10",
    sql="""WITH c AS (SELECT ts::DATE AS day, count(*) AS row_count FROM events GROUP BY 1),
    m AS (SELECT *, avg(row_count) OVER (ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS trailing_mean FROM c)
    SELECT day::VARCHAR AS day, row_count, round(trailing_mean, 6) AS trailing_mean, CASE WHEN row_count < trailing_mean * 0.98 THEN 1 ELSE 0 END AS low_volume FROM m""",
)
def _(spark, d):
    return rounded(I.volume_check(R.events(spark, d), "ts", 7, 0.98))


@query(
    "layer_reconciliation", "O10",
    sql="""WITH l AS (SELECT o_custkey, count(*) AS left_rows, sum(o_totalprice) AS ls FROM orders GROUP BY 1),
    r AS (SELECT o_custkey, count(*) AS right_rows, sum(o_totalprice) AS rs FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
    SELECT o_custkey, left_rows, round(ls, 2) AS left_sum, right_rows, round(rs, 2) AS right_sum FROM l FULL JOIN r USING (o_custkey)
    WHERE left_rows IS DISTINCT FROM right_rows OR abs(coalesce(ls, 0) - coalesce(rs, 0)) > greatest(abs(coalesce(ls, 0)), abs(coalesce(rs, 0)), 1) * 1e-9""",
)
def _(spark, d):
    orders = table(spark, d, "orders")
    return rounded(I.reconcile(orders, orders.filter("o_orderstatus <> 'P'"), "o_custkey", "o_totalprice"), 2)
