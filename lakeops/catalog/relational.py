"""Joins, aggregations, orders, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, rounded, table
from lakeops.operators import aggregate as A
from lakeops.operators import joins as J
from lakeops.operators import topk as K
from lakeops.operators.project import project
from lakeops.plans import roles
from lakeops.plans.dominance import DOMINANT_SERIES_SQL, dominant_series

R = roles


@query("dominant_team_series", "D1", "D3", "E1", "E4", "F2", "G1", sql=DOMINANT_SERIES_SQL)
def _(spark, d):
    return dominant_series(spark, d)


# ---- joins ----


@query(
    "star_join_points", "D1", "I26",
    sql=f"""WITH {R.POINTS_SQL}
    SELECT race_year, n_name AS team_name, o_custkey AS driver_id, c_name AS driver_name, l_orderkey AS race_id,
           position, l_extendedprice AS points, calculated_points FROM points""",
)
def _(spark, d):
    cols = {
        "race_year": "race_year", "n_name": "team_name", "o_custkey": "driver_id", "c_name": "driver_name",
        "l_orderkey": "race_id", "position": "position", "l_extendedprice": "points",
        "calculated_points": "calculated_points",
    }
    return project(R.race_points(spark, d), cols)


@query(
    "denormalised_results", "D9",
    sql=f"""WITH {R.RACE_SQL} SELECT race_year, n_name AS team, c_mktsegment AS driver_nationality,
    c_name AS driver_name, l_extendedprice AS points FROM race""",
)
def _(spark, d):
    cols = {
        "race_year": "race_year", "n_name": "team", "c_mktsegment": "driver_nationality", "c_name": "driver_name",
        "l_extendedprice": "points",
    }
    return project(R.race_rows(spark, d), cols)


@query(
    "left_enrich_claims", "D2",
    sql=f"""WITH {R.POLICIES_SQL}, {R.CLAIMS_SQL},
    urgent AS (SELECT policy_id, premium_amount FROM policies WHERE product = '1-URGENT')
    SELECT c.policy_id, c.claim_amount, c.loss_date::VARCHAR AS loss_date, p.premium_amount
    FROM claims c LEFT JOIN urgent p ON c.policy_id = p.policy_id""",
)
def _(spark, d):
    urgent = R.policies(spark, d).filter("product = '1-URGENT'").select("policy_id", "premium_amount")
    claims = R.claims(spark, d).select("policy_id", "claim_amount", "loss_date")
    return J.left_enrich(claims, urgent, "policy_id")


@query(
    "semi_join_large_orders", "D3", "G6",
    sql="""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
    (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def _(spark, d):
    big = table(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.keep_in(table(spark, d, "customer").select("c_custkey", "c_name"), big, "c_custkey")


@query(
    "not_in_null_aware", "D4", "H3",
    sql="SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def _(spark, d):
    done = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.keep_not_in(table(spark, d, "customer").select("c_custkey", "c_name"), done, "c_custkey")


@query(
    "anti_join_plain", "D4",
    sql="SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'P')",
)
def _(spark, d):
    done = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    return J.keep_not_in(customers, done, "c_custkey", null_aware=False)


PAIRS_SQL = """
WITH s AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'),
e AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'error'),
p AS (SELECT s.user_id, s.event_id AS start_event_id, e.event_id AS end_event_id, s.ts AS sts, e.ts AS ets
  FROM s JOIN e ON s.user_id = e.user_id AND e.ts > s.ts AND e.ts < s.ts + INTERVAL 6 HOUR)
"""


@query(
    "break_pairs_within", "D5",
    sql=PAIRS_SQL + """SELECT user_id, start_event_id, end_event_id,
    floor((epoch_us(ets) - epoch_us(sts)) / 1000000)::BIGINT AS break_seconds FROM p""",
)
def _(spark, d):
    ev = R.events(spark, d)
    pairs = J.pair_within(
        ev, "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "error", 6 * 3600, ["event_id"]
    )
    return pairs.select("user_id", "start_event_id", "end_event_id", "break_seconds")


@query(
    "break_pairs_nearest", "D5",
    sql=PAIRS_SQL + """SELECT user_id, start_event_id, arg_min(end_event_id, ets) AS end_event_id,
    min(floor((epoch_us(ets) - epoch_us(sts)) / 1000000)::BIGINT) AS break_seconds FROM p GROUP BY ALL""",
)
def _(spark, d):
    ev = R.events(spark, d)
    pairs = J.pair_within(
        ev, "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "error", 6 * 3600, ["event_id"],
        first_only=True,
    )
    return pairs.select("user_id", "start_event_id", "end_event_id", "break_seconds")


@query(
    "explode_array_join", "D7", "I23",
    sql="""SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents""",
)
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.split("text", "\n").alias("line"))
    return J.explode_join(docs, "line")


@query(
    "enrich_latest_order", "D8", "F9",
    sql="""WITH last AS (SELECT * FROM orders QUALIFY row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN last ON c_custkey = o_custkey""",
)
def _(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", "o_totalprice"
    )
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    return J.enrich_latest(customers, orders, "c_custkey", "o_orderdate").drop("o_orderdate")


@query(
    "holding_price_enrichment", "D10",
    sql="""WITH price AS (SELECT l_partkey, arg_max(l_extendedprice, (l_shipdate, l_extendedprice)) AS last_price
      FROM lineitem GROUP BY 1)
    SELECT p_partkey, p_name, p_retailprice AS average_price, last_price FROM part LEFT JOIN price ON p_partkey = l_partkey""",
)
def _(spark, d):
    prices = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), "l_shipdate", F.col("l_extendedprice").alias("last_price")
    )
    holdings = table(spark, d, "part").select("p_partkey", "p_name", F.col("p_retailprice").alias("average_price"))
    return J.enrich_latest(holdings, prices, "p_partkey", "l_shipdate").drop("l_shipdate")


@query(
    "holding_price_at_date", "D10", "D5",
    sql="""WITH bought AS (SELECT o_orderkey, l_linenumber, l_partkey, o_orderdate FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    SELECT o_orderkey, l_linenumber, (SELECT arg_max(s.l_extendedprice, s.l_shipdate) FROM
      (SELECT l_partkey, l_shipdate, min(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1, 2) s
      WHERE s.l_partkey = b.l_partkey AND s.l_shipdate <= b.o_orderdate) AS last_price FROM bought b""",
)
def _(spark, d):
    """The price of a part as of the day of each order line: the last one shipped on or before it."""
    lines = table(spark, d, "lineitem")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "l_linenumber", "l_partkey", F.col("o_orderdate").alias("day"))
    prices = lines.select("l_partkey", F.col("l_shipdate").alias("day"), F.col("l_extendedprice").alias("last_price"))
    month = F.date_trunc("month", "_t")
    return J.asof_join(bought, prices, "l_partkey", "day", ["last_price"], chunk=month, count=2 * lines.count()).select("o_orderkey", "l_linenumber", "last_price")


# ---- aggregations ----


@query(
    "group_totals", "E1",
    sql="""SELECT l_returnflag, l_linestatus, count(*) AS total_rows, round(sum(l_quantity), 2) AS sum_qty,
    round(sum(l_extendedprice), 2) AS sum_price, round(avg(l_discount), 6) AS avg_discount,
    min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price FROM lineitem GROUP BY 1, 2""",
)
def _(spark, d):
    out = A.keyed_totals(
        table(spark, d, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "total_rows": F.count(F.lit(1)), "sum_qty": F.sum("l_quantity"), "sum_price": F.sum("l_extendedprice"),
            "avg_discount": F.avg("l_discount"), "min_price": F.min("l_extendedprice"),
            "max_price": F.max("l_extendedprice"),
        },
    )
    return rounded(out, 2, avg_discount=6)


@query(
    "standings_with_wins", "E2",
    sql=f"""WITH {R.POINTS_SQL} SELECT race_year, n_name, sum(calculated_points)::BIGINT AS total_points,
    count(CASE WHEN position = 1 THEN 1 END) AS wins FROM points GROUP BY 1, 2""",
)
def _(spark, d):
    return A.standings(R.race_points(spark, d), ["race_year", "n_name"], "calculated_points", "position")


@query(
    "category_counters", "E3", "C18",
    sql="""SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS errors,
    sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS clicks,
    sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS views FROM events GROUP BY 1""",
)
def _(spark, d):
    names = {"error": "errors", "click": "clicks", "view": "views"}
    return A.category_counters(R.events(spark, d), "user_id", "event_type", names)


@query(
    "dominance_having", "E1", "E4",
    sql=f"""WITH {R.POINTS_SQL} SELECT n_name, count(*) AS total_races, sum(calculated_points)::BIGINT AS total_points,
    round(avg(calculated_points), 6) AS avg_points FROM points GROUP BY 1 HAVING count(*) >= 30""",
)
def _(spark, d):
    return rounded(A.dominance(R.race_points(spark, d), "n_name", "calculated_points", 30))


@query(
    "distinct_dimension", "E5",
    sql="SELECT DISTINCT p_brand, p_type, p_size FROM part",
)
def _(spark, d):
    return A.distinct_dim(table(spark, d, "part"), ["p_brand", "p_type", "p_size"])


@query(
    "filter_by_collected_keys", "E6",
    sql="""SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag IN
    (SELECT DISTINCT l_returnflag FROM lineitem WHERE l_linestatus = 'O') GROUP BY 1""",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    kept = A.with_keys_of(li, li.filter("l_linestatus = 'O'"), "l_returnflag")
    return A.keyed_totals(kept, ["l_returnflag"], {"n": F.count(F.lit(1))})


@query(
    "keep_first_duplicate", "E7", "H2",
    sql="""SELECT doc_id, source, lang, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def _(spark, d):
    return K.dedup_keep_first(table(spark, d, "documents"), "text", ["doc_id"]).drop("text")


@query(
    "era_dominance", "E9", "C8",
    sql=f"""WITH {R.POINTS_SQL} SELECT n_name, count(*) AS total_races, sum(calculated_points)::BIGINT AS total_points,
    round(avg(calculated_points), 6) AS avg_points FROM points WHERE race_year BETWEEN 1996 AND 1998
    GROUP BY 1 HAVING count(*) >= 5""",
)
def _(spark, d):
    era = A.dominance(R.race_points(spark, d), "n_name", "calculated_points", 5, years=(1996, 1998))
    return rounded(K.ordered_by(era, ["-avg_points"]))


@query(
    "top_customer_series", "E10", "D3",
    sql=f"""WITH {R.RACE_SQL},
    r AS (SELECT c_name, count(*) AS n, avg(l_extendedprice) AS a FROM race GROUP BY 1 HAVING count(*) >= 10),
    best AS (SELECT c_name FROM (SELECT c_name, rank() OVER (ORDER BY a DESC) AS k FROM r) WHERE k <= 10)
    SELECT race_year, c_name, count(*) AS total_races, round(sum(l_extendedprice), 2) AS total_points,
    round(avg(l_extendedprice), 6) AS avg_points FROM race WHERE c_name IN (SELECT c_name FROM best) GROUP BY 1, 2""",
)
def _(spark, d):
    out = A.top_entity_series(R.race_rows(spark, d), "c_name", "race_year", "l_extendedprice", 10, min_rows=10)
    return rounded(out, 2, avg_points=6)


@query(
    "average_in_date_range", "E11",
    sql="""SELECT round(avg(o_totalprice), 4) AS avg_o_totalprice FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'""",
)
def _(spark, d):
    from datetime import datetime

    lo, hi = datetime(1996, 1, 1), datetime(1997, 12, 31)
    orders = table(spark, d, "orders")
    lo, hi = (F.lit(x.isoformat(" ")).cast("timestamp_ntz") for x in (lo, hi))
    return rounded(orders.filter(F.col("o_orderdate").between(lo, hi)).agg(F.avg("o_totalprice").alias("avg_o_totalprice")), 4)


@query(
    "time_rollup_daily", "E14",
    sql="""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS bucket, event_type, count(*) AS n,
    round(sum(value), 4) AS total FROM events GROUP BY 1, 2""",
)
def _(spark, d):
    out = A.rollup_time(
        R.events(spark, d), "ts", "day", ["event_type"], {"n": F.count(F.lit(1)), "total": F.sum("value")}
    )
    return rounded(out, 4)


@query(
    "time_rollup_hourly", "E14",
    sql="""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS bucket, count(*) AS n,
    round(sum(value), 4) AS total FROM events GROUP BY 1""",
)
def _(spark, d):
    out = A.rollup_time(R.events(spark, d), "ts", "hour", [], {"n": F.count(F.lit(1)), "total": F.sum("value")})
    return rounded(out, 4)


@query(
    "filtered_group_by", "E15",
    sql="""SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
def _(spark, d):
    out = A.filtered_group(
        R.events(spark, d), F.col("event_type") == "purchase", ["user_id"],
        {"n": F.count(F.lit(1)), "total": F.sum("value")},
    )
    return rounded(out, 4)


_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
    round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max
    FROM orders"""
    for c in ("o_orderkey", "o_custkey", "o_totalprice")
)


@query("table_profile", "E16", sql=_PROFILE)
def _(spark, d):
    found = A.profile(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    return rounded(found.drop("least", "greatest"), 4)


_TEXT_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
    round(avg(try_cast({c}::VARCHAR AS DOUBLE)), 4) AS mean, min({c})::VARCHAR AS least, max({c})::VARCHAR AS greatest
    FROM orders"""
    for c in ("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
)


@query("table_profile_any_type", "E16", sql=_TEXT_PROFILE)
def _(spark, d):
    found = A.profile(table(spark, d, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])
    return rounded(found.drop("stddev", "min", "max"), 4)


# ---- orders, limits, sets ----


@query(
    "multi_key_order", "G1",
    sql="SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey",
)
def _(spark, d):
    cols = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    return K.ordered_by(table(spark, d, "orders"), ["o_orderpriority", "-o_totalprice", "o_orderkey"], cols)


@query(
    "order_desc_project", "G2",
    sql="""SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY 2 DESC""",
)
def _(spark, d):
    named = J.star_join(
        table(spark, d, "customer"), [(table(spark, d, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name"])]
    )
    counts = A.keyed_totals(named, ["n_name"], {"n": F.count(F.lit(1))})
    return K.ordered_by(counts, ["-n", "n_name"], ["n_name", "n"])


@query(
    "first_n_rows", "G3",
    sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000",
)
def _(spark, d):
    return K.top_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 1000)


@query(
    "top_k_per_group_then_overall", "G4",
    sql="""SELECT o_orderkey, o_orderpriority, o_totalprice FROM (SELECT * FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 8)
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def _(spark, d):
    order = ["-o_totalprice", "o_orderkey"]
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return K.top_n(K.top_n_per_group(rows, "o_orderpriority", order, 8), order, 10)


@query(
    "best_buy_date", "G5",
    sql=f"""WITH {R.BARS_SQL} SELECT symbol, strftime(min(date), '%Y-%m-%d %H:%M:%S.%f') AS min_at,
    any_value(close) AS min_value FROM bars b WHERE close = (SELECT min(close) FROM bars c WHERE c.symbol = b.symbol)
    GROUP BY 1""",
)
def _(spark, d):
    return K.arg_extreme(R.bars(spark, d), "symbol", "close", "date", "min")


@query(
    "best_sell_date", "G5",
    sql=f"""WITH {R.BARS_SQL} SELECT symbol, strftime(min(date), '%Y-%m-%d %H:%M:%S.%f') AS max_at,
    any_value(close) AS max_value FROM bars b WHERE close = (SELECT max(close) FROM bars c WHERE c.symbol = b.symbol)
    GROUP BY 1""",
)
def _(spark, d):
    return K.arg_extreme(R.bars(spark, d), "symbol", "close", "date", "max")


@query(
    "top_rank_filter", "G6", "F2",
    sql="""WITH a AS (SELECT o_custkey, avg(o_totalprice) AS a, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 5)
    SELECT o_custkey, n, round(a, 6) AS avg_price, k AS rank FROM
    (SELECT *, rank() OVER (ORDER BY a DESC) AS k FROM a) WHERE k <= 10""",
)
def _(spark, d):
    sums = A.keyed_totals(
        table(spark, d, "orders"), ["o_custkey"], {"avg_price": F.avg("o_totalprice"), "n": F.count(F.lit(1))}
    ).filter("n >= 5")
    return rounded(K.top_ranked(sums, ["-avg_price"], 10))


@query(
    "tagged_union", "H1",
    sql="""SELECT c_custkey AS party, c_name AS name, 'customer' AS source FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""",
)
def _(spark, d):
    return K.union_tagged(
        {
            "customer": project(table(spark, d, "customer"), {"c_custkey": "party", "c_name": "name"}),
            "supplier": project(table(spark, d, "supplier"), {"s_suppkey": "party", "s_name": "name"}),
        }
    )


@query(
    "union_first_occurrence", "H2",
    sql="""WITH u AS (SELECT text, 0 AS pos, doc_id AS id FROM documents UNION ALL SELECT text, 1, item_id FROM benchmark)
    SELECT pos, id FROM u WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY text ORDER BY pos, id) = 1""",
)
def _(spark, d):
    docs = table(spark, d, "documents").select("text", F.lit(0).alias("pos"), F.col("doc_id").alias("id"))
    bench = table(spark, d, "benchmark").select("text", F.lit(1).alias("pos"), F.col("item_id").alias("id"))
    return K.dedup_keep_first(docs.unionByName(bench), "text", ["pos", "id"], drop_null=True).drop("text")


@query(
    "parsed_columns_side_by_side", "H4", "I22",
    sql="SELECT event_id, event_type, (props->>'$.k')::BIGINT AS k FROM events",
)
def _(spark, d):
    ev = R.events(spark, d).select("event_id", "event_type", F.from_json("props", "k BIGINT").alias("meta"))
    return ev.select("event_id", "event_type", "meta.*")
