"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, table
from lakeops.functions import cases, times
from lakeops.operators import project as P
from lakeops.plans import roles as R


@query("select_with_alias", "C1", sql="SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer")
def _(spark, d):
    return P.project(table(spark, d, "customer"), {"c_custkey": "customer_id", "c_name": "customer_name"})


@query("rename_by_map", "C2", sql="SELECT s_suppkey AS supplier_id, s_name AS name, s_nationkey, s_acctbal AS balance FROM supplier")
def _(spark, d):
    return P.rename_columns(
        table(spark, d, "supplier"), {"s_suppkey": "supplier_id", "s_name": "name", "s_acctbal": "balance"}
    )


@query("drop_columns", "C3", sql="SELECT p_partkey, p_name, p_brand, p_type FROM part")
def _(spark, d):
    return P.drop_columns(table(spark, d, "part"), "p_size", "p_retailprice")


@query(
    "audit_columns", "C4", "I11",
    sql="""SELECT n_nationkey, n_name, 'master' AS data_source, '2024-03-21' AS file_date, 'test' AS env,
    '2024-03-22 10:00:00.000000' AS ingestion_date FROM nation""",
)
def _(spark, d):
    now = F.lit("2024-03-22 10:00:00").cast("timestamp_ntz")
    return P.add_audit(table(spark, d, "nation").select("n_nationkey", "n_name"), "master", "2024-03-21", "test", now)


@query("struct_expand", "C5", sql="SELECT event_id, user_id, event_type, value FROM events")
def _(spark, d):
    nested = R.events(spark, d).select("event_id", F.struct("user_id", "event_type", "value").alias("data"))
    return P.expand_struct(nested, "data")


@query("column_reorder", "C6", sql="SELECT o_orderstatus, o_custkey, o_totalprice, o_orderkey FROM orders")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return P.reorder(rows, first=["o_orderstatus"], last=["o_orderkey"])


@query("comparison_filters", "C7", sql="SELECT event_id, value FROM events WHERE value > 20 AND event_type = 'click'")
def _(spark, d):
    out = P.where_cmp(P.where_cmp(R.events(spark, d), "value", ">", 20.0), "event_type", "=", "click")
    return out.select("event_id", "value")


@query("inclusive_range_filter", "C8", sql="SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def _(spark, d):
    return P.where_between(table(spark, d, "part"), "p_size", 10, 20).select("p_partkey", "p_size")


@query(
    "present_value_filter", "C9",
    sql=f"WITH {R.TELEMETRY_SQL} SELECT event_id, trip_id FROM tele WHERE trip_id IS NOT NULL AND trip_id <> ''",
)
def _(spark, d):
    return P.where_present(R.telemetry(spark, d), "trip_id").select("event_id", "trip_id")


@query("length_guard", "C10", sql="SELECT event_id, props FROM events WHERE props IS NOT NULL AND length(props) > 8")
def _(spark, d):
    return P.where_min_length(R.events(spark, d), "props", 8).select("event_id", "props")


@query(
    "optional_equality_filter", "C11",
    sql="SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'",
)
def _(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return P.where_optional(P.where_optional(rows, "c_mktsegment", "MACHINERY"), "c_custkey", None)


@query("resolve_short_name", "C12", "I4", sql="SELECT s_suppkey, s_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name = 'NATION_24'")
def _(spark, d):
    nation = table(spark, d, "nation")
    lookup = nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("short"), F.col("n_name").alias("full"))
    named = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return P.resolve_name(named.select("s_suppkey", "s_nationkey", "n_name"), "n_name", " N24 ", lookup)


@query("resolve_by_contained_text", "C12", "I4", sql="SELECT p_partkey, p_name FROM part WHERE upper(p_name) LIKE '%RING%'")
def _(spark, d):
    lookup = table(spark, d, "region").select(F.substring("r_name", 1, 2).alias("short"), F.col("r_name").alias("full"))
    return P.resolve_name(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "Ring", lookup)


@query("substring_filter", "C13", sql="SELECT doc_id, n_chars FROM documents WHERE contains(text, ' the ')")
def _(spark, d):
    return P.where_contains(table(spark, d, "documents"), "text", " the ").select("doc_id", "n_chars")


@query(
    "case_buckets", "C14", "I25",
    sql="""SELECT event_id, CASE WHEN event_type = 'view' THEN 'unknown' WHEN value < 5 THEN 'quick' WHEN value < 15 THEN 'normal'
    ELSE 'long' END AS stay FROM events""",
)
def _(spark, d):
    seen = F.when(F.col("event_type") != "view", F.col("value"))
    stay = cases.bucketize(seen, [5, 15], ["quick", "normal", "long"], "unknown")
    return R.events(spark, d).select("event_id", stay.alias("stay"))


@query(
    "validity_status", "C15",
    sql=f"""WITH {R.POLICIES_SQL} SELECT policy_id, CASE WHEN DATE '1998-06-30' BETWEEN policy_start_date AND policy_end_date
    THEN 'ACTIVE' ELSE 'EXPIRED' END AS status FROM policies""",
)
def _(spark, d):
    as_of = F.lit("1998-06-30").cast("date")
    status = cases.validity_status(F.col("policy_start_date"), F.col("policy_end_date"), as_of)
    return R.policies(spark, d).select("policy_id", status.alias("status"))


@query("threshold_flag", "C16", "N1", sql="SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'high-value' ELSE 'regular' END AS kind FROM orders")
def _(spark, d):
    kind = cases.flag_above(F.col("o_totalprice"), 250000, "high-value", "regular")
    return table(spark, d, "orders").select("o_orderkey", kind.alias("kind"))


@query(
    "required_fields_filter", "C17",
    sql="""SELECT doc_id, quality, toxic, lang FROM documents JOIN labels USING (doc_id)
    WHERE quality IS NOT NULL AND toxic IS NOT NULL AND lang IS NOT NULL""",
)
def _(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return P.where_complete(joined, ["quality", "toxic", "lang"]).select("doc_id", "quality", "toxic", "lang")


@query("indicator_column", "C18", sql="SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", cases.indicator(F.col("o_orderstatus") == "F").alias("done"))


@query(
    "flatten_api_record", "C19", "I1",
    sql="""SELECT c_custkey AS id, c_name AS first_name, c_mktsegment || ', ' || n_name || ', ' || r_name AS address
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, d):
    place = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    nested = rows.select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("first")).alias("name"),
        F.struct(F.col("c_mktsegment").alias("city"), F.col("n_name").alias("state"), F.col("r_name").alias("country")).alias("location"),
    )
    address = F.concat_ws(", ", "location.city", "location.state", "location.country")
    return P.flatten_record(nested, {"id": "id", "first_name": "name.first", "address": address})


@query(
    "surrogate_key", "C20",
    sql="SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id, o_orderkey FROM orders",
)
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return P.with_surrogate_key(rows, ["o_totalprice", "o_orderkey"]).drop("o_totalprice")


@query(
    "typed_date_and_time", "I6", "I13",
    sql="""SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS race_timestamp FROM events""",
)
def _(spark, d):
    ev = R.events(spark, d).select(
        "event_id", F.to_date("ts").alias("date"), F.date_format("ts", "HH:mm:ss").alias("time")
    )
    made = times.without_zone(times.from_date_and_time(F.col("date"), F.col("time")))
    return ev.select("event_id", made.alias("race_timestamp"))
