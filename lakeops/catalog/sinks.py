"""Sinks and table maintenance: every query writes, maintains and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, rounded, scratch_db, table
from lakeops.catalog.scans import EVENTS_DDL, EVENTS_SQL, NTZ, ORDERS_DDL, ORDERS_SQL, event_lines
from lakeops.plans import roles as R
from lakeops.session import new_dir
from lakeops.sinks import streams as Z
from lakeops.sinks import tables as T
from lakeops.sources.files import read_csv, read_json, read_parquet
from lakeops.sources.streams import stream_json


@query("overwrite_parquet_path", "B1", sql="SELECT * FROM part")
def _(spark, d):
    path = new_dir(spark, "part")
    T.write_table(table(spark, d, "part").filter("p_size > 25"), path)
    T.write_table(table(spark, d, "part"), path)
    return read_parquet(spark, path)


@query("overwrite_managed_table", "B2", sql="SELECT * FROM supplier")
def _(spark, d):
    name = f"{scratch_db(spark)}.supplier"
    T.write_table(table(spark, d, "supplier"), name)
    T.write_table(table(spark, d, "supplier"), name)
    return spark.table(name)


@query(
    "partitioned_write", "B3",
    sql="SELECT event_id, user_id, event_type, value FROM events",
)
def _(spark, d):
    path = new_dir(spark, "events")
    T.write_table(R.events(spark, d).select("event_id", "user_id", "event_type", "value"), path, partition_by="event_type")
    return read_parquet(spark, path).select("event_id", "user_id", "event_type", "value")


_RELOAD_SQL = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
o_orderstatus FROM orders"""


def _reload(spark, d, load):
    """First load everything, then twice the corrected rows of one partition."""
    name = f"{scratch_db(spark)}.orders"
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    load(rows, name)
    fixed = rows.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    load(fixed, name)
    load(fixed, name)
    return spark.table(name)


@query("partition_replace_by_drop", "B4", "E6", sql=_RELOAD_SQL)
def _(spark, d):
    return _reload(spark, d, lambda df, name: T.replace_partitions_by_drop(df, name, "o_orderstatus"))


@query("partition_replace_dynamic", "B5", sql=_RELOAD_SQL)
def _(spark, d):
    return _reload(spark, d, lambda df, name: T.overwrite_partition(df, name, "o_orderstatus"))


@query("single_csv_export", "B6", sql="SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(spark, d):
    path = new_dir(spark, "report")
    counts = (
        table(spark, d, "customer")
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    T.export_single_csv(counts, path, ["n_name"])
    return read_csv(spark, path, "n_name STRING, customers BIGINT")


@query(
    "append_with_new_columns", "B7",
    sql="""SELECT event_id, value, CASE WHEN event_type = 'click' THEN user_id END AS user_id FROM events""",
)
def _(spark, d):
    path = new_dir(spark, "evolving")
    ev = R.events(spark, d)
    T.append_evolving(ev.filter("event_type <> 'click'").select("event_id", "value"), path)
    T.append_evolving(ev.filter("event_type = 'click'").select("event_id", "value", "user_id"), path)
    return T.read_evolving(spark, path).select("event_id", "value", "user_id")


@query(
    "union_with_missing_columns", "B7",
    sql="""SELECT c_custkey AS id, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return T.align_columns([c, s])


@query(
    "json_message_sink", "B8", "I19",
    sql="""SELECT '{"event_id":' || event_id::VARCHAR || '}' AS key,
    '{"event_id":' || event_id::VARCHAR || ',"event_type":"' || event_type || '","user_id":' || user_id::VARCHAR || '}' AS value
    FROM events""",
)
def _(spark, d):
    out, mark = new_dir(spark, "topic"), new_dir(spark, "mark")
    stream = R.event_stream(spark, d).select("event_id", "event_type", "user_id")
    Z.stream_to_table(Z.to_messages(stream, ["event_id"]), out, mark)
    return read_parquet(spark, out)


_LATEST_SQL = """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""


@query("keyed_upsert_batches", "B9", "F9", sql=_LATEST_SQL)
def _(spark, d):
    name = f"{scratch_db(spark)}.latest"
    ev = R.events(spark, d).select("user_id", "event_id", "event_type", "value")
    for kind in ("error", "view", "signup", "click", "purchase", "error"):
        T.upsert_batch(ev.filter(F.col("event_type") == kind), name, "user_id", "event_id", buckets=8)
    return T.read_upserted(spark, name)


@query("keyed_row_sink_stream", "B10", "B9", sql=_LATEST_SQL)
def _(spark, d):
    name, mark = f"{scratch_db(spark)}.latest", new_dir(spark, "mark")
    stream = R.event_stream(spark, d).select("user_id", "event_id", "event_type", "value")
    Z.row_sink(stream, name, mark, "user_id", "event_id", buckets=8)
    return T.read_upserted(spark, name)


@query(
    "dated_chunked_parquet", "B11", "I10",
    sql="""SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, value FROM events""",
)
def _(spark, d):
    path = new_dir(spark, "landing")
    T.write_chunked(R.events(spark, d).select("event_id", "ts", "value"), path, "ts")
    return read_parquet(spark, path).drop("ts")


@query("chunk_size_bound", "B11", sql="SELECT 1 AS within_bound, count(*) AS total FROM events")
def _(spark, d):
    """No written file holds more than the wanted number of rows, and none is missing."""
    path = new_dir(spark, "landing")
    T.write_chunked(R.events(spark, d).select("event_id", "ts", "value"), path, "ts", max_rows=100)
    per_file = read_parquet(spark, path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg((F.max("n") <= 100).cast("int").alias("within_bound"), F.sum("n").alias("total"))


@query("checkpointed_stream_append", "B12", sql=EVENTS_SQL)
def _(spark, d):
    name, mark = f"{scratch_db(spark)}.events", new_dir(spark, "mark")
    for _ in range(2):  # the second run finds nothing new
        Z.stream_to_table(R.event_stream(spark, d), name, mark)
    return spark.table(name)


@query(
    "rebuild_derived_table", "B13",
    sql="SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def _(spark, d):
    name = f"{scratch_db(spark)}.derived"
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    T.rebuild_table(spark, name, rows)
    changed = spark.table(name).filter("o_orderstatus = 'F'").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return T.rebuild_table(spark, name, changed)


@query("temp_view", "B14", sql="SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(spark, d):
    view = new_dir(spark, "view").rsplit("/", 1)[1].replace("-", "_")
    T.register_view(table(spark, d, "customer"), view)
    return spark.sql(f"SELECT c_mktsegment, count(*) AS n FROM {view} GROUP BY 1")


@query(
    "keyed_daily_json_rerun", "B15", "I8",
    sql="""SELECT event_type, strftime(ts, '%Y%m%d') AS day, count(*) AS n,
    max(CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN value + 1000 ELSE value END) AS best FROM events GROUP BY 1, 2""",
)
def _(spark, d):
    path = new_dir(spark, "keyed")

    def daily(ev):
        return ev.groupBy("event_type", F.date_format("ts", "yyyyMMdd").alias("day")).agg(
            F.count(F.lit(1)).alias("n"), F.max("value").alias("best")
        )

    ev = R.events(spark, d)
    T.write_keyed_json(daily(ev), path, "event_type", "day")
    late = ev.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")).withColumn("value", F.col("value") + 1000)
    T.write_keyed_json(daily(late), path, "event_type", "day")
    return read_json(spark, path, "n BIGINT, best DOUBLE, event_type STRING, day STRING")


@query("csv_landing_load", "B16", "A1", sql=ORDERS_SQL)
def _(spark, d):
    path, name = new_dir(spark, "landing"), f"{scratch_db(spark)}.orders"
    table(spark, d, "orders").write.option("header", True).csv(path)
    T.load_csv_to_table(spark, path, name, ORDERS_DDL)
    return spark.table(name)


@query("small_file_compaction", "B17", sql="SELECT 2 AS files, count(*) AS total_rows, sum(event_id)::BIGINT AS key_sum FROM events")
def _(spark, d):
    name = f"{scratch_db(spark)}.events"
    R.events(spark, d).select("event_id", "value").repartition(24).write.saveAsTable(name)
    T.compact(spark, name, 2)
    rows = spark.table(name)
    return rows.select("event_id", F.col("_metadata.file_path").alias("f")).agg(
        F.countDistinct("f").alias("files"), F.count(F.lit(1)).alias("total_rows"), F.sum("event_id").alias("key_sum")
    )


def _versions(spark, d):
    """Two snapshots of the orders: deletions, changes and insertions between them."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    kind = F.col("o_orderpriority")
    old = o.filter(kind != "1-URGENT")
    price = F.when(kind == "3-MEDIUM", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new = o.filter(kind != "5-LOW").withColumn("o_totalprice", price)
    return old, new


_CHANGED_PRICE = "CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice"


@query(
    "snapshot_change_rows", "B18",
    sql=f"""SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'I' WHEN '3-MEDIUM' THEN 'U' ELSE 'D' END AS change,
    o_orderkey, o_orderpriority, {_CHANGED_PRICE}
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW')""",
)
def _(spark, d):
    old, new = _versions(spark, d)
    return T.snapshot_diff(old, new, "o_orderkey")


@query(
    "snapshot_change_apply", "B18",
    sql=f"SELECT o_orderkey, o_orderpriority, {_CHANGED_PRICE} FROM orders WHERE o_orderpriority <> '5-LOW'",
)
def _(spark, d):
    old, new = _versions(spark, d)
    return T.apply_diff(old, T.snapshot_diff(old, new, "o_orderkey"), "o_orderkey")


@query(
    "rule_routed_fan_out", "B19", "H1",
    sql="""SELECT 'errors' AS target, event_id FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'large', event_id FROM events WHERE value > 20
    UNION ALL SELECT 'sales', event_id FROM events WHERE event_type = 'purchase'""",
)
def _(spark, d):
    root, mark = new_dir(spark, "routes"), new_dir(spark, "mark")
    rules = {
        "errors": F.col("event_type") == "error", "large": F.col("value") > 20,
        "sales": F.col("event_type") == "purchase",
    }
    Z.route_stream(R.event_stream(spark, d).select("event_id", "event_type", "value"), rules, root, mark)
    parts = [
        read_parquet(spark, f"{root}/{name}").select(F.lit(name).alias("target"), "event_id") for name in rules
    ]
    return T.align_columns(parts)


@query(
    "time_partitioned_sorted_table", "B20",
    sql="SELECT vehicle_id, event_id, speed_kmph, event_time::DATE::VARCHAR AS event_time_date FROM (WITH "
    + R.TELEMETRY_SQL + " SELECT * FROM tele)",
)
def _(spark, d):
    path = new_dir(spark, "telemetry")
    T.write_time_partitioned(R.telemetry(spark, d), path, "event_time", ["vehicle_id", "event_time"])
    return read_parquet(spark, path).select("vehicle_id", "event_id", "speed_kmph", "event_time_date")


@query("resorted_copy", "B21", sql="SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def _(spark, d):
    path = new_dir(spark, "by_user")
    T.write_resorted(R.events(spark, d).select("user_id", "ts", "event_id", "value"), path, ["user_id", "ts", "event_id"])
    return rounded(read_parquet(spark, path).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), 4)


@query(
    "keyed_update", "B22",
    sql="""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""",
)
def _(spark, d):
    name = f"{scratch_db(spark)}.customer"
    table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").write.saveAsTable(name)
    return T.update_where(spark, name, F.col("c_acctbal") < 0, {"c_acctbal": F.lit(0.0)})


@query("keyed_delete", "B22", sql="SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_mktsegment = 'BUILDING')")
def _(spark, d):
    name = f"{scratch_db(spark)}.customer"
    table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment").write.saveAsTable(name)
    return T.delete_where(spark, name, F.col("c_mktsegment") == "BUILDING").drop("c_mktsegment")


@query(
    "partitioned_update_delete_reload", "B22", "B4",
    sql="""SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 AND o_orderstatus <> 'O' THEN -1 ELSE o_totalprice END AS o_totalprice,
    o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND (o_orderkey % 5 <> 0 OR o_orderstatus = 'O')""",
)
def _(spark, d):
    """Update and delete in place, then one partition loaded again; the others stay whole."""
    name = f"{scratch_db(spark)}.orders"
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    T.write_table(rows, name, partition_by="o_orderstatus")
    T.update_where(spark, name, F.col("o_custkey") % 7 == 0, {"o_totalprice": F.lit(-1.0)})
    T.delete_where(spark, name, (F.col("o_orderkey") % 5 == 0) | (F.col("o_orderstatus") == "P"))
    T.overwrite_partition(rows.filter("o_orderstatus = 'O'"), name, "o_orderstatus")
    return spark.table(name).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "incremental_sum_rollup", "E12",
    sql="""SELECT ts::DATE::VARCHAR AS day, user_id, round(sum(value), 4) AS value, count(*) AS n FROM events GROUP BY 1, 2""",
)
def _(spark, d):
    """Several micro-batches, each stored twice; the older ones are folded into a base on the way."""
    from lakeops.catalog.streams import in_parts

    path, keys, sums, seen = new_dir(spark, "rollup"), ["day", "user_id"], ["value", "n"], [0]

    def build(stream):
        known = stream.filter("event_id IS NOT NULL")
        return known.select(F.to_date("ts").alias("day"), "user_id", "value", F.lit(1).cast("bigint").alias("n"))

    def write(batch, batch_id):
        T.rollup_upsert(batch, path, keys, sums, batch_id)
        T.rollup_upsert(batch, path, keys, sums, batch_id)  # a replay changes nothing
        seen.append(batch_id)

    def run(stream, mark):
        Z.for_each_batch(stream, write, mark)
        T.compact_rollup(spark, path, keys, sums, max(seen) - 1)

    in_parts(spark, R.events(spark, d), "ts", build, run)
    return rounded(T.read_rollup(spark, path, keys, sums), 4)


@query("insert_time_dedup", "E13", sql="SELECT DISTINCT user_id, event_type FROM events")
def _(spark, d):
    from lakeops.catalog.streams import in_parts

    path, seen = new_dir(spark, "distinct"), [0]

    def build(stream):
        return stream.filter("event_id IS NOT NULL").select("user_id", "event_type")

    def write(batch, batch_id):
        T.dedup_on_insert(batch, path, batch_id)
        seen.append(batch_id)

    def run(stream, mark):
        Z.for_each_batch(stream, write, mark)
        T.compact_distinct(spark, path, max(seen) - 1)

    in_parts(spark, R.events(spark, d), "ts", build, run)
    return T.read_distinct(spark, path)


@query("json_round_trip", "I18", "I19", "A4", sql=EVENTS_SQL)
def _(spark, d):
    parsed = event_lines(R.events(spark, d)).select(F.from_json("value", EVENTS_DDL, NTZ).alias("p"))
    return parsed.select("p.*")


@query("message_topic_round_trip", "B8", "A11", sql="SELECT c_custkey, c_name FROM customer")
def _(spark, d):
    topic, out, mark = (new_dir(spark, n) for n in ("topic", "out", "mark"))
    Z.to_messages(table(spark, d, "customer").select("c_custkey", "c_name")).write.text(topic)
    Z.stream_to_table(stream_json(spark, topic, "c_custkey BIGINT, c_name STRING"), out, mark)
    return read_parquet(spark, out)
