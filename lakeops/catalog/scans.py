"""Sources: batch files, catalog tables, message streams, envelopes.

Each query first lands one of the given tables in the format under test and
then reads it back through the library.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, scratch_db, table
from lakeops.plans import roles as R
from lakeops.session import new_dir
from lakeops.sinks.streams import stream_to_table
from lakeops.sources import files as S
from lakeops.sources import messages as M
from lakeops.sources import streams as X

ORDERS_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, o_orderpriority FROM orders"""
EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
EVENTS_SQL = """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"""
NTZ = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def event_lines(ev):
    """Events as one JSON text per row."""
    return ev.select(F.to_json(F.struct("*"), NTZ).alias("value"))


@query("csv_typed_scan", "A1", sql=ORDERS_SQL)
def _(spark, d):
    path = new_dir(spark, "csv")
    table(spark, d, "orders").write.option("header", True).csv(path)
    return S.read_csv(spark, path, ORDERS_DDL)


@query("csv_inferred_scan", "A2", sql="SELECT * FROM part")
def _(spark, d):
    path = new_dir(spark, "csv")
    table(spark, d, "part").write.option("header", True).csv(path)
    return S.read_csv(spark, path)


@query(
    "csv_folder_without_header", "A3",
    sql="SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem",
)
def _(spark, d):
    path = new_dir(spark, "csv")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
    table(spark, d, "lineitem").select(*cols).repartition(6).write.csv(path)
    ddl = (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE"
    )
    return S.read_csv(spark, path, ddl, header=False)


@query("json_lines_scan", "A4", sql="SELECT * FROM customer")
def _(spark, d):
    path = new_dir(spark, "json")
    table(spark, d, "customer").write.json(path)
    ddl = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    return S.read_json(spark, path, ddl)


@query("json_nested_scan", "A5", sql="SELECT s_suppkey, s_name AS forename, s_nationkey AS surname, s_acctbal FROM supplier")
def _(spark, d):
    path = new_dir(spark, "json")
    name = F.struct(F.col("s_name").alias("forename"), F.col("s_nationkey").alias("surname")).alias("name")
    table(spark, d, "supplier").select("s_suppkey", name, "s_acctbal").write.json(path)
    rows = S.read_json(spark, path, "s_suppkey BIGINT, name STRUCT<forename: STRING, surname: INT>, s_acctbal DOUBLE")
    return rows.select("s_suppkey", "name.forename", "name.surname", "s_acctbal")


@query("json_multiline_scan", "A6", sql="SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def _(spark, d):
    path = new_dir(spark, "json")
    row = F.struct("p_partkey", "p_name", "p_size", "p_retailprice")
    # at most 500 rows per array: the key is unique
    arrays = table(spark, d, "part").groupBy(F.floor(F.col("p_partkey") / 500)).agg(F.collect_list(row).alias("a"))
    text = arrays.select(F.to_json("a", {"pretty": "true"}).alias("value"))
    text.write.option("maxRecordsPerFile", 1).text(path)
    ddl = "p_partkey BIGINT, p_name STRING, p_size INT, p_retailprice DOUBLE"
    return S.read_json(spark, path, ddl, multiline=True)


@query(
    "parquet_scan_pruned", "A7",
    sql="SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity > 25 AND l_discount <= 0.05",
)
def _(spark, d):
    rows = S.read_parquet(spark, f"{d}/lineitem.parquet")
    return rows.filter("l_quantity > 25 AND l_discount <= 0.05").select("l_orderkey", "l_extendedprice")


@query("external_csv_table", "A8", sql="SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(spark, d):
    path = new_dir(spark, "raw")
    table(spark, d, "supplier").write.option("header", True).csv(path)
    db = scratch_db(spark)
    ddl = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    return S.create_external_table(spark, f"{db}.supplier", ddl, "csv", path, header="true")


@query("external_json_table", "A8", "A5", sql="SELECT c_custkey, c_name AS forename, c_mktsegment AS surname FROM customer")
def _(spark, d):
    path = new_dir(spark, "raw")
    name = F.struct(F.col("c_name").alias("forename"), F.col("c_mktsegment").alias("surname")).alias("name")
    table(spark, d, "customer").select("c_custkey", name).write.json(path)
    db = scratch_db(spark)
    ddl = "c_custkey BIGINT, name STRUCT<forename: STRING, surname: STRING>"
    rows = S.create_external_table(spark, f"{db}.customer", ddl, "json", path)
    return rows.select("c_custkey", "name.*")


@query(
    "catalog_table_by_sql", "A9", "B2",
    sql="SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1",
)
def _(spark, d):
    db = scratch_db(spark)
    table(spark, d, "orders").write.saveAsTable(f"{db}.orders")
    return S.read_table(spark, f"SELECT o_orderstatus, count(*) AS n FROM {db}.orders GROUP BY 1")


@query("layer_databases", "A10", "B2", sql="SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    root = new_dir(spark, "layers")
    tag = root.rsplit("-", 1)[1]
    bronze, silver, gold = (f"{name}_{tag}" for name in ("bronze", "silver", "gold"))
    S.ensure_layers(spark, [bronze, silver, gold], root)
    for name in ("nation", "region"):
        table(spark, d, name).write.saveAsTable(f"{bronze}.{name}")
    nation, region = (S.read_table(spark, f"{bronze}.{n}") for n in ("nation", "region"))
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    joined.select("n_nationkey", "n_name", "r_name").write.saveAsTable(f"{silver}.nation")
    return S.read_table(spark, f"{silver}.nation")


@query("json_message_stream", "A11", "I18", sql=EVENTS_SQL)
def _(spark, d):
    src, out, mark = (new_dir(spark, n) for n in ("topic", "out", "mark"))
    event_lines(R.events(spark, d)).repartition(4).write.text(src)
    stream_to_table(X.stream_json(spark, src, EVENTS_DDL, maxFilesPerTrigger="2"), out, mark)
    return S.read_parquet(spark, out)


@query(
    "tolerant_json_good_rows", "A12",
    sql="SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'view'",
)
def _(spark, d):
    good, _bad = M.parse_json_tolerant(_damaged(R.events(spark, d)), "value", "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    return good


@query(
    "tolerant_json_bad_rows", "A12",
    sql="""SELECT 'broken ' || event_id::VARCHAR || ' {' AS value FROM events WHERE event_type = 'view'""",
)
def _(spark, d):
    _good, bad = M.parse_json_tolerant(_damaged(R.events(spark, d)), "value", "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    return bad


def _damaged(ev):
    text = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    broken = F.concat(F.lit("broken "), F.col("event_id").cast("string"), F.lit(" {"))
    return ev.select(F.when(F.col("event_type") == "view", broken).otherwise(text).alias("value"))


@query("raw_line_stream", "A13", sql="SELECT event_type || ',' || event_id::VARCHAR AS value FROM events")
def _(spark, d):
    src, out, mark = (new_dir(spark, n) for n in ("lines", "out", "mark"))
    R.events(spark, d).select(F.concat_ws(",", "event_type", "event_id").alias("value")).write.text(src)
    stream_to_table(X.stream_lines(spark, src), out, mark)
    return S.read_parquet(spark, out)


@query(
    "incremental_file_ingest", "A14", "B12",
    sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def _(spark, d):
    src, base = new_dir(spark, "landing"), new_dir(spark, "ingest")
    target = f"{scratch_db(spark)}.orders"
    orders = table(spark, d, "orders").drop("o_orderdate")
    # files arrive twice; the second call takes only what is new
    for part in (orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'")):
        part.write.mode("append").option("header", True).csv(src)
        X.ingest_available(spark, src, base, "orders", target, "csv")
    X.ingest_available(spark, src, base, "orders", target, "csv")
    return spark.table(target).drop("_rescued", "_batch")


def _ingested(spark, generations, name):
    """Each generation lands as CSV files in one folder and is ingested before the next."""
    src, base = new_dir(spark, "landing"), new_dir(spark, "ingest")
    target = f"{scratch_db(spark)}.{name}"
    for rows in generations:
        rows.write.mode("append").option("header", True).csv(src)
        X.ingest_available(spark, src, base, name, target, "csv")
    return spark.table(target)


@query(
    "ingest_reordered_header", "A14",
    sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULL::VARCHAR AS _rescued FROM orders",
)
def _(spark, d):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    orders = table(spark, d, "orders").select(*cols)
    turned = orders.filter("o_orderstatus <> 'F'").select(*reversed(cols))
    return _ingested(spark, [orders.filter("o_orderstatus = 'F'"), turned], "orders").drop("_batch")


@query(
    "ingest_new_column", "A14",
    sql="""SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS o_custkey,
    CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def _(spark, d):
    """Three generations of files, each with a column more."""
    orders = table(spark, d, "orders")
    grown = [
        orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"),
        orders.filter("o_orderstatus NOT IN ('F', 'O')").select("o_custkey", "o_orderkey", "o_totalprice"),
        orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority", "o_custkey", "o_totalprice"),
    ]
    return _ingested(spark, grown, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderpriority")


@query(
    "ingest_rescued_values", "A14",
    sql="""SELECT c_custkey, CASE WHEN c_custkey % 10 <> 3 OR c_mktsegment = 'BUILDING' THEN c_acctbal END AS c_acctbal, c_mktsegment,
    CASE WHEN c_custkey % 10 = 3 AND c_mktsegment <> 'BUILDING' THEN '{"c_acctbal":"owed ' || c_custkey || '"}' END AS _rescued
    FROM customer""",
)
def _(spark, d):
    """Values that are no numbers in a column tracked as one."""
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    spoilt = F.when(F.col("c_custkey") % 10 == 3, F.concat(F.lit("owed "), "c_custkey")).otherwise(F.col("c_acctbal").cast("string"))
    later = rows.filter("c_mktsegment <> 'BUILDING'").select("c_mktsegment", spoilt.alias("c_acctbal"), "c_custkey")
    return _ingested(spark, [rows.filter("c_mktsegment = 'BUILDING'"), later], "customer").drop("_batch")


@query(
    "bounded_files_per_batch", "A15", "A14",
    sql="SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def _(spark, d):
    src, base = new_dir(spark, "landing"), new_dir(spark, "ingest")
    target = f"{scratch_db(spark)}.customer"
    table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").repartition(4).write.json(src)
    X.ingest_available(spark, src, base, "customer", target, "json", max_files=2)
    return spark.table(target).select("c_custkey", "c_name", "c_acctbal")


@query("bounded_consume", "A15", sql="SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 100")
def _(spark, d):
    return X.consume_at_most(R.events(spark, d).select("event_id", "user_id", "event_type"), ["event_id"], 100)


@query("base64_payload", "A16", "I24", sql="SELECT event_id, user_id, value FROM events")
def _(spark, d):
    body = F.base64(F.to_json(F.struct("user_id", "value")).cast("binary"))
    coded = R.events(spark, d).select("event_id", body.alias("data"))
    return M.decode_base64_json(coded, "data", "user_id BIGINT, value DOUBLE")


@query(
    "envelope_unwrap", "A17", "I17",
    sql="""SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('view', 'click', 'purchase')""",
)
def _(spark, d):
    """Nested, direct and bare records are unwrapped; blank and broken ones go."""
    obj = F.struct("event_id", "user_id", "event_type")
    event = F.to_json(F.struct(F.lit("shop").alias("source"), obj.alias("detail")))
    kind = F.col("event_type")
    body = (
        F.when(kind == "view", F.to_json(F.struct(event.alias("Message"), F.lit("n").alias("Type"))))
        .when(kind == "click", event)
        .when(kind == "purchase", F.to_json(obj))
        .when(kind == "signup", F.lit("  "))
        .otherwise(F.lit('{"detail": {}}'))
    )
    queue = R.events(spark, d).select(body.alias("body"))
    parsed = F.from_json("detail", "event_id BIGINT, user_id BIGINT, event_type STRING")
    return M.unwrap_envelope(queue).select(parsed.alias("p")).select("p.*")


@query(
    "latest_file_per_key", "A18", "B15",
    sql="""WITH day AS (SELECT event_type, ts::DATE AS day, count(*) AS n, max(value) AS best FROM events GROUP BY 1, 2)
    SELECT event_type, strftime(day, '%Y%m%d') AS day, n, best FROM day
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY day DESC) = 1""",
)
def _(spark, d):
    from lakeops.sinks.tables import write_keyed_json

    path = new_dir(spark, "keyed")
    daily = R.events(spark, d).groupBy("event_type", F.date_format("ts", "yyyyMMdd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("best")
    )
    write_keyed_json(daily, path, "event_type", "day")
    ddl = "n BIGINT, best DOUBLE, event_type STRING, day STRING"
    return S.latest_file_per_key(spark, path, "event_type", ddl, dated_by="day")


@query(
    "flatten_nested_record", "A19", "I22",
    sql="""SELECT event_id AS "event.id", user_id AS "event.by.user", value AS "event.by.value" FROM events""",
)
def _(spark, d):
    by = F.struct(F.col("user_id").alias("user"), "value")
    nested = R.events(spark, d).select(F.struct(F.col("event_id").alias("id"), by.alias("by")).alias("event"))
    return S.flatten_struct(nested)
