"""Pipeline inputs derived from the given tables, each with its SQL text twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.cases import lookup
from lakeops.operators.series import bars_from_ticks

# Event kinds read as alert kinds.
ALERT_KINDS = {"error": "overspeed", "click": "harsh_brake", "view": "idling"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def event_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The events table as an unbounded source."""
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .options(**options)
        .parquet(f"{sf_dir}/events.parquet")
    )


def as_telemetry(ev: DataFrame) -> DataFrame:
    """Positions and speeds of vehicles; every 50th event has no trip."""
    trip = F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    return ev.select(
        "event_id",
        F.col("user_id").alias("vehicle_id"),
        (F.col("user_id") % 20).alias("driver_id"),
        F.when(F.col("event_id") % 50 == 0, F.lit("")).otherwise(trip).alias("trip_id"),
        F.col("ts").alias("event_time"),
        (F.lit(12.9) + (F.col("event_id") % 1000) / 1000.0).alias("lat"),
        (F.lit(77.6) + (F.col("event_id") % 777) / 1000.0).alias("lon"),
        F.col("value").alias("speed_kmph"),
    )


TELEMETRY_SQL = """
tele AS (
  SELECT event_id, user_id AS vehicle_id, user_id % 20 AS driver_id,
         CASE WHEN event_id % 50 = 0 THEN ''
              ELSE user_id::VARCHAR || '_' || strftime(ts, '%Y-%m-%d') END AS trip_id,
         ts AS event_time,
         12.9::DOUBLE + (event_id % 1000)::DOUBLE / 1000 AS lat,
         77.6::DOUBLE + (event_id % 777)::DOUBLE / 1000 AS lon,
         value AS speed_kmph
  FROM events
)"""

DELTA_SQL = (
    TELEMETRY_SQL
    + """,
prev AS (
  SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(trip_id) OVER w AS ptrip
  FROM tele WINDOW w AS (PARTITION BY vehicle_id ORDER BY event_time, event_id)
),
delta AS (
  SELECT *, CASE WHEN plat IS NULL OR plon IS NULL OR trip_id IS NULL OR trip_id = '' OR trip_id <> ptrip THEN 0.0
    ELSE 2 * 6371000.0 * asin(least(1.0, sqrt(
      pow(sin(radians(lat - plat) / 2), 2)
      + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2)))) END AS delta_m
  FROM prev
)"""
)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_telemetry(events(spark, sf_dir))


def as_alerts(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id",
        F.col("user_id").alias("vehicle_id"),
        F.col("ts").alias("event_time"),
        lookup(F.col("event_type"), ALERT_KINDS).alias("alert_type"),
        "value",
    ).filter(F.col("alert_type").isNotNull())


ALERTS_SQL = """
alerts AS (
  SELECT event_id, user_id AS vehicle_id, ts AS event_time, value,
         CASE event_type WHEN 'error' THEN 'overspeed' WHEN 'click' THEN 'harsh_brake' ELSE 'idling' END AS alert_type
  FROM events WHERE event_type IN ('error', 'click', 'view')
)"""


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars per event type."""
    return bars_from_ticks(events(spark, sf_dir), "event_type", "ts", "event_id", "value")


BARS_SQL = """
bars AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS date,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2
)"""


def race_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined to their order, customer and nation: the star behind the standings."""
    from lakeops.operators.joins import star_join

    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    fact = read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    orders = read("orders").withColumn("race_year", F.year("o_orderdate")).withColumn(
        "race_month", F.month("o_orderdate")
    )
    return star_join(
        fact,
        [
            (orders, {"l_orderkey": "o_orderkey"}, ["o_custkey", "race_year", "race_month"]),
            (read("customer"), {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey", "c_mktsegment"]),
            (read("nation"), {"c_nationkey": "n_nationkey"}, ["n_name"]),
        ],
    )


RACE_SQL = """
race AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_shipdate,
         year(o.o_orderdate) AS race_year, month(o.o_orderdate) AS race_month,
         o.o_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, n.n_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

RACE_ORDER = ["-l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]

POINTS_SQL = (
    RACE_SQL
    + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY race_year, race_month
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS position
  FROM race
),
points AS (SELECT *, 11 - position AS calculated_points FROM placed WHERE position <= 10)"""
)


def race_points(spark: SparkSession, sf_dir: str, places: int = 10) -> DataFrame:
    """The best ten of every month with 11 - position points."""
    from lakeops.operators.topk import top_n_per_group

    best = top_n_per_group(race_rows(spark, sf_dir), ["race_year", "race_month"], RACE_ORDER, places, out="position")
    return best.withColumn("calculated_points", F.lit(places + 1) - F.col("position"))


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one-year policies of their customers."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("policy_id"),
        F.col("o_custkey").alias("holder"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").alias("premium_amount"),
        F.to_date("o_orderdate").alias("policy_start_date"),
        F.date_add(F.to_date("o_orderdate"), 365).alias("policy_end_date"),
    )


POLICIES_SQL = """
policies AS (
  SELECT o_orderkey AS policy_id, o_custkey AS holder, o_orderpriority AS product, o_totalprice AS premium_amount,
         o_orderdate::DATE AS policy_start_date, o_orderdate::DATE + 365 AS policy_end_date
  FROM orders
)"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned line items as claims on their order."""
    return (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .filter("l_returnflag = 'R'")
        .select(
            F.col("l_orderkey").alias("policy_id"),
            F.col("l_extendedprice").alias("claim_amount"),
            F.col("l_linestatus").alias("claim_status"),
            F.to_date("l_shipdate").alias("loss_date"),
        )
    )


CLAIMS_SQL = """
claims AS (
  SELECT l_orderkey AS policy_id, l_extendedprice AS claim_amount, l_linestatus AS claim_status,
         l_shipdate::DATE AS loss_date
  FROM lineitem WHERE l_returnflag = 'R'
)"""
