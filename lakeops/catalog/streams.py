"""Structured Streaming: each query runs a real stream over the events and reads its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, rounded, scratch_db
from lakeops.catalog.windowed import SUMMARY_SQL
from lakeops.functions import payload
from lakeops.operators.windows import with_delta_m
from lakeops.plans import roles as R
from lakeops.session import ROCKSDB, new_dir, session_conf
from lakeops.sinks import streams as Z
from lakeops.sinks import tables as T
from lakeops.sources.files import read_parquet
from lakeops.sources.streams import stream_lines
from lakeops.streaming import state
from lakeops.streaming import windows as K



def state_conf(spark, partitions=None):
    """RocksDB state in ``partitions`` parts, fixed for the life of a checkpoint; one per core here."""
    return session_conf(
        spark,
        {
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
        },
    )


def timed_events(spark, d, lateness="5 seconds"):
    return K.with_event_time(R.event_stream(spark, d), "ts", "event_time", lateness=lateness)


def parts_out_of_order(rows, ts, parts=3, late_hours=5):
    """``rows`` cut along time, with every second row of the last hours before a cut in the next part.

    A last part of one row, two days on and null but for its time, moves the watermark past all
    others; what it opens itself stays open.
    """
    low, high = F.min(ts).cast("timestamp"), F.max(ts).cast("timestamp")
    first, last = rows.agg(F.unix_micros(low).alias("a"), F.unix_micros(high).alias("b")).first()
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    span = (last - first) // parts + 1
    home = F.floor((at - first) / span)
    held = (home < parts - 1) & (first + (home + 1) * span - at < late_hours * 3_600_000_000) & (F.xxhash64(ts) % 2 == 0)
    dealt = rows.withColumn("_part", F.when(held, home + 1).otherwise(home))
    return [*(dealt.filter(F.col("_part") == i).drop("_part") for i in range(parts)), far_ahead(rows, ts)]


def far_ahead(rows, ts):
    return rows.agg(F.max(ts).alias("_max")).select(
        *[
            (F.col("_max") + F.expr("INTERVAL 2 DAYS")).alias(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name)
            for f in rows.schema.fields
        ]
    )


def in_parts(spark, rows, ts, build, run):
    """Feed ``rows`` in parts; each is a run of its own on one checkpoint, as after a restart."""
    src, mark = new_dir(spark, "feed"), new_dir(spark, "mark")
    for part in parts_out_of_order(rows, ts):
        part.write.mode("append").parquet(src)
        stream = build(spark.readStream.schema(rows.schema).parquet(src))
        with state_conf(spark):
            run(stream, mark)


FILES = 4


def closed(spark, rows, ts, build):
    """Append-mode result of an event-time query, one micro-batch per part."""
    src, out, mark = new_dir(spark, "feed"), new_dir(spark, "out"), new_dir(spark, "mark")
    for part in parts_out_of_order(rows, ts):
        part.repartition(FILES).write.mode("append").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(src)
    with state_conf(spark):
        Z.stream_to_table(build(stream), out, mark)
    return read_parquet(spark, out)


LATE = "6 hours"


def appended(stream, name):
    out, mark = Z.scratch(stream, name)
    with state_conf(stream.sparkSession):
        Z.stream_to_table(stream, out, mark)
    return read_parquet(stream.sparkSession, out)


def unzoned(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


BOUNDS = "strftime({s}, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime({s} + INTERVAL {w}, '%Y-%m-%d %H:%M:%S.%f') AS window_end"


@query(
    "event_time_with_fallback", "K1", "K2",
    sql="SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time, 0 AS from_clock FROM events WHERE event_type <> 'view' UNION ALL SELECT event_id, NULL, 1 FROM events WHERE event_type = 'view'",
)
def _(spark, d):
    ts = F.when(F.col("event_type") != "view", F.col("ts"))
    raw = R.event_stream(spark, d).select("event_id", ts.alias("raw_ts"))
    out = appended(K.with_event_time(raw, "raw_ts", fallback=True), "fallback")
    clock = F.col("raw_ts").isNull() & F.col("event_time").isNotNull()
    shown = F.when(F.col("raw_ts").isNotNull(), F.col("event_time").cast("timestamp_ntz"))
    return out.select("event_id", shown.alias("event_time"), clock.cast("int").alias("from_clock"))


@query(
    "tumbling_trip_summary", "K3", "E1",
    sql=f"""WITH {R.TELEMETRY_SQL}
    SELECT vehicle_id, {BOUNDS.format(s="time_bucket(INTERVAL 20 SECOND, event_time)", w="20 SECOND")},
    count(*) AS event_count, round(avg(speed_kmph), 6) AS avg_speed, max(speed_kmph) AS max_speed, min(speed_kmph) AS min_speed
    FROM tele GROUP BY vehicle_id, time_bucket(INTERVAL 20 SECOND, event_time)""",
)
def _(spark, d):
    aggs = {
        "event_count": F.count(F.lit(1)), "avg_speed": F.avg("speed_kmph"), "max_speed": F.max("speed_kmph"),
        "min_speed": F.min("speed_kmph"),
    }

    def build(tele):
        return K.tumble(K.with_event_time(tele, "event_time", lateness=LATE), "event_time", "20 seconds", "vehicle_id", aggs)

    return rounded(unzoned(closed(spark, R.telemetry(spark, d), "event_time", build), "window_start", "window_end"))


def _moves(tele):
    """A stream of points with the distance to the point before, in event-time order."""
    return state.stream_delta_m(K.with_event_time(tele, "event_time", lateness=LATE), tie=["event_id"], slots=64)


def closed_over_moves(spark, d, build):
    """Closed windows over moves: one query writes the moves, a second reads them as they land."""
    moves, out, mark = new_dir(spark, "moves"), new_dir(spark, "out"), new_dir(spark, "mark")
    tele = R.telemetry(spark, d)
    shape = tele.withColumn("event_time", F.col("event_time").cast("timestamp")).withColumn("delta_m", F.lit(0.0))

    def second():
        stream = spark.readStream.schema(shape.schema).option("recursiveFileLookup", True).parquet(moves)
        timed = K.with_event_time(stream, "event_time", lateness="1 minute")
        Z.stream_to_table(build(timed), out, mark)

    def first(stream, own_mark):
        Z.row_sink(stream, moves, own_mark)
        second()

    in_parts(spark, tele, "event_time", _moves, first)
    far_ahead(shape, "event_time").write.parquet(f"{moves}/end")
    with state_conf(spark):
        second()
    return read_parquet(spark, out)


@query(
    "tumbling_trip_distance", "K3", "J4",
    sql=f"""WITH {R.DELTA_SQL} SELECT vehicle_id, {BOUNDS.format(s="date_trunc('hour', event_time)", w="1 HOUR")},
    strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS trip_start, strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS trip_end,
    floor((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1000000)::BIGINT AS trip_duration_sec, count(*) AS event_count,
    round(sum(delta_m), 4) AS distance_m, round(sum(delta_m) / 1000.0, 4) AS distance_km, round(avg(speed_kmph), 6) AS avg_speed,
    max(speed_kmph) AS max_speed, min(speed_kmph) AS min_speed
    FROM delta GROUP BY vehicle_id, date_trunc('hour', event_time)""",
)
def _(spark, d):
    out = closed_over_moves(spark, d, lambda moves: K.trip_window_summary(moves, "1 hour"))
    return rounded(unzoned(out, "window_start", "window_end"), 4, avg_speed=6)


@query(
    "tumbling_temperature_alert", "K4", "C7",
    sql=f"""SELECT vehicle_id, {BOUNDS.format(s="m", w="1 MINUTE")}, 'high_engine_temp' AS alert_type,
    'temp=' || max(value)::VARCHAR AS details, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS time_stamp
    FROM (SELECT user_id AS vehicle_id, date_trunc('minute', ts) AS m, ts, value FROM events WHERE value > 20) GROUP BY vehicle_id, m""",
)
def _(spark, d):
    status = R.events(spark, d).select(
        F.col("user_id").alias("vehicle_id"), F.col("ts").alias("event_time"), F.col("value").alias("engine_temp_c")
    )

    def build(stream):
        timed = K.with_event_time(stream, "event_time", lateness=LATE)
        return K.temperature_alerts(timed.fillna(99.0, ["engine_temp_c"]), limit=20.0)

    return unzoned(closed(spark, status, "event_time", build), "window_start", "window_end", "time_stamp")


HOP_SQL = """
h AS (SELECT *, unnest(generate_series(0, {n})) AS i FROM {src}),
w AS (SELECT *, date_trunc('second', event_time) - to_seconds(i) AS ws FROM h)"""


@query(
    "hopping_behaviour_score", "K5", "C18", "I26",
    sql=f"""WITH {R.ALERTS_SQL}, {HOP_SQL.format(n=14, src="alerts")} SELECT vehicle_id, {BOUNDS.format(s="ws", w="15 SECOND")},
    sum(CASE alert_type WHEN 'overspeed' THEN 2.0::DOUBLE WHEN 'harsh_brake' THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END) AS score
    FROM w GROUP BY vehicle_id, ws""",
)
def _(spark, d):
    def build(alerts):
        return K.behaviour_score(K.with_event_time(alerts, "event_time", lateness=LATE))

    return unzoned(closed(spark, R.as_alerts(R.events(spark, d)), "event_time", build), "window_start", "window_end")


@query(
    "hopping_score_batch_panes", "K5",
    sql=f"""WITH {R.ALERTS_SQL}, {HOP_SQL.format(n=14, src="alerts")} SELECT vehicle_id, {BOUNDS.format(s="ws", w="15 SECOND")},
    sum(CASE alert_type WHEN 'overspeed' THEN 2.0::DOUBLE WHEN 'harsh_brake' THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END) AS score
    FROM w GROUP BY vehicle_id, ws""",
)
def _(spark, d):
    return K.behaviour_score(R.as_alerts(R.events(spark, d)))


@query(
    "hopping_utilisation", "K6", "E3",
    sql=f"""WITH {R.TELEMETRY_SQL}, {HOP_SQL.format(n=4, src="tele")} SELECT {BOUNDS.format(s="ws", w="5 SECOND")},
    sum(CASE WHEN speed_kmph > 5 THEN 1 ELSE 0 END)::BIGINT AS active_count,
    sum(CASE WHEN speed_kmph <= 5 THEN 1 ELSE 0 END)::BIGINT AS idle_count, 0 AS offline_count FROM w GROUP BY ws""",
)
def _(spark, d):
    def build(tele):
        return K.utilisation(K.with_event_time(tele, "event_time", lateness=LATE))

    return unzoned(closed(spark, R.telemetry(spark, d), "event_time", build), "window_start", "window_end")


_TRIPS_SQL = f"""WITH {R.DELTA_SQL} SELECT trip_id, vehicle_id, driver_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS trip_start,
    strftime(max(event_time), '%Y-%m-%d %H:%M:%S') AS trip_end,
    epoch(date_trunc('second', max(event_time)))::BIGINT - epoch(date_trunc('second', min(event_time)))::BIGINT AS trip_duration_sec,
    count(*) AS event_count, round(sum(delta_m), 4) AS distance_m, round(sum(delta_m) / 1000.0, 4) AS distance_km,
    round(avg(speed_kmph), 6) AS avg_speed, min(speed_kmph) AS min_speed, max(speed_kmph) AS max_speed
    FROM delta WHERE trip_id <> '' GROUP BY 1, 2, 3"""


@query(
    "continuous_trip_summary", "K7", "E8",
    sql=_TRIPS_SQL,
)
def _(spark, d):
    """Moves in event-time order, folded per micro-batch, merged when read."""
    path = new_dir(spark, "trips")

    def run(stream, mark):
        K.running_trip_summary(stream, path, mark)

    in_parts(spark, R.telemetry(spark, d), "event_time", lambda s: _moves(s).filter("trip_id <> ''"), run)
    return rounded(K.read_trip_summary(spark, path), 4, avg_speed=6)


@query("continuous_trip_changes", "K7", "B9", "E8", sql=_TRIPS_SQL)
def _(spark, d):
    """Trips sent again on change; the keyed sink holds the last row sent for each."""
    base, keys = scratch_db(spark), ["trip_id", "vehicle_id", "driver_id"]

    def send(changes, batch_id):
        T.upsert_batch(changes.drop("change", "before"), f"{base}.sent", keys, "batch", buckets=8)

    def run(stream, mark):
        K.trip_change_stream(stream, f"{base}.trips", mark, send)

    in_parts(spark, R.telemetry(spark, d), "event_time", lambda s: _moves(s).filter("trip_id <> ''"), run)
    return rounded(T.read_upserted(spark, f"{base}.sent").drop("batch"), 4, avg_speed=6)


@query(
    "threshold_alert_stream", "K8", "B9", "C7",
    sql=f"WITH {R.TELEMETRY_SQL} SELECT event_id, vehicle_id, trip_id, speed_kmph FROM tele WHERE speed_kmph > 20",
)
def _(spark, d):
    name, mark = f"{scratch_db(spark)}.alerts", new_dir(spark, "mark")
    stream = R.as_telemetry(R.event_stream(spark, d)).select("event_id", "vehicle_id", "trip_id", "speed_kmph", "event_time")
    Z.row_sink(K.threshold_alerts(stream, "speed_kmph", 20.0), name, mark, "event_id", "event_time", buckets=8)
    return T.read_upserted(spark, name).drop("event_time")


@query("streaming_previous_point_distance", "K9", "N4", "J4", sql=f"WITH {R.DELTA_SQL} SELECT event_id, round(delta_m, 4) AS delta_m FROM delta")
def _(spark, d):
    def build(tele):
        return _moves(tele).select("event_id", "delta_m")

    return rounded(closed(spark, R.telemetry(spark, d), "event_time", build), 4)


@query(
    "stream_interval_join", "K10", "D6",
    sql="""SELECT s.user_id, s.event_id AS start_event_id, e.event_id AS end_event_id,
    floor((epoch_us(e.ts) - epoch_us(s.ts)) / 1000000)::BIGINT AS break_seconds
    FROM events s JOIN events e ON s.user_id = e.user_id AND s.event_type = 'signup' AND e.event_type = 'error'
    AND e.ts > s.ts AND e.ts < s.ts + INTERVAL 6 HOUR""",
)
def _(spark, d):
    timed = R.event_stream(spark, d).withColumn("event_time", F.col("ts").cast("timestamp"))
    pairs = K.pair_stream(
        timed, "user_id", "event_time", F.col("event_type") == "signup", F.col("event_type") == "error", 6 * 3600,
        ["event_id"], lateness="10 seconds",
    )
    return appended(pairs.select("user_id", "start_event_id", "end_event_id", "break_seconds"), "pairs")


@query(
    "live_trip_metrics", "K11",
    sql=f"""WITH {R.DELTA_SQL} SELECT trip_id, vehicle_id, driver_id, {BOUNDS.format(s="date_trunc('minute', event_time)", w="1 MINUTE")},
    round(sum(delta_m), 4) AS distance_m, round(avg(speed_kmph), 6) AS avg_speed, count(*) AS event_count
    FROM delta GROUP BY trip_id, vehicle_id, driver_id, date_trunc('minute', event_time)""",
)
def _(spark, d):
    out = closed_over_moves(spark, d, K.trip_window_metrics)
    return rounded(unzoned(out, "window_start", "window_end"), 4, avg_speed=6)


@query(
    "late_rows_dropped", "K12", "K2",
    sql="""WITH m AS (SELECT max(ts) AS top FROM events WHERE ts < TIMESTAMP '2024-01-15'),
    w AS (SELECT date_trunc('hour', ts) AS ws, ts, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0
      WHEN ts >= TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS part FROM events)
    SELECT strftime(ws, '%Y-%m-%d %H:%M:%S.%f') AS window_start, count(*) AS n FROM w
    WHERE part < 2 GROUP BY ws""",
)
def _(spark, d):
    """The middle days arrive after the last days and are behind the watermark: none of them counts."""
    src = new_dir(spark, "feed")
    ev = R.events(spark, d)
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    parts = [
        ev.filter(F.col("ts") < at("2024-01-15")),
        ev.filter(F.col("ts") >= at("2024-01-20")),
        ev.filter((F.col("ts") >= at("2024-01-15")) & (F.col("ts") < at("2024-01-20"))),
    ]
    out, mark = new_dir(spark, "out"), new_dir(spark, "mark")
    sums = {}
    for part in parts:
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(R.EVENT_SCHEMA).parquet(src)
        timed = K.with_event_time(stream, "ts", "event_time", lateness="10 seconds")
        sums = K.tumble(timed, "event_time", "1 hour", [], {"n": F.count(F.lit(1))})
        with state_conf(spark):
            Z.for_each_batch(sums, _replace_windows(out), mark, mode="update")
    rows = read_parquet(spark, out).groupBy("window_start").agg(F.max_by("n", "batch").alias("n"))
    return unzoned(rows, "window_start")


def _replace_windows(path):
    """Updated windows by batch; the latest batch holding a window has its count."""

    def write(batch, batch_id):
        batch.drop("window_end").write.mode("overwrite").parquet(f"{path}/batch={int(batch_id)}")

    return write


SESSION_SQL = """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL {gap} SECOND THEN 0 ELSE 1 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  strftime(max(ts) + INTERVAL {gap} SECOND, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
  count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, sid"""


def session_measures():
    return {"n": ("sum", F.lit(1)), "total": ("sum", F.col("value"))}


@query("session_windows_batch", "K13", sql=SESSION_SQL.format(gap=21600))
def _(spark, d):
    return rounded(K.session(R.events(spark, d), "ts", 21600, "user_id", session_measures()), 4)


@query("session_windows_stream", "K13", sql=SESSION_SQL.format(gap=21600))
def _(spark, d):
    def build(stream):
        timed = K.with_event_time(stream, "ts", "event_time", lateness=LATE)
        return K.session(timed, "event_time", 21600, "user_id", session_measures())

    out = closed(spark, R.events(spark, d), "ts", build)
    return rounded(unzoned(out, "window_start", "window_end"), 4)


def _raw_lines(spark, d, line):
    src = new_dir(spark, "topic")
    R.events(spark, d).select(line.alias("value")).write.text(src)
    return stream_lines(spark, src)


def _view(spark, d, line, transform):
    name, mark = f"{scratch_db(spark)}.view", new_dir(spark, "mark")
    K.continuous_view(_raw_lines(spark, d, line), transform, name, mark)
    return spark.table(name)


def _text_pairs(**cols):
    """Rows as JSON of strings whose pair separators lost their comma."""
    return F.replace(F.to_json(F.struct(*[c.cast("string").alias(n) for n, c in cols.items()])), F.lit('","'), F.lit('""'))


@query(
    "view_telemetry", "K14", "I20", "I7",
    sql=f"""WITH {R.TELEMETRY_SQL} SELECT event_id, vehicle_id, strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, speed_kmph FROM tele""",
)
def _(spark, d):
    line = _text_pairs(
        event_id=F.col("event_id"), vehicle_id=F.col("user_id"),
        timestamp=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), speed_kmph=F.col("value"),
    )

    def transform(lines):
        p = payload.parse(payload.repair_quotes(F.col("value")), "event_id STRING, vehicle_id STRING, timestamp STRING, speed_kmph STRING")
        return lines.select(p.alias("p")).select(
            payload.safe_unsigned(F.col("p.event_id")).alias("event_id"),
            payload.safe_unsigned(F.col("p.vehicle_id")).alias("vehicle_id"),
            F.col("p.timestamp").try_cast("timestamp_ntz").alias("event_ts"),
            payload.safe_number(F.col("p.speed_kmph")).alias("speed_kmph"),
        )

    return _view(spark, d, line, transform)


@query(
    "view_alerts", "K14", "I21", "I17",
    sql=f"WITH {R.ALERTS_SQL} SELECT event_id AS alert_id, vehicle_id, alert_type, floor(value)::BIGINT AS severity FROM alerts",
)
def _(spark, d):
    kind = F.when(F.col("event_type") == "error", "overspeed").when(F.col("event_type") == "click", "harsh_brake").when(
        F.col("event_type") == "view", "idling"
    )
    # newlines inside a message survive as an escape until the line is parsed
    line = F.concat(
        F.lit('("alert_id":'), F.col("event_id").cast("string"), F.lit('\\n"vehicle_id":'), F.col("user_id").cast("string"),
        F.lit('\\n"alert_type":"'), F.coalesce(kind, F.lit("")), F.lit('"\\n"severity":'),
        F.floor("value").cast("string"), F.lit(")"),
    )

    def transform(lines):
        js = payload.rebuild_object(F.replace(F.col("value"), F.lit("\\n"), F.lit("\n")))
        return lines.select(js.alias("js")).select(
            payload.int_field(F.col("js"), "alert_id").alias("alert_id"),
            payload.int_field(F.col("js"), "vehicle_id").alias("vehicle_id"),
            payload.field(F.col("js"), "alert_type").alias("alert_type"),
            payload.int_field(F.col("js"), "severity").alias("severity"),
        ).filter("alert_type <> ''")

    return _view(spark, d, line, transform)


@query(
    "view_driver_events", "K14",
    sql="""SELECT user_id AS driver_id, event_id, CASE event_type WHEN 'signup' THEN 'break_start' ELSE 'break_end' END AS event_type
    FROM events WHERE event_type IN ('signup', 'error')""",
)
def _(spark, d):
    line = F.to_json(F.struct(F.col("user_id").alias("driver_id"), "event_id", "event_type"))

    def transform(lines):
        v = F.col("value")
        kind = F.when(payload.field(v, "event_type") == "signup", "break_start").when(
            payload.field(v, "event_type") == "error", "break_end"
        )
        return lines.select(
            payload.int_field(v, "driver_id").alias("driver_id"), payload.int_field(v, "event_id").alias("event_id"),
            kind.alias("event_type"),
        ).filter("event_type IS NOT NULL")

    return _view(spark, d, line, transform)


@query(
    "view_window_metrics", "K14", "I16",
    sql="SELECT event_id, value AS speed, CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS trips FROM events",
)
def _(spark, d):
    trips = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("user_id").cast("string"))
    line = _text_pairs(event_id=F.col("event_id"), speed=F.col("value"), trips=F.concat(F.lit("t"), trips))

    def transform(lines):
        js = payload.repair_quotes(F.col("value"))
        return lines.select(
            payload.int_field(js, "event_id").alias("event_id"),
            payload.safe_number(payload.field(js, "speed")).alias("speed"),
            payload.safe_unsigned(payload.blank_to_null(F.substring(payload.field(js, "trips"), 2, 20))).alias("trips"),
        )

    return _view(spark, d, line, transform)


@query(
    "view_trip_events", "K14", "I15", "I16",
    sql=f"""WITH {R.TELEMETRY_SQL} SELECT event_id, nullif(trip_id, '') AS trip_id, round(lat, 6) AS origin_lat FROM tele""",
)
def _(spark, d):
    src = new_dir(spark, "topic")
    R.telemetry(spark, d).select(F.to_json(F.struct("event_id", "trip_id", "lat")).alias("value")).write.text(src)

    def transform(lines):
        v = F.col("value")
        return lines.select(
            payload.int_field(v, "event_id").alias("event_id"),
            payload.blank_to_null(payload.field(v, "trip_id")).alias("trip_id"),
            F.round(payload.safe_number(payload.field(v, "lat")), 6).alias("origin_lat"),
        )

    name, mark = f"{scratch_db(spark)}.view", new_dir(spark, "mark")
    K.continuous_view(stream_lines(spark, src), transform, name, mark)
    return spark.table(name)


@query("view_trip_summary", "K14", "E8", "B8", sql=SUMMARY_SQL)
def _(spark, d):
    """Summaries travel as messages and land in a typed table."""
    from lakeops.operators.aggregate import trip_summary

    src = new_dir(spark, "topic")
    moved = with_delta_m(R.telemetry(spark, d), tie=["event_id"])
    summary = trip_summary(moved.filter("trip_id <> ''"))
    Z.to_messages(summary).write.text(src)
    schema = summary.schema

    def transform(lines):
        return lines.select(payload.parse(F.col("value"), schema).alias("p")).select("p.*")

    name, mark = f"{scratch_db(spark)}.view", new_dir(spark, "mark")
    K.continuous_view(stream_lines(spark, src), transform, name, mark)
    return rounded(spark.table(name), 4, avg_speed=6)


@query("stream_deduplication", "K15", sql="SELECT event_id, user_id, event_type FROM events")
def _(spark, d):
    """Every event is delivered twice in one feed and kept once."""
    src = new_dir(spark, "feed")
    ev = R.events(spark, d)
    ev.unionByName(ev).write.parquet(src)
    stream = spark.readStream.schema(R.EVENT_SCHEMA).parquet(src).withColumn("event_time", F.col("ts").cast("timestamp"))
    once = K.stream_dedup(stream, "event_id", "event_time", lateness="10 seconds")
    return appended(once.select("event_id", "user_id", "event_type"), "once")


@query(
    "rebased_replay", "K16", "I8",
    sql="""WITH p AS (SELECT event_id, date_trunc('minute', ts) AS a, date_trunc('minute', ts) + INTERVAL 25 MINUTE AS b FROM events),
    f AS (SELECT arg_min(a, event_id) AS first FROM p)
    SELECT event_id, strftime(TIMESTAMP '2030-01-01 08:00:00' + (a - first), '%Y-%m-%dT%H:%M:%S') AS pickup,
    strftime(TIMESTAMP '2030-01-01 08:00:00' + (b - first), '%Y-%m-%dT%H:%M:%S') AS dropoff FROM p, f""",
)
def _(spark, d):
    fmt = "MM/dd/yyyy HH:mm"
    trips = R.events(spark, d).select(
        "event_id", F.date_format("ts", fmt).alias("pickup"),
        F.date_format(F.col("ts") + F.expr("interval 25 minutes"), fmt).alias("dropoff"),
    )
    return K.rebase_times(trips, ["pickup", "dropoff"], "event_id", F.lit("2030-01-01 08:00:00"))
