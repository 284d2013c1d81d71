"""Scalar function families and geodesic expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import query, rounded, table
from lakeops.functions import cases, geo, payload, text, times
from lakeops.plans import roles as R


@query(
    "concat_null_rules", "I1",
    sql="""SELECT event_id, event_type || '-' || CASE WHEN event_type = 'view' THEN NULL ELSE user_id::VARCHAR END AS strict,
    concat_ws('-', event_type, CASE WHEN event_type = 'view' THEN NULL ELSE user_id::VARCHAR END) AS loose FROM events""",
)
def _(spark, d):
    maybe = F.when(F.col("event_type") != "view", F.col("user_id").cast("string"))
    strict = text.template([F.col("event_type"), "-", maybe])
    return R.events(spark, d).select("event_id", strict.alias("strict"), F.concat_ws("-", "event_type", maybe).alias("loose"))


@query(
    "string_cutting", "I2",
    sql="SELECT c_custkey, substr(c_name, 1, 8) AS head, trim('  ' || c_mktsegment || ' ') AS segment, length(c_name) AS chars FROM customer",
)
def _(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        text.cut(F.col("c_name"), 8).alias("head"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("segment"),
        F.length("c_name").alias("chars"),
    )


@query(
    "iso_text_to_timestamp_text", "I3", "I2",
    sql="SELECT event_id, substr(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 1, 23) AS ts_text FROM events",
)
def _(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return R.events(spark, d).select("event_id", times.iso_head(iso).alias("ts_text"))


@query("case_insensitive_contains", "I4", sql="SELECT c_custkey FROM customer WHERE upper(c_mktsegment) LIKE '%MACH%'")
def _(spark, d):
    return table(spark, d, "customer").filter(text.contains_ci(F.col("c_mktsegment"), F.lit(" mach "))).select("c_custkey")


CLEAN_SQL = r"""
  array_to_string(list_slice(string_split(trim(regexp_replace(regexp_replace(regexp_replace(
    replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '(?i)<!DOCTYPE[^>]*>', '', 'g'),
      '(?i)<script[^>]*>.*?</script>', '', 'g'), '(?i)<style[^>]*>.*?</style>', '', 'g'), '<[^>]+>', '', 'g'),
      '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'),
    '[*_"''`]', '', 'g'), '[^A-Za-z0-9_\s]', '', 'g'), '\s+', ' ', 'g')), ' '), 1, 5), ' ')
"""


@query("clean_page_title", "I5", "M11", sql=f"SELECT page_id, {CLEAN_SQL.format(c='html')} AS title FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", text.clean_title(F.col("html")).alias("title"))


@query(
    "best_effort_iso_parse", "I7",
    sql="""SELECT event_id, strftime(CASE WHEN event_type = 'view' THEN NULL ELSE ts - INTERVAL 90 MINUTE END,
    '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM events""",
)
def _(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = F.when(F.col("event_type") == "view", F.lit("not a time")).otherwise(F.concat(iso, F.lit("+01:30")))
    parsed = F.to_utc_timestamp(times.parse_iso(raw), F.current_timezone())
    # an offset makes the text absolute: rendered in UTC whatever the session zone is
    return R.events(spark, d).select("event_id", F.to_timestamp_ntz(parsed.cast("string")).alias("parsed"))


@query(
    "timestamp_formats", "I8",
    sql="""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
    strftime(ts, '%Y%m%d') AS day FROM events""",
)
def _(spark, d):
    fmt = {"plain": "yyyy-MM-dd HH:mm:ss", "iso": "yyyy-MM-dd'T'HH:mm:ss", "day": "yyyyMMdd"}
    return R.events(spark, d).select("event_id", *[F.date_format("ts", f).alias(n) for n, f in fmt.items()])


@query(
    "epoch_and_floor_seconds", "I9",
    sql="""SELECT event_id, epoch(date_trunc('second', ts))::BIGINT - epoch(date_trunc('day', ts))::BIGINT AS text_seconds,
    floor((epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 1000000)::BIGINT AS whole_seconds FROM events""",
)
def _(spark, d):
    day = F.date_trunc("day", F.col("ts"))
    return R.events(spark, d).select(
        "event_id",
        times.text_seconds_between(day, F.col("ts")).alias("text_seconds"),
        times.seconds_between(day, F.col("ts").cast("timestamp")).alias("whole_seconds"),
    )


@query(
    "date_parts_and_truncation", "I10",
    sql="""SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
    strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS month_start, strftime(o_orderdate, '%Y%m') AS yyyymm
    FROM orders""",
)
def _(spark, d):
    at = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in times.day_parts(at).items()],
        F.date_trunc("month", at).alias("month_start"), F.date_format(at, "yyyyMM").alias("yyyymm"),
    )


@query(
    "age_from_injected_clock", "I11",
    sql="SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2002-01-01') AS age_days FROM orders",
)
def _(spark, d):
    as_of = F.lit("2002-01-01").cast("date")
    return table(spark, d, "orders").select("o_orderkey", F.datediff(as_of, F.to_date("o_orderdate")).alias("age_days"))


@query(
    "next_calendar_days", "I12",
    sql="""SELECT event_type, unnest(generate_series(max(ts)::DATE + 1, max(ts)::DATE + 30, INTERVAL 1 DAY))::DATE::VARCHAR AS date
    FROM events GROUP BY 1""",
)
def _(spark, d):
    last = R.events(spark, d).groupBy("event_type").agg(F.to_date(F.max("ts")).alias("last"))
    return last.select("event_type", F.explode(times.next_days(F.col("last"), 30)).alias("date"))


@query(
    "strip_time_zone", "I13",
    sql="SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events",
)
def _(spark, d):
    zoned = F.col("ts").cast("timestamp")
    return R.events(spark, d).select("event_id", times.without_zone(zoned).alias("ts"))


@query(
    "math_and_clamp", "I14",
    sql="""SELECT l_orderkey, l_linenumber, round(sqrt(l_extendedprice), 6) AS root, round(pow(l_discount, 2), 6) AS squared,
    abs(l_quantity - 25) AS off, round(least(greatest(l_tax * 10, 0.2), 0.5), 6) AS clamped FROM lineitem""",
)
def _(spark, d):
    out = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.sqrt("l_extendedprice").alias("root"), F.pow("l_discount", F.lit(2)).alias("squared"),
        F.abs(F.col("l_quantity") - 25).alias("off"), cases.clamp(F.col("l_tax") * 10, 0.2, 0.5).alias("clamped"),
    )
    return rounded(out)


@query(
    "null_handling", "I15",
    sql=f"""WITH {R.TELEMETRY_SQL} SELECT event_id, nullif(trip_id, '') AS trip, coalesce(nullif(trip_id, ''), 'none') AS filled FROM tele""",
)
def _(spark, d):
    trip = payload.blank_to_null(F.col("trip_id"))
    return R.telemetry(spark, d).select("event_id", trip.alias("trip"), F.coalesce(trip, F.lit("none")).alias("filled"))


@query(
    "safe_casts", "I16",
    sql="""WITH t AS (SELECT event_id, CASE event_type WHEN 'view' THEN '' WHEN 'error' THEN 'n/a' WHEN 'click' THEN '-4'
    ELSE value::VARCHAR END AS raw, event_type FROM events)
    SELECT event_id, try_cast(raw AS DOUBLE) AS number,
    CASE WHEN event_type = 'signup' OR event_type = 'purchase' THEN floor(try_cast(raw AS DOUBLE) + 0.5)::BIGINT END AS whole FROM t""",
)
def _(spark, d):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "view", "").when(kind == "error", "n/a").when(kind == "click", "-4")
        .otherwise(F.col("value").cast("string"))
    )
    return R.events(spark, d).select(
        "event_id", payload.safe_number(raw).alias("number"), payload.safe_unsigned(raw, 32).alias("whole")
    )


@query(
    "json_field_extract", "I17",
    sql="SELECT event_id, (props->>'$.k') AS text_k, (props->>'$.k')::BIGINT AS int_k, 0 AS missing FROM events",
)
def _(spark, d):
    p = F.col("props")
    return R.events(spark, d).select(
        "event_id", payload.field(p, "k").alias("text_k"), payload.int_field(p, "k").alias("int_k"),
        payload.int_field(p, "other").alias("missing"),
    )


@query("json_parse_struct", "I18", sql="SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def _(spark, d):
    return R.events(spark, d).select("event_id", payload.parse(F.col("props"), "k BIGINT")["k"].alias("k"))


@query(
    "json_write_struct", "I19",
    sql="""SELECT c_custkey, '{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}' AS doc FROM customer""",
)
def _(spark, d):
    doc = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")))
    return table(spark, d, "customer").select("c_custkey", doc.alias("doc"))


@query(
    "json_quote_repair", "I20",
    sql="SELECT event_id, event_id::VARCHAR AS id, event_type, user_id::VARCHAR AS user_id FROM events",
)
def _(spark, d):
    fields = F.struct(
        F.col("event_id").cast("string").alias("id"), "event_type", F.col("user_id").cast("string").alias("user_id")
    )
    broken = F.replace(F.to_json(fields), F.lit('","'), F.lit('""'))
    parsed = payload.parse(payload.repair_quotes(broken), "id STRING, event_type STRING, user_id STRING")
    return R.events(spark, d).select("event_id", parsed.alias("p")).select("event_id", "p.*")


@query("json_object_rebuild", "I21", sql="SELECT event_id, event_type, user_id FROM events")
def _(spark, d):
    pairs = F.concat(
        F.lit('  ("event_id":'), F.col("event_id").cast("string"), F.lit('\n"event_type":"'), F.col("event_type"),
        F.lit('"\n"user_id":'), F.col("user_id").cast("string"), F.lit(")  "),
    )
    parsed = payload.parse(payload.rebuild_object(pairs), "event_id BIGINT, event_type STRING, user_id BIGINT")
    return R.events(spark, d).select(parsed.alias("p")).select("p.*")


@query("nested_struct_access", "I22", "M3", sql="SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(spark, d):
    from lakeops.operators.retrieval import metadata_struct

    rows = metadata_struct(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])
    return rows.select("o_orderkey", "metadata.*")


@query(
    "array_functions", "I23",
    sql="""SELECT vec_id, round(list_max(embedding)::DOUBLE, 6) AS top, round(list_min(embedding)::DOUBLE, 6) AS low,
    len(list_filter(embedding, lambda x: x > 0)) AS positive FROM embeddings""",
)
def _(spark, d):
    e = F.col("embedding")
    return rounded(
        table(spark, d, "embeddings").select(
            "vec_id", F.array_max(e).cast("double").alias("top"), F.array_min(e).cast("double").alias("low"),
            F.size(F.filter(e, lambda x: x > 0)).alias("positive"),
        )
    )


@query("base64_decode", "I24", sql="SELECT doc_id, text AS decoded FROM documents")
def _(spark, d):
    coded = F.base64(F.col("text").cast("binary"))
    return table(spark, d, "documents").select("doc_id", payload.from_base64(coded).alias("decoded"))


@query(
    "conditional_chain", "I25",
    sql="""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_totalprice > 300000 THEN 'watch' ELSE 'open' END AS state FROM orders""",
)
def _(spark, d):
    state = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_totalprice") > 300000, "watch").otherwise("open")
    return table(spark, d, "orders").select("o_orderkey", state.alias("state"))


@query(
    "constant_expressions", "I26",
    sql="SELECT l_orderkey, l_linenumber, 11 - l_linenumber AS points, 0 AS offline_count, 2 * l_quantity + 3 * l_tax + 1 AS score FROM lineitem",
)
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.lit(11) - F.col("l_linenumber")).alias("points"), F.lit(0).alias("offline_count"),
        (2 * F.col("l_quantity") + 3 * F.col("l_tax") + 1).alias("score"),
    )


@query(
    "literal_map_lookup", "I27",
    sql="SELECT event_id, CASE event_type WHEN 'error' THEN 1.0::DOUBLE WHEN 'click' THEN 0.3::DOUBLE ELSE 0.6::DOUBLE END AS unit FROM events",
)
def _(spark, d):
    unit = cases.lookup(F.col("event_type"), {"error": 1.0, "click": 0.3}, 0.6)
    return R.events(spark, d).select("event_id", unit.alias("unit"))


# ---- geodesic ----

_GEO = f"""WITH {R.TELEMETRY_SQL}, g AS (SELECT *, 13.0::DOUBLE AS dlat, 77.8::DOUBLE AS dlon FROM tele)"""


def _depot(spark, d):
    return R.telemetry(spark, d).withColumns({"dlat": F.lit(13.0), "dlon": F.lit(77.8)})


_LEGS = ("lat", "lon", "dlat", "dlon")


@query(
    "haversine_to_depot", "J1", "I14",
    sql=_GEO + """SELECT event_id, round(2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(dlat - lat) / 2), 2)
    + cos(radians(lat)) * cos(radians(dlat)) * pow(sin(radians(dlon - lon) / 2), 2)))), 4) AS distance_m FROM g""",
)
def _(spark, d):
    legs = [F.col(c) for c in _LEGS]
    return rounded(_depot(spark, d).select("event_id", geo.haversine_m(*legs).alias("distance_m")), 4)


@query(
    "bearing_to_depot", "J2",
    sql=_GEO + """SELECT event_id, round(b - 360 * floor(b / 360), 4) AS bearing FROM (SELECT event_id, degrees(atan2(
    sin(radians(dlon - lon)) * cos(radians(dlat)),
    cos(radians(lat)) * sin(radians(dlat)) - sin(radians(lat)) * cos(radians(dlat)) * cos(radians(dlon - lon)))) + 360 AS b FROM g)""",
)
def _(spark, d):
    legs = [F.col(c) for c in _LEGS]
    return rounded(_depot(spark, d).select("event_id", geo.bearing_deg(*legs).alias("bearing")), 4)


@query(
    "interpolated_position", "J3",
    sql=_GEO + "SELECT event_id, round(lat + (dlat - lat) * 0.25, 6) AS lat, round(lon + (dlon - lon) * 0.25, 6) AS lon FROM g",
)
def _(spark, d):
    frac = F.lit(0.25)
    return rounded(
        _depot(spark, d).select(
            "event_id", geo.interpolate(F.col("lat"), F.col("dlat"), frac).alias("lat"),
            geo.interpolate(F.col("lon"), F.col("dlon"), frac).alias("lon"),
        )
    )


@query("distance_to_previous_point", "J4", "F4", sql=f"WITH {R.DELTA_SQL} SELECT event_id, round(delta_m, 4) AS delta_m FROM delta")
def _(spark, d):
    from lakeops.operators.windows import with_delta_m

    return rounded(with_delta_m(R.telemetry(spark, d), tie=["event_id"]).select("event_id", "delta_m"), 4)
