"""Streams: state over micro-batches, lateness, and equality with the batch form."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators.windows import with_delta_m
from lakeops.session import ROCKSDB, session_conf
from lakeops.sinks import streams as Z
from lakeops.sources.streams import stream_json
from lakeops.streaming import state
from lakeops.streaming import windows as K

STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def feed(spark, path, frames):
    """One file per frame, read one file per micro-batch."""
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def points(spark, data):
    df = spark.createDataFrame(data, "s long, vehicle_id string, trip_id string, lat double, lon double")
    return df.withColumn("event_time", F.timestamp_seconds("s"))


def run_append(spark, stream, fresh):
    out = fresh("out")
    with session_conf(spark, STATE):
        Z.stream_to_table(stream, out, fresh("mark"))
    return spark.read.parquet(out)


def moves(stream, idle=None):
    return state.stream_delta_m(stream.withWatermark("event_time", "5 seconds"), tie=["lon"], idle_seconds=idle)


END = (10**6, "end", "a", 0.0, 0.0)


def test_previous_row_crosses_micro_batches(spark, fresh):
    """Out of order inside the watermark, in several batches: every row is kept and placed as in a batch."""
    one = points(spark, [(3, "v", "a", 1.0, 3.0), (1, "v", "a", 1.0, 1.0), (2, "w", "b", 0.0, 0.0), (10, "v", "a", 1.0, 9.0)])
    two = points(spark, [(8, "v", "a", 1.0, 8.0), (11, "v", "a", 1.0, 5.0), (9, "w", "c", 0.0, 9.0), (11, "v", "a", 1.0, 4.0)])
    three = points(spark, [(12, "v", "a", 1.0, 2.0), (7, "w", "b", 0.0, 1.0)])
    with session_conf(spark, STATE):
        got = run_append(spark, moves(feed(spark, fresh("in"), [one, two, three, points(spark, [END])])), fresh)
    want = with_delta_m(one.unionByName(two).unionByName(three), tie=["lon"])
    key = lambda df: sorted((r.vehicle_id, r.s, r.lon, round(r.delta_m, 6)) for r in df.collect())
    assert key(got) == key(want)


def test_previous_row_keeps_every_type(spark, fresh):
    """Nulls, NaN, microseconds, nested values, odd names and a null key pass the state unchanged."""
    ddl = (
        "s long, k string, n long, d double, f float, b boolean, p decimal(20,4), y binary, t timestamp, u timestamp_ntz, "
        "a array<long>, m map<string,int>, c struct<x:timestamp,z:string>, `odd name` int"
    )
    big = 2**53 + 1
    full = (
        "CAST({s} AS LONG), {k}, {n}, {d}, CAST({d} AS FLOAT), true, CAST(1.2345 AS DECIMAL(20,4)), X'00FF', "
        "TIMESTAMP'2024-03-31 02:30:00.000001', TIMESTAMP_NTZ'0100-01-01 00:00:00.000001', array(1L, CAST(NULL AS LONG)), "
        "map('q', 1), struct(TIMESTAMP'2024-01-01 00:00:00.123456', ''), {s}"
    )
    empty = "CAST({s} AS LONG), {k}, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"
    told = [
        [full.format(s=1, k="'v'", n=big, d="double('NaN')"), empty.format(s=5, k="'v'"), full.format(s=2, k="NULL", n=1, d="0.1")],
        [full.format(s=3, k="'v'", n=-big, d="-0.5"), empty.format(s=4, k="NULL")],
        [empty.format(s=10**6, k="'end'")],
    ]
    schema = spark.createDataFrame([], ddl).schema

    def frame(parts):
        made = spark.sql(" UNION ALL ".join(f"SELECT {p}" for p in parts)).toDF(*schema.names)
        typed = made.select(*[F.col(f"`{x.name}`").cast(x.dataType).alias(x.name) for x in schema.fields])
        return typed.withColumn("event_time", F.timestamp_seconds("s") + F.expr("INTERVAL 1 MICROSECOND"))

    frames = [frame(p) for p in told]
    cols = [c for c in schema.names if c not in ("s", "k")]
    stream = feed(spark, fresh("in"), frames).withWatermark("event_time", "10 seconds")
    with session_conf(spark, STATE):
        got = run_append(spark, state.stream_with_previous(stream, "k", "event_time", cols, slots=2, block_rows=2), fresh)
    w = Window.partitionBy("k").orderBy("event_time")
    want = frames[0].unionByName(frames[1]).select("*", *[F.lag(F.struct(f"`{c}`")).over(w)[c].alias(f"prev_{c}") for c in cols])
    assert got.columns == want.columns
    assert [f.dataType for f in got.schema.fields] == [f.dataType for f in want.schema.fields]
    text = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct("*"), state.MICROS)).collect())
    assert text(got) == text(want)


def test_rows_without_a_time_are_left_out(spark, fresh):
    one = points(spark, [(1, "v", "a", 1.0, 1.0), (None, "v", "a", 1.0, 9.0), (2, "v", "a", 1.0, 2.0)])
    with session_conf(spark, STATE):
        got = run_append(spark, moves(feed(spark, fresh("in"), [one, points(spark, [END])])), fresh)
    assert sorted(r.s for r in got.collect()) == [1, 2]


def test_only_rows_behind_the_watermark_are_left_out(spark, fresh):
    one = points(spark, [(10, "v", "a", 1.0, 1.0)])
    two = points(spark, [(8, "v", "a", 1.0, 2.0), (20, "v", "a", 1.0, 1.0)])
    three = points(spark, [(4, "v", "a", 1.0, 9.0), (16, "v", "a", 1.0, 1.0)])
    with session_conf(spark, STATE):
        got = run_append(spark, moves(feed(spark, fresh("in"), [one, two, three, points(spark, [END])])), fresh)
    assert sorted(r.s for r in got.collect()) == [8, 10, 16, 20]


@pytest.mark.parametrize("idle,moved", [(None, True), (3600, True), (30, False)])
def test_idle_keys_are_forgotten(spark, fresh, idle, moved):
    parts = [[(10, "v", "a", 1.0, 1.0)], [(100, "w", "a", 1.0, 1.0)], [(200, "v", "a", 1.0, 2.0)], [END]]
    with session_conf(spark, STATE):
        stream = feed(spark, fresh("in"), [points(spark, p) for p in parts])
        got = run_append(spark, moves(stream, idle), fresh)
    assert (got.filter("s = 200").first().delta_m > 0) == moved


@pytest.fixture()
def ticks(spark):
    data = [(f"k{i % 3}" if i % 4 else "hot", i * 7 % 100, float(i % 13)) for i in range(400)]
    return spark.createDataFrame(data, "k string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))


def halves(df):
    return [df.filter("v < 6"), df.filter("v >= 6")]


def closing(spark, df):
    end = df.limit(1).withColumns({"k": F.lit("end"), "ts": F.timestamp_seconds(F.lit(10**6))})
    return [*halves(df), end.select(*df.columns)]


def timed(stream):
    return stream.withWatermark("ts", "200 seconds")


def test_hop_stream_equals_panes(spark, ticks, fresh):
    sums = lambda: {"n": F.lit(1), "total": F.col("v")}
    stream = timed(feed(spark, fresh("in"), closing(spark, ticks)))
    got = run_append(spark, K.hop(stream, "ts", "15 seconds", "5 seconds", "k", sums()), fresh)
    assert rows(got) == rows(K.hop(ticks, "ts", "15 seconds", "5 seconds", "k", sums()))


@pytest.mark.parametrize("gap", [1, 3, 7, 50])
def test_session_stream_equals_batch(spark, ticks, fresh, gap):
    aggs = lambda: {"n": ("sum", F.lit(1)), "top": ("max", F.col("v"))}
    stream = timed(feed(spark, fresh("in"), closing(spark, ticks)))
    got = run_append(spark, K.session(stream, "ts", gap, "k", aggs()), fresh)
    assert rows(got) == rows(K.session(ticks, "ts", gap, "k", aggs()))


def test_session_pieces_join_over_chunks(spark, ticks):
    aggs = lambda: {"n": ("sum", F.lit(1))}
    small = F.date_trunc("minute", "ts")
    assert rows(K.session(ticks, "ts", 3, "k", aggs(), small)) == rows(K.session(ticks, "ts", 3, "k", aggs()))


def test_watermark_drops_late_window(spark, fresh):
    make = lambda s: spark.createDataFrame([(x,) for x in s], "s long").withColumn("ts", F.timestamp_seconds("s"))
    stream = feed(spark, fresh("in"), [make([5, 100]), make([200]), make([6, 201])])
    timed = K.with_event_time(stream, "ts", "event_time", lateness="10 seconds")
    out = fresh("out")
    with session_conf(spark, STATE):
        Z.stream_to_table(K.tumble(timed, "event_time", "10 seconds", [], {"n": F.count(F.lit(1))}), out, fresh("mark"))
    got = {(int(r.window_start.timestamp()), r.n) for r in spark.read.parquet(out).collect()}
    assert (0, 1) in got and (100, 1) in got  # the late row 6 is not counted


def test_bad_messages_do_not_stop_the_stream(spark, fresh):
    src = fresh("in")
    spark.createDataFrame([('{"a": 1}',), ("oops",), ('{"a": 2}',)], "value string").write.text(src)
    assert rows(run_append(spark, stream_json(spark, src, "a INT"), fresh)) == [(1,), (2,)]


def test_route_to_every_matching_target(spark, fresh):
    stream = feed(spark, fresh("in"), [spark.range(5), spark.range(5, 10)])
    root = fresh("routes")
    Z.route_stream(stream, {"small": F.col("id") < 3, "even": F.col("id") % 2 == 0}, root, fresh("mark"))
    assert spark.read.parquet(f"{root}/small").count() == 3 and spark.read.parquet(f"{root}/even").count() == 5


def test_rebase_first_row_is_the_anchor(spark):
    df = spark.createDataFrame([(1, "01/02/2013 10:00", "01/02/2013 10:30"), (2, "01/02/2013 10:05", "bad")], "i int, p string, d string")
    got = K.rebase_times(df, ["p", "d"], "i", F.lit("2024-01-01 00:00:00")).orderBy("i").collect()
    assert (got[0].p, got[0].d) == ("2024-01-01T00:00:00", "2024-01-01T00:30:00")
    assert (got[1].p, got[1].d) == ("2024-01-01T00:05:00", None)


def test_latest_start_passes_over_the_backlog(spark, fresh):
    import time

    src = fresh("in")
    write = lambda n: spark.createDataFrame([(f'{{"a": {n}}}',)], "value string").coalesce(1).write.mode("append").text(src)
    write(1)
    time.sleep(1.5)
    since = spark.sql("SELECT string(current_timestamp())").first()[0]
    time.sleep(1.5)
    write(2)
    assert rows(run_append(spark, stream_json(spark, src, "a INT", starting=since), fresh)) == [(2,)]
    late = {"starting": "latest", "start_kept_at": fresh("start")}
    assert rows(run_append(spark, stream_json(spark, src, "a INT", **late), fresh)) == []
    assert rows(run_append(spark, stream_json(spark, src, "a INT"), fresh)) == [(1,), (2,)]


def test_latest_start_survives_a_restart(spark, fresh):
    src, out, mark = fresh("in"), fresh("out"), fresh("mark")
    late = {"starting": "latest", "start_kept_at": fresh("start")}
    write = lambda n: spark.createDataFrame([(f'{{"a": {n}}}',)], "value string").coalesce(1).write.mode("append").text(src)
    write(1)
    for n in (2, 3, 4):
        Z.stream_to_table(stream_json(spark, src, "a INT", **late), out, mark)
        write(n)
    Z.stream_to_table(stream_json(spark, src, "a INT", **late), out, mark)
    assert rows(spark.read.parquet(out)) == [(2,), (3,), (4,)]
    with pytest.raises(ValueError):
        stream_json(spark, src, "a INT", starting="latest")


def test_outside_sink_replaces_a_replayed_batch(spark, fresh):
    """A row store that can delete by batch: here a folder per batch."""
    out, seen = fresh("out"), []
    stream = feed(spark, fresh("in"), [spark.range(3), spark.range(3, 5)])
    Z.row_sink(stream, "unused", fresh("mark"), fmt="json", options={"path": out}, clear=seen.append)
    assert seen == [0, 1] and {(r["_batch"], r.id) for r in spark.read.json(out).collect()} == {(0, 0), (0, 1), (0, 2), (1, 3), (1, 4)}


def test_hot_key_with_a_short_gap(spark):
    """A key with a third of the rows and a one-second gap: many pieces, joined across chunks and days."""
    df = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "timestamp_seconds(1700000000 + (id * 37) % 200000) AS ts", "id AS v"
    )
    aggs = {"n": ("sum", F.lit(1)), "top": ("max", F.col("v"))}
    got = {(r.k, r.window_start): (r.window_end, r.n, r.top) for r in K.session(df, "ts", 1, "k", aggs).collect()}
    want = {}
    last = {}
    for r in sorted(df.collect(), key=lambda r: (r.k, r.ts)):
        if r.k not in last or (r.ts - last[r.k][0]).total_seconds() > 1:
            last[r.k] = [r.ts, r.ts, 0, -1]
            want[r.k, r.ts] = last[r.k]
        last[r.k][0] = r.ts
        last[r.k][2] += 1
        last[r.k][3] = max(last[r.k][3], r.v)
    assert {k: (v[1], v[2]) for k, v in got.items()} == {k: (v[2], v[3]) for k, v in want.items()}


def test_sliding_windows_keep_a_list_per_block(spark, fresh):
    data = [(k, t + 0.25, 1.0 + t) for k in ("a", None) for t in (0, 1, 2, 14, 15, 29, 40, 40, 59, 60, 61, 75, 130) for _ in range(2)]
    ticks = spark.createDataFrame([(k, s, v) for k, s, v in data], "k string, s double, v double")
    ticks = ticks.select("k", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")).alias("ts"), F.when(F.col("s") != 14.25, F.col("v")).alias("v"))
    far = ticks.limit(1).withColumn("ts", F.timestamp_seconds(F.lit(5000)))
    some = {"n": F.count("v"), "v": F.col("v"), "d": F.col("v").cast("decimal(10,2)")}
    some["n"] = F.col("v").isNotNull().cast("int")
    stream = feed(spark, fresh("feed"), [ticks.filter("ts < '1970-01-01 00:00:30'"), ticks.filter("ts >= '1970-01-01 00:00:30'"), far])
    got = run_append(spark, K.hop(stream.withWatermark("ts", "1 minute"), "ts", "15 seconds", "1 second", "k", some), fresh)
    want = K.hop(ticks, "ts", "15 seconds", "1 second", "k", some)
    assert got.schema["d"].dataType == want.schema["d"].dataType and rows(got) == rows(want)

    early, late = ticks.filter("ts < '1970-01-01 00:00:03'"), ticks.filter("ts = '1970-01-01 00:00:40.25'")
    mark = fresh("mark")
    stream = feed(spark, fresh("feed"), [early, late]).withWatermark("ts", "1 second")
    with session_conf(spark, STATE):
        Z.stream_to_table(K.hop(stream, "ts", "15 seconds", "1 second", "k", some), fresh("out"), mark)
    held = [spark.read.format("statestore").option("operatorId", i).load(mark).count() for i in (0, 1)]
    assert sorted(held) == [2, 2]  # the pane of each key, and its block; before, a row per window
