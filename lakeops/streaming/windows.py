"""Event-time operators.  Each works on a batch frame and on a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.cases import indicator
from lakeops.functions.times import text_seconds_between
from lakeops.operators.joins import pair_within
from lakeops.operators.ordered import names, running, time_chunk
from lakeops.session import materialise
from lakeops.sinks.streams import for_each_batch, stream_to_table
from lakeops.sinks.tables import read_batches, read_upserted, rows_of_keys, store_batch, upsert_batch


def with_event_time(
    df: DataFrame, col: str, out: str = "event_time", fallback: bool = False, lateness: str = "5 seconds"
) -> DataFrame:
    """Event time (optionally falling back to the clock) with a watermark on streams."""
    ts = F.col(col).cast("timestamp")
    if fallback:
        ts = F.coalesce(ts, F.current_timestamp())
    timed = df.withColumn(out, ts)
    return timed.withWatermark(out, lateness) if df.isStreaming else timed


def _window_bounds(df: DataFrame, keys: Sequence[str], rest: Sequence[str]) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *rest
    )


def tumble(df: DataFrame, ts: str, size: str, keys: str | Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates per fixed window and key."""
    keys = names(keys)
    out = df.groupBy(F.window(ts, size), *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return _window_bounds(out, keys, list(aggs))


def hop(
    df: DataFrame, ts: str, size: str, slide: str, keys: str | Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Sums per sliding window and key.

    Rows are first summed per slide-wide pane, and only the panes are copied to the
    windows that hold them; copying the rows themselves would multiply the input by
    size/slide.  On a stream both steps keep state until the watermark closes them,
    so results come once per window, in append mode.  There the second state is a list of
    panes per key and block of windows, not a row per window, and the windows of a block
    leave together when its last one is closed.
    """
    keys = names(keys)
    panes = df.groupBy(F.window(ts, slide).alias("_pane"), *keys).agg(
        *[F.sum(s).alias(n) for n, s in sums.items()]
    )
    start = F.window_time("_pane") if df.isStreaming else F.col("_pane.start")
    if df.isStreaming and isinstance(df.schema[ts].dataType, T.TimestampType):
        wide, step = (_micros(df.sparkSession, x) for x in (size, slide))
        if wide % step == 0:
            return _hop_blocks(panes.select(start.alias("_at"), "_pane.start", *keys, *sums), wide, step, keys, list(sums))
    at = panes.select(start.alias("_at"), *keys, *sums)
    out = at.groupBy(F.window("_at", size, slide), *keys).agg(*[F.sum(n).alias(n) for n in sums])
    return _window_bounds(out, keys, list(sums))


WINDOWS_LONG = 4  # a block of windows is as long as this many windows


def _micros(spark: SparkSession, length: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL '{length}')").first()[0]


def _hop_blocks(panes: DataFrame, size: int, slide: int, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sums per sliding window from a stream of panes (``_at``, ``start``), in microseconds.

    A block holds the windows that start in it; its panes reach on to the end of the last one and
    are one per slide at most, so the list of a key and block is bounded by the two lengths.
    """
    block = size * WINDOWS_LONG
    kind = {f.name: f.dataType for f in panes.groupBy().agg(*[F.sum(n).alias(n) for n in sums]).schema.fields}
    pane = F.struct(F.unix_micros("start").alias("_p"), *sums)
    over = F.window("_at", f"{block + size - slide} microseconds", f"{block} microseconds")
    held = panes.groupBy(over, *keys).agg(F.collect_list(pane).alias("_panes"))
    first = F.unix_micros("window.start")

    def summed(start: Column) -> Column:
        inside = F.filter("_panes", lambda p: (p["_p"] >= start) & (p["_p"] < start + size))
        add = lambda n: lambda a, p: F.coalesce(a + p[n].cast(kind[n]), a, p[n].cast(kind[n])).cast(kind[n])
        return F.struct(start.alias("_s"), *[F.aggregate(inside, F.lit(None).cast(kind[n]), add(n)).alias(n) for n in sums])

    starts = F.flatten(F.transform("_panes", lambda p: F.sequence(p["_p"] - (size - slide), p["_p"], F.lit(slide))))
    own = F.filter(F.array_distinct(starts), lambda s: (s >= first) & (s < first + block))
    each = held.select(*keys, F.explode(F.transform(own, summed)).alias("_w"))
    return each.select(
        F.timestamp_micros("_w._s").alias("window_start"), F.timestamp_micros(F.col("_w._s") + size).alias("window_end"),
        *keys, *[F.col(f"_w.`{n}`").alias(n) for n in sums],
    )


# Weights of the driving-behaviour score.
BEHAVIOUR_WEIGHTS = {"overspeed": 2.0, "harsh_brake": 3.0, "idling": 1.0}


def behaviour_score(
    df: DataFrame,
    ts: str = "event_time",
    key: str = "vehicle_id",
    kind: str = "alert_type",
    size: str = "15 seconds",
    slide: str = "1 second",
) -> DataFrame:
    """Weighted count of alert kinds per vehicle and sliding window."""
    sums = {f"_n_{v}": indicator(F.col(kind) == v) for v in BEHAVIOUR_WEIGHTS}
    out = hop(df, ts, size, slide, key, sums)
    score = sum((F.col(f"_n_{v}") * F.lit(w) for v, w in BEHAVIOUR_WEIGHTS.items()), F.lit(0.0))
    return out.withColumn("score", score).drop(*sums)


def utilisation(
    df: DataFrame,
    ts: str = "event_time",
    speed: str = "speed_kmph",
    limit: float = 5.0,
    size: str = "5 seconds",
    slide: str = "1 second",
) -> DataFrame:
    """Active and idle event counts per sliding window; offline is always 0."""
    sums = {
        "active_count": indicator(F.col(speed) > limit),
        "idle_count": indicator(F.col(speed) <= limit),
    }
    return hop(df, ts, size, slide, [], sums).withColumn("offline_count", F.lit(0).cast("bigint"))


def temperature_alerts(
    df: DataFrame,
    ts: str = "event_time",
    key: str = "vehicle_id",
    temp: str = "engine_temp_c",
    limit: float = 90.0,
    size: str = "1 minute",
) -> DataFrame:
    """One alert per vehicle and minute with readings above the limit."""
    hot = df.filter(F.col(temp) > limit)
    aggs = {
        "details": F.concat(F.lit("temp="), F.max(temp).cast("string")),
        "time_stamp": F.max(ts),
    }
    out = tumble(hot, ts, size, key, aggs)
    return out.withColumn("alert_type", F.lit("high_engine_temp"))


def threshold_alerts(df: DataFrame, col: str, limit: float) -> DataFrame:
    """Rows above a limit; stateless."""
    return df.filter(F.col(col) > limit)


def trip_window_summary(
    df: DataFrame, size: str = "20 seconds", ts: str = "event_time", key: str = "vehicle_id"
) -> DataFrame:
    """Trip summary per vehicle and fixed window."""
    aggs = {
        "trip_start": F.date_format(F.min(ts), "yyyy-MM-dd HH:mm:ss"),
        "trip_end": F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss"),
        "trip_duration_sec": F.timestamp_diff("SECOND", F.min(ts), F.max(ts)),
        "event_count": F.count(F.lit(1)),
        "distance_m": F.sum("delta_m"),
        "distance_km": F.sum("delta_m") / 1000.0,
        "avg_speed": F.avg("speed_kmph"),
        "max_speed": F.max("speed_kmph"),
        "min_speed": F.min("speed_kmph"),
    }
    return tumble(df, ts, size, key, aggs)


def trip_window_metrics(
    df: DataFrame,
    size: str = "1 minute",
    ts: str = "event_time",
    keys: Sequence[str] = ("trip_id", "vehicle_id", "driver_id"),
) -> DataFrame:
    """Live distance and average speed per trip, vehicle, driver and window."""
    aggs = {
        "distance_m": F.sum("delta_m"),
        "avg_speed": F.avg("speed_kmph"),
        "event_count": F.count(F.lit(1)),
    }
    return tumble(df, ts, size, keys, aggs)


# Parts of a trip summary that can be merged, and how.
_TRIP_PARTS = {
    "_start": (F.min, "event_time"), "_end": (F.max, "event_time"), "_n": (F.count, "event_time"),
    "_distance": (F.sum, "delta_m"), "_speeds": (F.sum, "speed_kmph"), "_timed": (F.count, "speed_kmph"),
    "_slowest": (F.min, "speed_kmph"), "_fastest": (F.max, "speed_kmph"),
}


def running_trip_summary(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("trip_id", "vehicle_id", "driver_id"),
) -> None:
    """Keep a trip summary up to date from a stream of moves.

    Each micro-batch is folded to one mergeable row per trip and stored under its batch id, so a
    replayed batch replaces itself and no trip stays in streaming state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = batch.groupBy(*keys).agg(*[fold(c).alias(n) for n, (fold, c) in _TRIP_PARTS.items()])
        store_batch(parts, path, batch_id)

    for_each_batch(stream, write, checkpoint)


def read_trip_summary(
    spark: SparkSession, path: str, keys: Sequence[str] = ("trip_id", "vehicle_id", "driver_id")
) -> DataFrame:
    """The summaries as of the last stored batch."""
    whole = read_batches(spark, path).groupBy(*keys).agg(*_merged_parts())
    return whole.select(*keys, *_summary_columns())


def _merged_parts() -> list[Column]:
    merge = {F.min: F.min, F.max: F.max, F.count: F.sum, F.sum: F.sum}
    return [merge[fold](n).alias(n) for n, (fold, _) in _TRIP_PARTS.items()]


def _summary_columns(at: str = "") -> list[Column]:
    """The columns of a summary from its parts, which may stand in a struct."""
    part = {n: F.col(f"{at}{n}") for n in _TRIP_PARTS}
    fmt = "yyyy-MM-dd HH:mm:ss"
    return [
        F.date_format(part["_start"], fmt).alias("trip_start"),
        F.date_format(part["_end"], fmt).alias("trip_end"),
        text_seconds_between(part["_start"], part["_end"], fmt).alias("trip_duration_sec"),
        part["_n"].alias("event_count"),
        part["_distance"].alias("distance_m"),
        (part["_distance"] / 1000.0).alias("distance_km"),
        (part["_speeds"] / part["_timed"]).alias("avg_speed"),
        part["_slowest"].alias("min_speed"),
        part["_fastest"].alias("max_speed"),
    ]


def apply_trip_batch(
    batch: DataFrame, table: str, batch_id: int, keys: Sequence[str] = ("trip_id", "vehicle_id", "driver_id")
) -> DataFrame:
    """Merge one micro-batch of moves into a keyed table of trips and return what changed.

    One row per trip of the batch: ``batch``, ``change`` (I for a new trip, else U), the new summary,
    and ``before``, the summary it replaces.  A trip keeps the parts it had before its last batch, so
    a replayed batch merges into those and returns the same rows.  Only the buckets of the batch's
    trips are read, and only their rows written.
    """
    spark, names_of_parts = batch.sparkSession, list(_TRIP_PARTS)
    fresh = batch.groupBy(*keys).agg(*[fold(c).alias(n) for n, (fold, c) in _TRIP_PARTS.items()])
    here = materialise(fresh, "trip-parts")
    was = F.struct(*names_of_parts)
    both = here.withColumn("_was", F.when(F.lit(False), was))
    if spark.catalog.tableExists(table):
        held = rows_of_keys(spark, table, here)
        prior = F.when(F.col("_batch") < batch_id, was).otherwise(F.col("_was"))
        earlier = held.select(*keys, prior.alias("_was")).filter(F.col("_was").isNotNull())
        both = both.unionByName(earlier.select(*keys, "_was.*", "_was"))
    merged = both.groupBy(*keys).agg(*_merged_parts(), F.max("_was").alias("_was"))
    changed = materialise(merged.withColumn("_batch", F.lit(int(batch_id)).cast("bigint")), "trip-changes")
    upsert_batch(changed, table, keys, "_batch")
    return changed.select(
        F.col("_batch").alias("batch"),
        F.when(F.col("_was").isNull(), "I").otherwise("U").alias("change"),
        *keys,
        *_summary_columns(),
        F.when(F.col("_was").isNotNull(), F.struct(*_summary_columns("_was."))).alias("before"),
    )


def trip_change_stream(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    emit: Callable[[DataFrame, int], None],
    keys: Sequence[str] = ("trip_id", "vehicle_id", "driver_id"),
) -> None:
    """Send each trip again whenever a micro-batch changes it: ``emit(changes, batch_id)``.

    ``emit`` is called again with the same rows when a batch is replayed.
    """
    for_each_batch(stream, lambda batch, n: emit(apply_trip_batch(batch, table, n, keys), n), checkpoint)


def read_trips(
    spark: SparkSession, table: str, keys: Sequence[str] = ("trip_id", "vehicle_id", "driver_id")
) -> DataFrame:
    """The summaries in a table kept by :func:`apply_trip_batch`."""
    return read_upserted(spark, table).select(*keys, *_summary_columns())


def session(
    df: DataFrame,
    ts: str,
    gap_seconds: int,
    keys: str | Sequence[str],
    aggs: dict[str, tuple[str, Column]],
    chunk: Column | str | None = None,
) -> DataFrame:
    """Aggregates per session: rows of a key at most ``gap_seconds`` apart.

    ``aggs`` gives each output as ("sum" | "min" | "max", expression).  A stream
    uses the built-in session window.  A batch frame is first folded to session
    pieces inside each (key, chunk).  A piece ends with a pause or at a chunk
    border, so a key has at most (time span / gap) + (time span / chunk) pieces
    however many rows it has.  The pieces are joined by running folds that are
    themselves cut by day, so no task orders all pieces of a key.
    """
    keys = names(keys)
    folds = {"sum": F.sum, "min": F.min, "max": F.max}
    if df.isStreaming:
        measures = [folds[kind](c).alias(n) for n, (kind, c) in aggs.items()]
        out = df.groupBy(F.session_window(ts, f"{gap_seconds} seconds").alias("window"), *keys).agg(*measures)
        return _window_bounds(out, keys, list(aggs))
    limit = gap_seconds * 1_000_000
    cut = df.select(
        *keys,
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"),
        F.col(ts).alias("_ts"),
        *[c.alias(n) for n, (_, c) in aggs.items()],
        (time_chunk(ts) if chunk is None else chunk).alias("_part"),
    )
    w = Window.partitionBy(*keys, "_part").orderBy("_us")
    fresh = indicator(F.col("_us") - F.lag("_us").over(w) > limit)
    local = cut.withColumn("_fresh", fresh).withColumn("_piece", F.sum("_fresh").over(w))
    pieces = local.groupBy(*keys, "_part", "_piece").agg(
        F.min("_us").alias("_from"), F.max("_us").alias("_to"), F.min("_ts").alias("_start"), F.max("_ts").alias("_last"),
        *[folds[kind](n).alias(n) for n, (kind, _) in aggs.items()],
    )
    day = F.date_trunc("day", F.col("_start"))
    before = running(pieces, keys, ["_from"], {"_before": F.col("_to")}, "max", day, inclusive=False)
    start = indicator(F.coalesce(F.col("_from") - F.col("_before") > limit, F.lit(True)))
    flagged = before.withColumn("_start_flag", start)
    numbered = running(flagged, keys, ["_from"], {"_session": F.col("_start_flag")}, "sum", day)
    out = numbered.groupBy(*keys, "_session").agg(
        F.min("_start").alias("window_start"),
        (F.max("_last") + F.expr(f"interval {gap_seconds} seconds")).alias("window_end"),
        *[folds[kind](n).alias(n) for n, (kind, _) in aggs.items()],
    )
    return out.select("window_start", "window_end", *keys, *aggs)


def stream_dedup(stream: DataFrame, keys: str | Sequence[str], ts: str, lateness: str = "10 seconds") -> DataFrame:
    """First of the rows with equal keys that arrive within the watermark."""
    if not stream.isStreaming:
        return stream.dropDuplicates(names(keys))
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(names(keys))


def pair_stream(
    stream: DataFrame,
    key: str,
    ts: str,
    is_start: Column,
    is_end: Column,
    max_gap_seconds: int,
    carry: Sequence[str] = (),
    lateness: str = "5 seconds",
) -> DataFrame:
    """Interval self-join of a stream: the time bound lets old state be dropped."""
    if not stream.isStreaming:
        return pair_within(stream, key, ts, is_start, is_end, max_gap_seconds, carry)
    cols = [c for c in carry if c not in (key, ts)]

    def side(cond: Column, name: str) -> DataFrame:
        return (
            stream.filter(cond)
            .select(F.col(key).alias(f"{name}_key"), F.col(ts).alias(f"{name}_ts"),
                    *[F.col(c).alias(f"{name}_{c}") for c in cols])
            .withWatermark(f"{name}_ts", lateness)
        )

    s, e = side(is_start, "start"), side(is_end, "end")
    bound = F.expr(f"interval {max_gap_seconds} seconds")
    on = (
        (F.col("start_key") == F.col("end_key"))
        & (F.col("end_ts") > F.col("start_ts"))
        & (F.col("end_ts") < F.col("start_ts") + bound)
    )
    out = s.join(e, on).withColumn("break_seconds", F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts")))
    return out.drop("end_key").withColumnRenamed("start_key", key)


def continuous_view(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, timeout: int | None = None
) -> None:
    """Raw lines through a transform into a table: one streaming query instead of a trigger per topic."""
    stream_to_table(transform(source), target, checkpoint, timeout=timeout)


def rebase_times(
    df: DataFrame,
    cols: Sequence[str],
    order: str,
    anchor: Column | None = None,
    in_fmt: str = "MM/dd/yyyy HH:mm",
    out_fmt: str = "yyyy-MM-dd'T'HH:mm:ss",
) -> DataFrame:
    """Shift all times so that the first row's first column equals ``anchor`` (now by default)."""
    anchor = F.current_timestamp() if anchor is None else anchor
    parsed = {c: F.unix_timestamp(F.try_to_timestamp(c, F.lit(in_fmt))) for c in cols}
    first = df.agg(F.min_by(parsed[cols[0]], F.col(order))).scalar()
    offset = F.unix_timestamp(anchor.cast("timestamp")) - first
    return df.withColumns(
        {c: F.date_format(F.timestamp_seconds(parsed[c] + offset), out_fmt) for c in cols}
    )
