"""Joins.  Every join has an equality key; time bounds become bucket equality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.ordered import fill_backward, fill_forward, names, time_chunk
from lakeops.operators.topk import latest_by_key


def star_join(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, dict[str, str], Sequence[str]]], how: str = "inner"
) -> DataFrame:
    """Join dimension tables to a fact.

    Each dimension is (frame, {fact key: dimension key}, columns to bring).  No
    broadcast is forced: small dimensions are broadcast by their measured size,
    large ones are shuffled and a hot fact key is split at run time.
    """
    out = fact
    for i, (dim, on, cols) in enumerate(dims):
        keys = {f"_d{i}_{n}": k for n, k in enumerate(on.values())}
        side = dim.select(*[F.col(k).alias(a) for a, k in keys.items()], *cols)
        cond = None
        for fact_key, alias in zip(on, keys):
            test = F.col(fact_key) == F.col(alias)
            cond = test if cond is None else cond & test
        out = out.join(side, cond, how).drop(*keys)
    return out


def left_enrich(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left outer equi join: rows without a partner keep nulls."""
    return left.join(right, names(on), "left")


def keep_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys, names(on), "left_semi")


def keep_not_in(df: DataFrame, keys: DataFrame, on: str, null_aware: bool = True) -> DataFrame:
    """Rows whose key does not occur in ``keys``.

    ``null_aware`` follows SQL ``NOT IN``: a null among the keys leaves nothing,
    and a null key on the left is kept only when ``keys`` is empty.  The rule is
    written as an ordinary anti join plus two scalar checks, so a large key
    table is shuffled rather than broadcast whole.
    """
    anti = df.join(keys.select(on), on, "left_anti")
    if not null_aware:
        return anti
    facts = keys.agg(
        F.coalesce(F.max(F.col(on).isNull().cast("int")), F.lit(0)).alias("has_null"),
        F.count(F.lit(1)).alias("n"),
    )
    no_null = facts.select("has_null").scalar() == 0
    empty = facts.select("n").scalar() == 0
    return anti.filter(no_null & (F.col(on).isNotNull() | empty))


def pair_within(
    df: DataFrame,
    key: str,
    ts: str,
    is_start: Column,
    is_end: Column,
    max_gap_seconds: int,
    carry: Sequence[str] = (),
    first_only: bool = False,
) -> DataFrame:
    """Start rows with every later end row of the same key less than ``max_gap_seconds`` after.

    Starts and ends meet by (key, time bucket of the gap's width); a start looks
    into its own bucket and the next one.  A key with a large share of the rows
    is thereby spread over all its buckets and only rows near in time are
    compared.  ``first_only`` keeps the nearest end per start, without making the pairs.
    """
    if first_only:
        return nearest_within(df, key, ts, is_start, is_end, max_gap_seconds, carry)
    width = max_gap_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    bucket = F.floor(micros / width).cast("long")
    cols = [c for c in carry if c not in (key, ts)]
    starts = df.filter(is_start).select(
        F.col(key),
        F.col(ts).alias("start_ts"),
        *[F.col(c).alias(f"start_{c}") for c in cols],
        F.explode(F.array(bucket, bucket + 1)).alias("_b"),
    )
    ends = df.filter(is_end).select(
        F.col(key), F.col(ts).alias("end_ts"), *[F.col(c).alias(f"end_{c}") for c in cols], bucket.alias("_b")
    )
    gap = F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))
    pairs = (
        starts.join(ends, [key, "_b"])
        .drop("_b")
        .filter((gap > 0) & (gap < width))
        .withColumn("break_seconds", F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts")))
    )
    return pairs


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    ts: str,
    cols: Sequence[str],
    forward: bool = False,
    strict: bool = False,
    right_ts: str | None = None,
    chunk: Column | str | None = None,
    count: int | None = None,
) -> DataFrame:
    """Each row of ``left`` with ``cols`` of the nearest row of ``right`` of its key.

    Nearest means the last at or before ``ts``; with ``forward`` the first at or after it, and with
    ``strict`` equal times do not count.  Of rows at one time the smallest ``cols`` win.
    ``right_ts`` names the output column of the matched time; columns are null where
    nothing matches, as where the key or the time is.  Both sides are laid into one
    order and the value is carried along it from cell to cell, so there are as many rows
    as both sides have, never pairs, and a hot key is spread over its cells.  ``count``, about
    the rows of both sides, bounds what one task sorts, see :func:`fill_forward`.
    """
    by, kind = names(key), left.schema[ts].dataType
    found = F.struct(F.col(ts).alias("t"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(cols)))
    own = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    # what may match at an equal time lies behind the row when looking forward, before it when looking back
    after = forward != strict
    events = (
        right.dropna(subset=[*by, ts]).select(*by, F.col(ts).cast(kind).alias("_t"), found.alias("_match"))
        .groupBy(*by, "_t").agg(F.min("_match").alias("_match")).withColumn("_side", F.lit(1 if after else 0))
    )
    rows = left.select(*by, F.col(ts).alias("_t"), F.lit(0 if after else 1).alias("_side"), own.alias("_row"))
    both = events.unionByName(rows, allowMissingColumns=True)
    if chunk is None and isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        chunk = time_chunk("_t", "month" if isinstance(kind, T.DateType) else "hour")
    fill = fill_backward if forward else fill_forward
    filled = fill(both, by, ["_t", "_side"], ["_match"], chunk, count).where("_row IS NOT NULL")
    known = F.col("_t").isNotNull()
    for b in by:
        known = known & F.col(b).isNotNull()
    match = F.when(known, F.col("_match"))
    out = [match[f"c{i}"].alias(c) for i, c in enumerate(cols)]
    return filled.select("_row.*", *([match["t"].alias(right_ts)] if right_ts else []), *out)


def nearest_within(
    df: DataFrame, key: str, ts: str, is_start: Column, is_end: Column, max_gap_seconds: int, carry: Sequence[str] = ()
) -> DataFrame:
    """Each start row with the first end row of its key later than it and less than the gap away."""
    cols = [c for c in carry if c not in (key, ts)]
    starts = df.filter(is_start & F.col(key).isNotNull()).select(key, ts, *[F.col(c).alias(f"start_{c}") for c in cols])
    ends = df.filter(is_end).select(key, ts, *[F.col(c).alias(f"end_{c}") for c in cols])
    near = asof_join(starts, ends, key, ts, [f"end_{c}" for c in cols], forward=True, strict=True, right_ts="end_ts")
    near = near.withColumnRenamed(ts, "start_ts")
    gap = F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))
    seconds = F.timestamp_diff("SECOND", F.col("start_ts"), F.col("end_ts"))
    return near.filter(gap < max_gap_seconds * 1_000_000).withColumn("break_seconds", seconds)


def explode_join(df: DataFrame, array_col: str) -> DataFrame:
    """Each row once per array element (struct fields become columns); empty arrays keep the row."""
    out = df.withColumn("_e", F.explode_outer(array_col)).drop(array_col)
    kind = out.schema["_e"].dataType
    if hasattr(kind, "fieldNames"):
        taken = set(out.columns)
        fields = [
            F.col(f"_e.{f}").alias(f if f not in taken else f"{array_col}_{f}") for f in kind.fieldNames()
        ]
        return out.select("*", *fields).drop("_e")
    return out.withColumnRenamed("_e", array_col)


def enrich_latest(
    df: DataFrame, events: DataFrame, key: str, ts: str, cols: Sequence[str] | None = None
) -> DataFrame:
    """Left join with the newest event row of each key."""
    cols = list(cols) if cols else [c for c in events.columns if c not in (key, ts)]
    newest = latest_by_key(events.select(key, ts, *cols), [key], ts)
    return df.join(newest, key, "left")


def range_to_points(
    ranges: DataFrame, start: str, end: str, out: str, step: str = "1 day"
) -> DataFrame:
    """One row per step of each validity range (a range join against a date spine without the join)."""
    steps = F.sequence(F.col(start), F.col(end), F.expr(f"interval {step}"))
    return ranges.filter(F.col(start) <= F.col(end)).withColumn(out, F.explode(steps))

