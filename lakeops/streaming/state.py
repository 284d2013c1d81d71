"""Keyed state over streams: the previous row of each key, in event-time order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeops.operators.windows import delta_expr

PLAIN = (T.NumericType, T.BooleanType, T.TimestampType)  # DecimalType, a NumericType, travels as objects
TEXTS = (T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType)
NESTED = (T.ArrayType, T.MapType, T.StructType)
MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
AT, SLOT = "_at", "_slot"


def _has_flag(t: T.DataType) -> bool:
    return isinstance(t, PLAIN) and not isinstance(t, T.DecimalType)


def _packed_type(t: T.DataType) -> T.DataType:
    if isinstance(t, T.TimestampType):
        return T.LongType()
    return T.StringType() if isinstance(t, (*TEXTS, *NESTED)) else t


def _pack(name: str, t: T.DataType) -> list[Column]:
    """A column in a form that keeps its values in data frames: no nulls among numbers, no clock times."""
    c = F.col(f"`{name}`")
    if isinstance(t, NESTED):
        return [F.to_json(c, MICROS).alias(name)]
    if isinstance(t, TEXTS):
        return [c.cast("string").alias(name)]
    if not _has_flag(t):
        return [c.alias(name)]
    value = F.unix_micros(c) if isinstance(t, T.TimestampType) else c
    return [F.coalesce(value, F.lit(0).cast(_packed_type(t))).alias(name), c.isNotNull().alias(f"_there_{name}")]


def _unpack(name: str, t: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(t, NESTED):
        back = F.from_json(c, t.json() if isinstance(t, T.StructType) else t.simpleString(), MICROS)
    elif isinstance(t, TEXTS):
        back = c.cast(t)
    elif isinstance(t, T.TimestampType):
        back = F.timestamp_micros(c)
    elif isinstance(t, (T.DoubleType, T.FloatType)):
        back = F.coalesce(c, F.lit(float("nan")).cast(t))  # a data frame has one sign for both
    else:
        back = c
    return (F.when(F.col(f"`_there_{name}`"), back) if _has_flag(t) else back).alias(name)


def _packed_fields(name: str, t: T.DataType) -> list[T.StructField]:
    flag = [T.StructField(f"_there_{name}", T.BooleanType())] if _has_flag(t) else []
    return [T.StructField(name, _packed_type(t)), *flag]


def _to_bytes(frame: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _to_frame(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all().to_pandas()


class PreviousRow(StatefulProcessor):
    """Emits each row with chosen columns of the row before it by event time.

    The state belongs to a slot of keys, so a call works on many keys at once.  Rows wait in
    Arrow blocks, kept by their first time, until the watermark has passed them: no earlier row
    of their key can come any more, so they leave in order whatever order they arrived in.
    Arriving rows make new blocks and touch no others; the watermark reads the blocks it has
    reached and writes back what is left of them, not those further on.  Rows behind the watermark are dropped by the engine.
    A key without rows for ``idle`` microseconds is forgotten; its next row has no previous one.
    """

    def __init__(
        self, arriving: list[str], key: list[str], order: list[str], names: list[str], carried: list[str], block: int,
        idle: int | None,
    ):
        self.arriving, self.key, self.order, self.names, self.carried = arriving, key, order, names, carried
        self.block, self.idle = block, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "rows binary")
        self.waiting = handle.getMapState("waiting", "first bigint", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # names that are no identifiers don't survive the way here, so columns go by place
        fresh = pd.concat([r.set_axis(self.arriving, axis=1) for r in rows], ignore_index=True)[[*self.names, AT]]
        self._keep(fresh.sort_values(AT, kind="stable", ignore_index=True))
        self._wake_at(int(fresh[AT].min()))
        return iter(())

    def _keep(self, fresh: pd.DataFrame) -> None:
        """Store rows, in order of time, as blocks under their first time."""
        for start in range(0, len(fresh), self.block):
            block = fresh.iloc[start : start + self.block]
            first = (int(block[AT].iloc[0]),)
            if self.waiting.containsKey(first):
                block = pd.concat([_to_frame(self.waiting.getValue(first)[0]), block], ignore_index=True)
            self.waiting.updateValue(first, (_to_bytes(block),))

    def _wake_at(self, at: int) -> None:
        """Have the slot called as soon as the watermark has passed this moment."""
        self.handle.registerTimer(at // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, rest = [], []
        for first in sorted(int(k[0]) for k in self.waiting.keys()):
            if first > passed:
                rest.append(first)
                break
            block = _to_frame(self.waiting.getValue((first,))[0])
            done = block[AT] <= passed
            ready.append(block[done])
            self.waiting.removeKey((first,))
            if not done.all():
                left = block[~done].sort_values(AT, kind="stable", ignore_index=True)
                self._keep(left)
                rest.append(int(left[AT].iloc[0]))
        if ready and rest:
            self._wake_at(min(rest))
        before = _to_frame(self.last.get()[0]) if self.last.exists() else None
        if not ready:
            self._forget(before, passed)
            return
        yield self._placed(before, pd.concat(ready, ignore_index=True), passed)

    def _placed(self, before: pd.DataFrame | None, ready: pd.DataFrame, passed: int) -> pd.DataFrame:
        """The ready rows with the columns of their predecessors; the last row of each key goes to the state."""
        both = ready.assign(_new=True)
        if before is not None:
            both = pd.concat([before.assign(_new=False), both], ignore_index=True)
        whose = both.groupby(self.key, sort=False, dropna=False).ngroup().to_numpy()
        both = both.assign(_whose=whose).sort_values(
            ["_whose", "_new", AT, *self.order], kind="stable", na_position="first", ignore_index=True
        )
        same = both["_whose"].to_numpy()
        at = both[AT].to_numpy()
        has = np.r_[False, same[1:] == same[:-1]]
        if self.idle is not None:
            has &= np.r_[False, at[1:] - at[:-1] <= self.idle]
        ends = np.r_[same[1:] != same[:-1], True]
        self._forget(both.loc[ends, list(dict.fromkeys([*self.key, *self.carried, AT]))], passed, changed=True)
        new = both["_new"].to_numpy(dtype=bool)
        take = np.maximum(np.arange(len(both)) - 1, 0)[new]
        out = both.loc[new, self.names].reset_index(drop=True)
        for c in self.carried:
            values = both[c].to_numpy()[take]
            if c.startswith("_there_"):
                values = values & has[new]
            elif values.dtype == object:
                values = np.where(has[new], values, None)
            out[f"_there_prev_{c[7:]}" if c.startswith("_there_") else f"prev_{c}"] = values
        return out

    def _forget(self, last: pd.DataFrame | None, passed: int, changed: bool = False) -> None:
        """Store the last rows but for those of idle keys, and be called when the next key is idle."""
        if last is None:
            return
        if self.idle is not None:
            stays = last[AT] + self.idle > passed
            last, changed = last[stays], changed or not stays.all()
        if not changed:
            return
        if last.empty:
            self.last.clear()
            return
        self.last.update((_to_bytes(last),))
        if self.idle is not None:
            self._wake_at(int(last[AT].min()) + self.idle)

    def close(self) -> None:
        pass


def stream_with_previous(
    stream: DataFrame,
    key: str,
    ts: str,
    cols: Sequence[str],
    tie: Sequence[str] = (),
    idle_seconds: int | None = None,
    slots: int = 64,
    block_rows: int = 8_192,
) -> DataFrame:
    """``prev_*`` columns on a stream with a watermark on ``ts`` (needs the RocksDB state store).

    Rows leave when the watermark has passed them, so event-time windows over them belong to a
    second query that reads what this one wrote.  Rows without a time have no place in the order
    and are left out; nulls of a ``tie`` column go first; a null key is a key.

    Keys are dealt to ``slots``, the unit of state and of work: take some per core of the cluster
    and so many that the last rows of a slot's keys and what two watermarks release of it fit a task.  Like the
    number of state partitions it is fixed for the life of a checkpoint.
    """
    fields = [T.StructField(f.name, f.dataType) for f in stream.schema.fields]
    types = {f.name: f.dataType for f in fields}

    def packed_names(*wanted: str, flag_first: bool = False) -> list[str]:
        out = []
        for c in wanted:
            made = [f.name for f in _packed_fields(c, types[c])]
            out += made[::-1] if flag_first else made
        return out

    packed = [p for f in fields for p in _pack(f.name, f.dataType)]
    slot = F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")
    timed = stream.filter(F.col(ts).isNotNull())
    # the time itself stays beside its packed form: the watermark hangs on it
    dealt = timed.select(
        F.col(ts).alias("_time"), *packed, F.unix_micros(F.col(ts).cast("timestamp")).alias(AT), slot.alias(SLOT)
    )
    out_fields = [p for f in fields for p in _packed_fields(f.name, f.dataType)]
    prev_fields = [p for c in cols for p in _packed_fields(f"prev_{c}", types[c])]
    done = dealt.groupBy(SLOT).transformWithStateInPandas(
        statefulProcessor=PreviousRow(
            dealt.columns, packed_names(key), packed_names(*tie, flag_first=True), [f.name for f in out_fields], packed_names(*cols),
            block_rows, None if idle_seconds is None else idle_seconds * 1_000_000,
        ),
        outputStructType=T.StructType([*out_fields, *prev_fields]),
        outputMode="Append",
        timeMode="EventTime",
    )
    return done.select(*[_unpack(f.name, f.dataType) for f in fields], *[_unpack(f"prev_{c}", types[c]) for c in cols])


def stream_delta_m(
    stream: DataFrame,
    key: str = "vehicle_id",
    ts: str = "event_time",
    trip: str = "trip_id",
    tie: Sequence[str] = (),
    idle_seconds: int | None = None,
    slots: int = 64,
) -> DataFrame:
    """Distance to the previous point on an unbounded stream; the rule itself stays an expression."""
    prev = stream_with_previous(stream, key, ts, ["lat", "lon", trip], tie, idle_seconds, slots)
    return prev.withColumn("delta_m", delta_expr(trip)).drop("prev_lat", "prev_lon", f"prev_{trip}")
