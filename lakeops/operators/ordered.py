"""Ordered per-key work that does not put a whole key into one task.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends all rows of a key to one
task.  Here a key is cut along its order into *chunks* (a time bucket, or
quantile ranges of the order column).  The window runs per (key, chunk); what
has to cross a chunk border is first reduced to one row per (key, chunk) and
only that small table is windowed per key.  A key holding a third of the rows
is spread over all its chunks, and results are exactly those of the plain
window.

``order`` is a list of column names, ``"-name"`` for descending.  ``chunk`` is a
column (or name) that never decreases while the first order column increases.
``None`` derives quantile ranges of the first order column with one
column-pruned pass.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import materialise

CHUNK, CELL, ROW, BLOCK, HALO = "_chunk", "_cell", "_row", "_block", "_halo"
ROWS_PER_TASK = 1 << 20

def names(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def bare(order: Sequence[str]) -> list[str]:
    return [o.lstrip("-") for o in order]


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def reverse(order: Sequence[str]) -> list[str]:
    return [o[1:] if o.startswith("-") else f"-{o}" for o in order]


def time_chunk(col: str, unit: str = "hour") -> Column:
    """Time bucket used as a chunk."""
    return F.date_trunc(unit, F.col(col))


SAMPLE_PER_RANGE = 20
LONGEST_CUT = 256


def _cut_points(df: DataFrame, name: str, ranges: int) -> list:
    """Values that cut the column into about equal ranges, from a sample of the column as it is.

    One pass: every task keeps the rows that drew the smallest random numbers, at most
    ``SAMPLE_PER_RANGE`` per range in all.  Long text is compared by its start.
    """
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType)):
        value = F.substring(value, 1, LONGEST_CUT)
    drawn = df.select(value.alias("v")).where("v IS NOT NULL").orderBy(F.rand(7)).limit(ranges * SAMPLE_PER_RANGE)
    found = [r.v for r in drawn.orderBy("v").collect()]
    at = (found[i * len(found) // ranges] for i in range(1, ranges)) if found else ()
    return [v for v, _ in itertools.groupby(at)]


def _range_of(value: Column, cuts: list, kind: T.DataType) -> Column:
    """How many of the ordered ``cuts`` are not above the value; long lists are searched in two steps."""

    def upto(column: Column) -> Column:
        return F.size(F.filter(column, lambda c: c <= value))

    def array(values: list) -> Column:
        return F.array(*(F.lit(v) for v in values)).cast(T.ArrayType(kind))

    width = math.isqrt(len(cuts))
    if width < 6:
        return upto(array(cuts))
    parts = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    which = upto(array([p[0] for p in parts]))
    inside = F.get(F.array(*(array(p) for p in parts)), F.greatest(which - 1, F.lit(0)))
    return F.greatest(which - 1, F.lit(0)) * width + upto(inside)


def quantile_chunk(df: DataFrame, col: str, chunks: int | None = None) -> DataFrame:
    """Add ``_chunk``: which of ``chunks`` near-equal ranges of ``col`` a row is in, for any orderable type.

    The split points (a bounded list) come from a sample of the column; any split points
    give the same final result, they only decide how evenly the work spreads.  Nulls get
    the lowest chunk, NaN the highest.
    """
    spark = df.sparkSession
    n = chunks or max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    cuts, kind, value = _cut_points(df, col, n), df.schema[col].dataType, F.col(col)
    if not cuts:
        return df.withColumn(CHUNK, F.lit(0))
    if isinstance(kind, (T.CharType, T.VarcharType)):
        kind = T.StringType()
    if isinstance(kind, (T.StringType, T.BinaryType)):
        value = F.substring(value, 1, LONGEST_CUT)
    return df.withColumn(CHUNK, F.coalesce(F.greatest(_range_of(value, cuts, kind), F.lit(0)), F.lit(0)))


def add_chunk(
    df: DataFrame, by: Sequence[str], order: Sequence[str], chunk: Column | str | None
) -> DataFrame:
    """Add ``_cell``, the struct of key columns and chunk.

    As one struct it is never null itself, so the window, the fold and the join
    below all hash the same expression: rows are shuffled by it once.
    """
    if chunk is None:
        cut = quantile_chunk(df, bare(order)[0])
    else:
        cut = df.withColumn(CHUNK, F.col(chunk) if isinstance(chunk, str) else chunk)
    return cut.withColumn(CELL, F.struct(*by, CHUNK)).drop(CHUNK)


def _in_cell(order: Sequence[str]):
    return Window.partitionBy(CELL).orderBy(*sort_columns(order))


def _over_chunks(by: Sequence[str], order: Sequence[str]):
    """Window over the chunks of one key, on a table with one row per cell."""
    at = F.col(f"{CELL}.{CHUNK}")
    keys = [F.col(f"{CELL}.`{b}`") for b in by]
    return Window.partitionBy(*keys).orderBy(at.desc() if order[0].startswith("-") else at.asc())


def _chunks_before(by: Sequence[str], order: Sequence[str]):
    return _over_chunks(by, order).rowsBetween(Window.unboundedPreceding, -1)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on equal keys where null equals null; keeps the left key columns."""
    l = left.withColumn("_on", F.struct(*on))
    r = right.withColumn("_on", F.struct(*on)).drop(*on)
    return l.join(r, "_on", "left").drop("_on")


_FOLD = {"sum": F.sum, "max": F.max, "min": F.min}
_MERGE = {
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "max": F.greatest,
    "min": F.least,
}


def running(
    df: DataFrame,
    by: str | Sequence[str] | None,
    order: Sequence[str],
    exprs: dict[str, Column],
    kind: str = "sum",
    chunk: Column | str | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Running sum, max or min of several expressions per key, chunk-wise."""
    fold, merge = _FOLD[kind], _MERGE[kind]
    by = names(by)
    cut = add_chunk(df, by, order, chunk).withColumns({f"_in_{k}": v for k, v in exprs.items()})
    per_chunk = cut.groupBy(CELL).agg(*[fold(f"_in_{k}").alias(f"_all_{k}") for k in exprs])
    before = _chunks_before(by, order)
    carried = per_chunk.select(CELL, *[fold(f"_all_{k}").over(before).alias(f"_carry_{k}") for k in exprs])
    frame = _in_cell(order).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    local = cut.withColumns({f"_loc_{k}": fold(f"_in_{k}").over(frame) for k in exprs})
    joined = local.join(carried, CELL, "left")
    out = joined.withColumns({k: merge(F.col(f"_loc_{k}"), F.col(f"_carry_{k}")) for k in exprs})
    return out.drop(CELL, *[f"{p}{k}" for k in exprs for p in ("_in_", "_loc_", "_carry_")])


def row_numbers(
    df: DataFrame,
    by: str | Sequence[str] | None,
    order: Sequence[str],
    out: str = ROW,
    chunk: Column | str | None = None,
) -> DataFrame:
    """``row_number()`` per key (or over the whole table when ``by`` is empty)."""
    by = names(by)
    cut = add_chunk(df, by, order, chunk)
    counts = cut.groupBy(CELL).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(CELL, F.coalesce(F.sum("_n").over(_chunks_before(by, order)), F.lit(0)).alias("_before"))
    local = cut.withColumn("_local", F.row_number().over(_in_cell(order)))
    joined = local.join(offsets, CELL, "left")
    return joined.withColumn(out, F.col("_local") + F.col("_before")).drop("_local", "_before", CELL)


def ranks(
    df: DataFrame,
    by: str | Sequence[str] | None,
    order: Sequence[str],
    out: str = "rank",
    chunk: Column | str | None = None,
    stage: bool = False,
) -> DataFrame:
    """``rank()`` with gaps per key (or overall), by counting rows that sort before.

    Rows with equal order values are first folded into one row with a count, so
    neither a huge group nor a huge tie meets in one task.  The folded rows are read
    several times and written once before.  With ``stage`` the input itself is written
    instead: for an aggregate that is dear to compute and small to keep.
    """
    by, keys = names(by), bare(order)
    if stage:
        df = materialise(df, "rank")
    values = [k for k in keys if k not in by]
    folded = df.groupBy(*by, *values).agg(F.count(F.lit(1)).alias("_n"))
    if not stage:
        folded = materialise(folded, "rank")
    counted = running(folded, by, order, {"_through": F.col("_n")}, chunk=chunk)
    places = counted.select(*by, *values, (F.col("_through") - F.col("_n") + 1).alias(out))
    return join_null_safe(df, places, [*by, *values])


def with_previous(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    chunk: Column | str | None = None,
    prefix: str = "prev_",
) -> DataFrame:
    """Previous row's ``cols`` per key (``lag``), carried over chunk borders."""
    by = names(by)
    cut = add_chunk(df, by, order, chunk).withColumn("_row_value", F.struct(*cols))
    if any(o.startswith("-") for o in order):
        # the chunk's last row in `order` is its first row in the reversed order
        tail = cut.withColumn("_i", F.row_number().over(_in_cell(reverse(order)))).filter("_i = 1")
        ends = tail.select(CELL, F.col("_row_value").alias("_end"))
    else:
        ends = cut.groupBy(CELL).agg(F.max_by("_row_value", F.struct(*order)).alias("_end"))
    carried = ends.select(CELL, F.lag("_end").over(_over_chunks(by, order)).alias("_carry"))
    local = cut.withColumn("_before", F.lag("_row_value").over(_in_cell(order)))
    joined = local.join(carried, CELL, "left")
    prev = F.coalesce("_before", "_carry")
    return joined.withColumns({f"{prefix}{c}": prev[c] for c in cols}).drop("_row_value", "_before", "_carry", CELL)


def fill_forward(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    chunk: Column | str | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Replace nulls by the last non-null value before them, per key.

    ``rows`` tells how many rows there are about: beyond ``ROWS_PER_TASK`` of them per shuffle
    partition, more partitions are taken, so that what a task sorts does not grow with the table.
    """
    by = names(by)
    cut = add_chunk(df, by, order, chunk)
    tasks = -(-(rows or 0) // ROWS_PER_TASK)
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")):
        cut = cut.repartition(tasks, CELL)
    upto = _in_cell(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"_loc_{c}": F.last(c, ignorenulls=True).over(upto) for c in cols})
    ends, before = _chunk_ends(cut, order, cols), _chunks_before(by, order)
    carried = ends.select(
        CELL, *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols]
    )
    joined = local.join(carried, CELL, "left")
    filled = joined.withColumns({c: F.coalesce(f"_loc_{c}", f"_carry_{c}") for c in cols})
    return filled.drop(CELL, *[f"{p}{c}" for c in cols for p in ("_loc_", "_carry_")])


def _chunk_ends(cut: DataFrame, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Last non-null value of each column in each cell."""
    key = F.struct(*bare(order))
    descending = all(o.startswith("-") for o in order)
    if not descending and any(o.startswith("-") for o in order):
        raise ValueError("fill needs an order of one direction")
    pick = F.min_by if descending else F.max_by
    return cut.groupBy(CELL).agg(
        *[pick(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(f"_end_{c}") for c in cols]
    )


def fill_backward(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    chunk: Column | str | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Replace nulls by the next non-null value, per key."""
    return fill_forward(df, by, reverse(order), cols, chunk, rows)


def split_blocks(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str],
    halo: int,
    size: int = 100_000,
    chunk: Column | str | None = None,
) -> DataFrame:
    """Cut each key into blocks of ``size`` rows that also hold the ``halo`` rows before.

    Adds ``_row`` (position within the key from 1), ``_block`` and ``_halo``.  A
    trailing frame of at most ``halo`` rows can then be computed per (key,
    block); drop the rows with ``_halo`` afterwards.
    """
    if halo > size:
        raise ValueError("halo must not exceed the block size")
    numbered = row_numbers(df, by, order, ROW, chunk)
    position = (F.col(ROW) - 1) % size
    home = F.floor((F.col(ROW) - 1) / size).cast("long")
    own = F.struct(home.alias(BLOCK), F.lit(False).alias(HALO))
    lent = F.struct((home + 1).alias(BLOCK), F.lit(True).alias(HALO))
    places = F.when(position >= size - halo, F.array(own, lent)).otherwise(F.array(own))
    return numbered.withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place")


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(ROW, BLOCK, HALO)


def block_window(by: str | Sequence[str], rows: int | None = None):
    """Window inside one block; ``rows`` gives a trailing frame of that many rows."""
    w = Window.partitionBy(*names(by), BLOCK).orderBy(ROW)
    return w if rows is None else w.rowsBetween(-(rows - 1), Window.currentRow)
