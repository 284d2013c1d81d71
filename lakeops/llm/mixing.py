"""Mixing sources to target weights by weighted fair queueing.

Sources in order of their name get the given weights in turn and share the total
of all sizes; no source is asked for more than ``MOST`` times what it has, and
what it cannot give is shared again by weight.  Every document (again for each
further pass over its source) gets a virtual finish time: the words of its source
up to and including it, in shuffled order, over its source's target.  The queue
in order of finish time is cut where the total budget is reached, so every source
ends within a document of its target.

Built-in functions only.  Running totals are cut into cells of about the square
root of the rows: a source along its shuffled order, the queue along finish time.
Only the cells' sums are windowed across cells, so neither a hot source nor the
whole queue meets in one task.

Rows equal in id, source and text are counted in their tasks first and stand in the
queue as entries of up to ``CHUNK`` rows, each entry at a place of its own, so a row
that a third of all rows repeat is neither one place nor one task.  Inside an entry
every row has its own finish time, and the cut may fall between them.

Defined results: a null text has size 0; documents of size 0 take nothing; a null
source is a source of its own, sorted last; null ids are ids like others, and rows
that share an id but not the text are separate documents; equal rows differ in nothing
but how often each is taken, and where other columns differ between them the mix holds
the ones of the row whose JSON text has the smallest hash; ties in finish time go by the
entry's hash; an empty table gives an empty table; very long texts are one value each
and are never copied in the queue; reruns agree, since the shuffle is a hash of the
row's id, source and text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.exprs import words
from lakeops.session import materialise

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 17
CHUNK = 1000
ENTRIES_PER_COPY = 64


def text_size(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, size)`` to ``(source, source_size, target)``, one row per source.

    Rounds of sharing: what the capped sources leave over is split by weight until
    no further source is above its cap.  Each round is one small aggregate, and each
    but the last caps a source for good.
    """
    by_source = materialise(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources"
    )
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn % len(weights) + 1).cast("int"))
    ranked = materialise(by_source.withColumn("weight", weight), "mix-weights")
    cap = F.col("source_size") * F.lit(most)
    budget = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    share = 0.0
    while budget:
        open_ = cap > F.col("weight") * F.lit(share)
        row = ranked.agg(
            F.sum(F.when(open_, F.col("weight")).otherwise(0.0)), F.sum(F.when(open_, 0).otherwise(cap))
        ).first()
        if not row[0]:
            break
        wider = (budget - float(row[1])) / row[0]
        if wider <= share:
            break
        share = wider
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(share))
    return ranked.select("source", "source_size", target.alias("target"))


def _before(cells: DataFrame, over, value: str) -> DataFrame:
    earlier = F.sum(value).over(over.rowsBetween(Window.unboundedPreceding, -1))
    return cells.withColumn("before", F.coalesce(earlier, F.lit(0)))


def _finish(copy: Column | int) -> Column:
    return (F.col("reached") + (copy - 1) * F.col("source_size")) / F.col("target")


def _slot(finish: Column, slots: int) -> Column:
    """Range cell of a finish time: even up to 1, where the budget ends, and logarithmic beyond."""
    return F.when(finish <= 1, F.floor(finish * slots)).otherwise(F.floor((F.ln(finish) + 1) * slots)).cast("bigint")


def _key(id_col: str, source_col: str, text_col: str) -> Column:
    """What tells documents apart: never null itself, and equal for equal nulls."""
    return F.struct(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.unhex(F.md5(F.col(text_col))).alias("text_hash")
    )


def queue_entries(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> tuple[DataFrame, int, int]:
    """Entries of up to ``CHUNK`` equal rows with their place in their source's shuffled order; rows and words in all.

    ``key, source, size, chunk, m, turn, start, source_size, target``: ``start`` is the number
    of words of the source before the entry.
    """
    sized = docs.select(_key(id_col, source_col, text_col).alias("key"), text_size(F.col(text_col)).alias("size"))
    groups = sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {CHUNK}")))
    slim = materialise(
        groups.select("key", "size", "n", chunk.alias("chunk"))
        .select("key", "key.source", "size", "chunk", F.least(F.lit(CHUNK), F.col("n") - F.col("chunk") * CHUNK).alias("m"))
        .withColumn("turn", F.xxhash64(F.lit(seed), "key.doc_id", "source", "key.text_hash", "chunk")),
        "mix-sizes",
    )
    held = slim.withColumn("size", F.col("size") * F.col("m"))
    targets = source_targets(held, weights, most)
    rows, budget = slim.agg(F.sum("m"), F.sum(F.col("size") * F.col("m"))).first()
    slots = max(1, math.isqrt(rows or 0))

    # the turn is a uniform hash: equal slices of its range hold about equal shares of a source
    slice_ = ((F.shiftright("turn", 32) + F.lit(1 << 31)) / F.lit((1 << 32) // slots + 1)).cast("bigint")
    placed = slim.withColumn("cell", F.struct("source", slice_.alias("slice"))).withColumn("words", F.col("size") * F.col("m"))
    sums = placed.groupBy("cell").agg(F.sum("words").alias("cell_size"))
    carried = _before(sums, Window.partitionBy("cell.source").orderBy("cell.slice"), "cell_size").drop("cell_size")
    order = Window.partitionBy("cell").orderBy("turn", "key", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    reached = (
        placed.withColumn("inside", F.coalesce(F.sum("words").over(order), F.lit(0)))
        .join(carried.hint("merge"), "cell")  # the rows are dealt by cell already, and cells may be as many as rows
        .withColumn("start", F.col("before") + F.col("inside"))
        .drop("before", "inside", "cell", "words")
    )
    by_source = targets.select(F.struct("source").alias("of"), "source_size", "target")
    queued = reached.withColumn("of", F.struct("source")).join(by_source, "of").drop("of")
    return materialise(queued, "mix-queue"), rows or 0, budget or 0


def each_row(entries: DataFrame) -> DataFrame:
    """One row per document: ``nth`` of its entry, ``reached`` words of its source up to and including it."""
    nth = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m")))
    return entries.withColumn("nth", nth).withColumn("reached", F.col("start") + F.col("nth") * F.col("size"))


def copies_taken(entries: DataFrame, rows: int, budget: int, most: int = MOST) -> Column:
    """How many copies of a row of :func:`each_row` are in the mix: the queue is cut at the budget."""
    slots = max(1, math.isqrt(rows))
    each = F.explode(F.transform(F.sequence(F.lit(1), F.lit(most)), _finish)).alias("finish")
    copies = each_row(entries.where("size > 0")).select("size", "turn", "nth", each)
    copies = copies.withColumn("slot", _slot(F.col("finish"), slots))
    filled = _before(copies.groupBy("slot").agg(F.sum("size").alias("words")), Window.orderBy("slot"), "words")
    cut = filled.where(F.col("before") + F.col("words") > F.lit(budget)).orderBy("slot").select("slot", "before").first()
    if cut is None:
        return F.when(F.col("size") > 0, most).otherwise(0)
    place = ["finish", "turn", "nth"]
    in_slot = copies.where(F.col("slot") == cut.slot).withColumn(
        "words", F.sum("size").over(Window.partitionBy("slot").orderBy(*place))
    )
    last = (
        in_slot.where(F.col("words") + cut.before <= budget).orderBy(*(F.desc(c) for c in place)).select(*place).first()
    )

    def in_mix(copy: int) -> Column:
        finish = _finish(copy)
        taken = _slot(finish, slots) < cut.slot
        if last is not None:
            own = F.struct(finish.alias("finish"), F.col("turn").alias("turn"), F.col("nth").alias("nth"))
            end = F.struct(F.lit(last.finish).alias("finish"), F.lit(last.turn).alias("turn"), F.lit(last.nth).cast("bigint").alias("nth"))
            taken = taken | (own <= end)
        return F.when(taken, 1).otherwise(0)

    count = sum((in_mix(k) for k in range(2, most + 1)), in_mix(1))
    return F.when(F.col("size") > 0, count).otherwise(0)


def mix_report(docs: DataFrame, most: int = MOST, **options) -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes of it."""
    entries, rows, budget = queue_entries(docs, most=most, **options)
    taken = copies_taken(entries, rows, budget, most) * F.col("size")
    return each_row(entries).select("key.doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", most: int = MOST, **options
) -> DataFrame:
    """The mix itself: the rows of the documents taken, repeated as often as taken, in queue order.

    Equal rows are kept once and given to entries again; a row of very many entries is
    first copied for each ``ENTRIES_PER_COPY`` of them, so that they don't meet in one task.
    """
    entries, rows, budget = queue_entries(docs, id_col, source_col, text_col, most=most, **options)
    copies = copies_taken(entries, rows, budget, most)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    whole = docs.select(row.alias("row"), _key(id_col, source_col, text_col).alias("key"))
    alike = whole.groupBy("key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"), F.count(F.lit(1)).alias("n"))
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {CHUNK * ENTRIES_PER_COPY}")))
    held = alike.select("key", "row", part.alias("part"))
    wanted = entries.where("size > 0").withColumn("part", F.expr(f"chunk div {ENTRIES_PER_COPY}"))
    # entries are many times their compressed file, by which Spark would broadcast them
    matched = wanted.join(held.hint("merge"), ["key", "part"])
    joined = each_row(matched).withColumn("copies", copies).where("copies > 0")
    repeated = joined.select("row", "reached", "source_size", "target", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return repeated.orderBy(_finish(F.col("copy")), F.col("copy")).select("row.*")
