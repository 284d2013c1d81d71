"""How document filters interact: what each removes in every order they can run in.

One pass per document finds which filters it fails.  The pass is a finite-state
transducer over the UTF-8 bytes: a table gives each byte its marks (code point start,
capital, symbol, white space), and since the state after a byte (inside a word or not)
follows from that byte's mark alone, the whole buffer of an Arrow batch is stepped
through at once, in slices of bounded length.  Words leave it as spans of the buffer
and go into an open-addressing hash table that confirms every hit on the bytes, so the
number of distinct words is exact.

The five filters make 32 sets of failures.  Documents are counted per part, set and
label; every order is worked out from those counts, which are few whatever the size
of the corpus.  Equal texts meet by a hash of the text after they have been counted
in their task, so a text that a third of all documents share is a few rows.

Defined results: a null text is empty, and equal to an empty one; a null part is the
empty string; rows of one id are counted each and share its labels, of which one with
1 is enough; a null id has no labels, is never a copy and makes no other row one; rows
that share the smallest id of a text are none of them copies; an empty table gives an
empty table; very long texts take memory for their distinct words and their longest
word; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
SYMBOLS = b"#$%&*|"
SLICE = 1 << 20

SPACE = 1 << 63
#: Marks of each byte, as fields that can be summed over a slice: code points, capitals, symbols.
FIELD = 21
MARKS = np.array(
    [
        int(b & 0xC0 != 0x80) | int(0x41 <= b <= 0x5A) << FIELD | int(b in SYMBOLS) << 2 * FIELD
        for b in range(256)
    ],
    dtype=np.uint64,
)
IS_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


class WordTable:
    """Open-addressing set of words per document; every hit is confirmed on the bytes.

    Words are spans of ``data``.  The first eight bytes are kept as one number, which is
    all of a short word; longer words compare the rest eight bytes at a time.
    """

    def __init__(self, data: bytes):
        self.data = data
        # eight bytes from any place; the buffer has eight spare ones behind it
        self.at = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))
        self.slots = np.full(1024, -1, np.int64)
        self.entries: list[np.ndarray] = [np.empty(0, np.int64) for _ in range(3)]
        self.head = np.empty(0, np.uint64)
        self.hash = np.empty(0, np.uint64)

    def chunk(self, start: np.ndarray, length: np.ndarray, k: int) -> np.ndarray:
        return self.at[start + 8 * k] & LOW_BYTES[np.clip(length - 8 * k, 0, 8)]

    def hashed(self, doc, start, length, head):
        h = mixed(head ^ mixed(doc.astype(np.uint64) * MIX + length.astype(np.uint64)))
        rest, k = np.flatnonzero(length > 8), 1
        while rest.size:
            h[rest] = mixed(h[rest] ^ self.chunk(start[rest], length[rest], k))
            k += 1
            rest = rest[length[rest] > 8 * k]
        return h

    def same(self, start, length, other) -> np.ndarray:
        """Whether the bytes behind the first eight agree; both words have the same length."""
        equal = np.ones(len(start), bool)
        rest, k = np.flatnonzero(length > 8), 1
        while rest.size:
            equal[rest] = self.chunk(start[rest], length[rest], k) == self.chunk(other[rest], length[rest], k)
            k += 1
            rest = rest[equal[rest] & (length[rest] > 8 * k)]
        return equal

    def _grow(self, n: int) -> None:
        if 2 * n <= len(self.slots):
            return
        self.slots = np.full(1 << (4 * n).bit_length(), -1, np.int64)
        mask = np.uint64(len(self.slots) - 1)
        wait = np.arange(len(self.hash))
        place = (self.hash & mask).astype(np.int64)
        while wait.size:
            free = self.slots[place] < 0
            self.slots[place[free]] = wait[free]
            lost = self.slots[place] != wait
            wait, place = wait[lost], (place[lost] + 1) & int(mask)

    def insert(self, doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Adds the words and returns the documents of those that were new, once per new word."""
        old = len(self.hash)
        self._grow(old + len(doc))
        head = self.chunk(start, length, 0)
        h = self.hashed(doc, start, length, head)
        docs, starts, lengths = (np.concatenate(p) for p in zip(self.entries, (doc, start, length)))
        heads, hashes = np.concatenate((self.head, head)), np.concatenate((self.hash, h))
        mask = len(self.slots) - 1
        place = (h & np.uint64(mask)).astype(np.int64)
        wait = np.arange(old, old + len(doc))
        owners = []
        while wait.size:
            free = self.slots[place] < 0
            self.slots[place[free]] = wait[free]
            there = self.slots[place]
            owners.append(wait[there == wait])
            hit = (docs[there] == docs[wait]) & (lengths[there] == lengths[wait]) & (heads[there] == heads[wait])
            check = np.flatnonzero(hit & (lengths[wait] > 8) & (there != wait))
            hit[check] = self.same(starts[wait[check]], lengths[wait[check]], starts[there[check]])
            wait, place = wait[~hit], (place[~hit] + 1) & mask
        # new words take the numbers behind the old ones, and the slots follow
        new = np.sort(np.concatenate(owners)) if owners else np.empty(0, np.int64)
        number = np.full(old + len(doc), -1, np.int64)
        number[:old] = np.arange(old)
        number[new] = np.arange(old, old + len(new))
        used = self.slots >= 0
        self.slots[used] = number[self.slots[used]]
        keep = np.concatenate((np.arange(old), new))
        self.entries = [docs[keep], starts[keep], lengths[keep]]
        self.head, self.hash = heads[keep], hashes[keep]
        return docs[new]


def scan(data: bytes, offsets: np.ndarray, size: int = SLICE) -> tuple[np.ndarray, ...]:
    """Per text of a buffer: words, distinct words, code points, capitals, symbols.

    Text ``i`` is ``data[offsets[i]:offsets[i + 1]]``; eight spare bytes follow the last.
    Slices end behind white space or at the end of a text, so no word is cut; a word
    longer than ``size`` makes its slice longer.
    """
    n = len(offsets) - 1
    words, distinct, points, capitals, symbols = (np.zeros(n, np.int64) for _ in range(5))
    raw = np.frombuffer(data, np.uint8)
    end, at = int(offsets[-1]), int(offsets[0])
    table, table_doc = WordTable(data), -1
    field = np.uint64((1 << FIELD) - 1)
    while at < end:
        stop = min(at + size, end)
        while stop < end:
            blank = np.flatnonzero(IS_SPACE[raw[max(at, stop - size) : stop]])
            bound = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            cut = max(bound, max(at, stop - size) + int(blank[-1]) + 1 if blank.size else 0)
            if cut > at:
                stop = cut
                break
            stop = min(stop + size, end)
        part = raw[at:stop]
        first = int(np.searchsorted(offsets, at, "right") - 1)
        last = int(np.searchsorted(offsets, stop, "left"))
        starts = np.maximum(offsets[first:last], at) - at
        full = np.flatnonzero(offsets[first:last] < offsets[first + 1 : last + 1])  # texts that have bytes
        # summed in stretches that no field can overflow
        marks = MARKS[part]
        for low in range(0, len(part), size):
            high = min(low + size, len(part))
            inside = full[(starts[full] < high) & (np.append(starts, len(part))[full + 1] > low)]
            sums = np.add.reduceat(marks[low:high], np.maximum(starts[inside] - low, 0))
            points[first + inside] += (sums & field).astype(np.int64)
            capitals[first + inside] += (sums >> np.uint64(FIELD) & field).astype(np.int64)
            symbols[first + inside] += (sums >> np.uint64(2 * FIELD) & field).astype(np.int64)
        in_word = ~IS_SPACE[part]
        before = np.empty_like(in_word)
        before[0] = False
        before[1:] = in_word[:-1]
        before[starts[full]] = False
        begins = np.flatnonzero(in_word & ~before)
        after = np.empty_like(in_word)
        after[-1] = False
        after[:-1] = in_word[1:]
        after[starts[full][starts[full] > 0] - 1] = False
        ends = np.flatnonzero(in_word & ~after) + 1
        if begins.size:
            doc = full[np.searchsorted(starts[full], begins, "right") - 1] + first
            words += np.bincount(doc, minlength=n)
            if table_doc != first:  # the table holds words of the text that the slice before left open
                table = WordTable(data)
            distinct += np.bincount(table.insert(doc, begins + at, ends - begins), minlength=n)
            if last - first > 1:
                keep = table.entries[0] == last - 1
                rest = [e[keep] for e in table.entries]
                table = WordTable(data)
                table.insert(*rest)
            table_doc = last - 1
        at = stop
    return words, distinct, points, capitals, symbols


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id, part, failed, text_key``: bits of the filters A to D that a text fails, and its hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            pieces = [b or b"" for b in text.to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces], dtype=np.int64)))
            words, distinct, points, capitals, symbols = scan(b"".join([*pieces, bytes(8)]), offsets)
            failed = (
                (words < MIN_WORDS) * 1 + (100 * distinct < MIN_DISTINCT * words) * 2
                + (100 * capitals > MAX_CAPITALS * points) * 4 + (symbols > 0) * 8
            )
            keys = [hashlib.blake2b(p, digest_size=20).digest() for p in pieces]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(failed, pa.int32()), pa.array(keys, pa.binary())],
                ["doc_id", "part", "failed", "text_key"],
            )

    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("binary").alias("text"),
    )
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(work, f"doc_id {kind}, part string, failed int, text_key binary")


def failure_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """``part, failed, n, good, toxic``: documents per part and set of failed filters (bits, A lowest)."""
    label = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    found = failures(docs, id_col, text_col, part_col)
    once = found.groupBy("doc_id", "part", "failed", "text_key").agg(F.count(F.lit(1)).alias("n"))
    # null ids match no label; spread by their text they don't meet in one task
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text_key")).otherwise(F.lit(0).cast("bigint"))
    rows = once.withColumn("spread", spread).join(
        label.withColumn("label_spread", F.lit(0).cast("bigint")),
        (F.col("doc_id") == F.col("label_id")) & (F.col("spread") == F.col("label_spread")), "left",
    )
    kind = ["text_key", "part", "failed", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")]
    alike = rows.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.min("doc_id").alias("first_id"), F.min_by("n", "doc_id").alias("n_first"),
    )
    # a text has a few rows left, one per part and label
    judged = alike.withColumn("least_id", F.min("first_id").over(Window.partitionBy("text_key")))
    single = F.col("n_null") + F.when(F.col("first_id") == F.col("least_id"), F.col("n_first")).otherwise(0)
    split = F.explode(
        F.array(
            F.struct(F.col("failed").alias("set"), single.alias("m")),
            F.struct((F.col("failed") + 16).alias("set"), (F.col("n") - single).alias("m")),
        )
    )
    return (
        judged.select("part", "good", "toxic", split.alias("x")).where("x.m > 0")
        .groupBy("part", F.col("x.set").alias("failed"))
        .agg(
            F.sum("x.m").alias("n"), F.sum(F.col("x.m") * F.col("good")).alias("good"),
            F.sum(F.col("x.m") * F.col("toxic")).alias("toxic"),
        )
    )


def steps() -> Column:
    """Every place in every order, as an array of ``(filter_order, step, bit, before)``."""
    rows = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            rows.append(f"named_struct('filter_order', '{name}', 'step', {step}, 'bit', {1 << i}, 'before', {before})")
            before |= 1 << i
    return F.expr(f"array({', '.join(rows)})")


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """One row per part, order and step, zeros included."""
    counts = failure_counts(docs, labels, id_col, text_col, part_col)
    failed, bit, before = F.col("failed"), F.col("bit"), F.col("before")
    fails, earlier = failed.bitwiseAND(bit) != 0, failed.bitwiseAND(before) != 0
    removed = fails & ~earlier

    def total(condition: Column, of: Column | str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of) if isinstance(of, str) else of).otherwise(0)).cast("bigint")

    # a document of k failures is removed by each of those filters in 120 / k orders
    share = F.col("n") * F.expr("120 div bit_count(failed)")
    placed = counts.select("*", F.explode(steps()).alias("place")).select("*", "place.*")
    return placed.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(removed).alias("removed"), total(fails & earlier).alias("redundant"),
        total(failed == bit).alias("unique_fails"), total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"), total(fails, share).alias("shapley"),
    ).withColumn("step", F.col("step").cast("int"))
