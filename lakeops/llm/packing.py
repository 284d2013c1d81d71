"""Packing documents into sequences by minimum bin slack.

Every document becomes token ids and an end mark; only what is longer than a
sequence is cut, so that all pieces but the first are full.  Minimum bin slack
fills one sequence at a time: the longest piece left is placed, and a bitset
dynamic program over the lengths left finds the combination that fills the rest
best.  Pieces of one length are interchangeable, so the search runs on the counts
per length - at most one per possible length, whatever the size of the corpus -
and repeats a combination for as long as the counts allow.  The plan is a small
table; each piece finds its sequence and place by its rank among the pieces of
its length.

Ranks come from a running count per length inside each task and a prefix over
tasks, so a length that most pieces share is never gathered.

Defined results: a null text is empty and is packed as its end mark alone; fully
equal rows are packed each; an empty table gives an empty table; other columns
are ignored.  ``sequence_id`` numbers depend on the layout of the input.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import materialise

CAPACITY = 1024
END = 2

# Fixed value: the splitting pattern of the byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that every library puts into the same classes of that pattern are not matched here.
OTHER = re.compile("[^\\x20-\\x7e\\t\\n\\rÀ-ÖØ-öø-ſ]")


def byte_alphabet() -> dict[str, int]:
    """How the vocabulary file writes bytes: printable ones as themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Ids:
    """Token ids of whole texts, as little-endian bytes, from one vocabulary file.

    Where ids follow the order of the merges, joining the pair whose union has the
    lowest id does the same merges as the library reading the list of merges: while
    no merge crosses the bounds of a token's bytes, they merge as they would alone.
    That lets a faster routine do the plain texts.  A file that isn't so, a text with a
    special mark, and one with characters whose class may differ between Unicode
    versions go to the library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.marks = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [vocab.get(a + b) for a, b in merges]
        alphabet = byte_alphabet()
        plain = {t: i for t, i in vocab.items() if t not in self.marks}
        ordered = all(b == a + 1 for a, b in zip(order, order[1:])) and len(plain) == len(order) + 256
        self.fast = None
        if ordered and all(c in alphabet for t in plain for c in t):
            ranks = {bytes(alphabet[c] for c in t): i for t, i in plain.items()}
            self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> bytes:
        if self.fast is None or OTHER.search(text) or any(mark in text for mark in self.marks):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


def pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, task, turn``: turn counts the pieces of one length in one task."""
    mark = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, turns, task = Ids(path), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            rows: list[tuple] = []
            at: list[int] = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                data = memoryview(ids.of(text or "") + mark)
                total = len(data) // 4
                stops = range(total % capacity or capacity, total + 1, capacity)
                start = 0
                for piece, stop in enumerate(stops):
                    length = stop - start
                    rows.append((piece, start, length, zlib.crc32(data[4 * start : 4 * stop]), turns[length]))
                    turns[length] += 1
                    at.append(i)
                    start = stop
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at, pa.int64())),
                    pa.array(columns[0], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[1:4]),
                    pa.array([task] * len(at), pa.int32()),
                    pa.array(columns[4], pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "turn"],
            )

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(
        cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, turn bigint"
    )


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, from ``counts`` as available, whose sum comes as near to ``room`` as can be.

    Bit ``s`` of ``reach[k]`` says that a sum of ``s`` can be made of the first ``k``
    lengths.  Several pieces of one length enter in powers of two.  Longer lengths are
    tried first when walking back, which leaves the small ones for later gaps.
    """
    mask = (1 << (room + 1)) - 1
    steps: list[tuple[int, int]] = []
    reach = [1]
    for length in sorted(l for l in counts if l <= room and counts[l] > 0):
        left, many = min(counts[length], room // length), 1
        while left:
            take = min(many, left)
            steps.append((length, take))
            reach.append(reach[-1] | (reach[-1] << (length * take)) & mask)
            left, many = left - take, many * 2
        if reach[-1] == mask:
            break
    target = reach[-1].bit_length() - 1
    chosen: list[int] = []
    for k in range(len(steps), 0, -1):
        length, take = steps[k - 1]
        if target >= length * take and reach[k - 1] >> (target - length * take) & 1:
            chosen += [length] * take
            target -= length * take
    return chosen


@dataclass(frozen=True)
class Pattern:
    lengths: tuple[int, ...]
    repeats: int


def minimum_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Sequences as patterns of lengths with how often each is used; uses up all counts."""
    left = {l: n for l, n in counts.items() if n > 0}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        fill = fullest(left, capacity - longest) if longest < capacity else []
        left[longest] += 1
        lengths = (longest, *fill)
        used = Counter(lengths)
        repeats = min(left[l] // n for l, n in used.items())
        for l, n in used.items():
            left[l] -= n * repeats
            if not left[l]:
                del left[l]
        out.append(Pattern(lengths, repeats))
    return out


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    spark = docs.sparkSession
    cut = materialise(pieces(docs, path, id_col, text_col, capacity, end), "pack-pieces")
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.withColumn("first_rank", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")

    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    plan, sequence, taken = [], 0, Counter()
    for pattern in minimum_slack(counts, capacity):
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in pattern.lengths:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, places in offsets.items():
            plan.append((length, taken[length], taken[length] + len(places) * pattern.repeats, sequence, places))
            taken[length] += len(places) * pattern.repeats
        sequence += pattern.repeats
    # each pattern leaves some length too scarce for it, so there are at most capacity * log(counts) of them
    slots = spark.createDataFrame(plan, "length bigint, low bigint, high bigint, first_sequence bigint, places array<int>")
    ranked = cut.join(first, ["length", "task"]).withColumn("rank", F.col("first_rank") + F.col("turn"))
    nth = F.col("rank") - F.col("low")
    placed = ranked.join(
        F.broadcast(slots.withColumnRenamed("length", "slot_length")),
        (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    each = F.size("places")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / each)).cast("bigint").alias("sequence_id"),
        F.col("places")[(nth % each).cast("int")].cast("bigint").alias("offset"),
    )
