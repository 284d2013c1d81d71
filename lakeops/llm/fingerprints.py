"""Order MinHash fingerprints.

The k-mers of a text are numbered by occurrence, so that a repeated k-mer counts
each time.  One hash deals them into ``BINS`` bins; each bin keeps its ``PICK``
smallest and hashes them in the order in which they stand in the text.  Two texts
share a bin's value when they share its k-mers *and* their order, which makes the
share of equal bins follow the edit distance and not only the sets.

``edited_fingerprints`` also fingerprints each text with its last quarter replaced by
the start of the next document's text, which needs each document's successor:
rows are dealt into ranges of the id, and the first row of a range is also given to
the range before it.

Defined results: a null text is empty; an empty text has an empty fingerprint, alike
to another empty one (1) and to nothing else (0); a text shorter than a k-mer is one
k-mer; ids that repeat follow each other in order of a hash of their text; null ids
come first; one document follows itself; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.neardup import mix, odd_numbers

K = 5
BINS = 64
PICK = 2
SEED = 0x0D0D
GAP = "--------"


def order_minhash(text: str, k: int = K, bins: int = BINS, pick: int = PICK) -> str:
    """``bins`` values of eight hex digits; ``--------`` for a bin without a k-mer."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(code):
        return ""
    width = min(k, len(code))
    n = len(code) - width + 1
    weights = odd_numbers(k + 1, SEED)
    grams = np.full(n, width, np.uint64) * weights[k]
    for j in range(width):
        grams += code[j : j + n].astype(np.uint64) * weights[j]
    grams = mix(grams)
    # the low bits hold the place, so one sort gives both the order and where each came from
    low = np.uint64(max(1, int(n - 1).bit_length()))
    place_mask = (np.uint64(1) << low) - np.uint64(1)
    at = np.sort((grams & ~place_mask) | np.arange(n, dtype=np.uint64))
    place = (at & place_mask).astype(np.int64)
    new = np.ones(n, bool)
    new[1:] = (at[1:] >> low) != (at[:-1] >> low)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    numbered = np.empty(n, np.uint64)
    numbered[place] = mix(grams[place] + (np.arange(n) - first).astype(np.uint64) * weights[0])
    ranked = np.sort((numbered & ~place_mask) | np.arange(n, dtype=np.uint64))
    starts = np.searchsorted(ranked, np.array([b * 2**64 // bins for b in range(bins)], np.uint64))
    stops = np.append(starts[1:], n)
    index = starts[:, None] + np.arange(pick)
    there = index < stops[:, None]
    places = np.where(there, (ranked[np.minimum(index, n - 1)] & place_mask).astype(np.int64), n)
    places.sort(axis=1)  # back into text order; what a bin lacks goes last
    values = np.where(places < n, numbered[np.minimum(places, n - 1)], np.uint64(0))
    total = there.sum(axis=1).astype(np.uint64)
    for column in values.T:
        total = mix(total * weights[1] + column)
    out = (total >> np.uint64(32)).astype(">u4").tobytes().hex()
    if there[:, 0].all():
        return out
    return "".join(out[8 * i : 8 * i + 8] if used else GAP for i, used in enumerate(there[:, 0].tolist()))


def likeness(a: str, b: str) -> float:
    """Share of equal bins among those that hold something in either."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(s.encode(), "S8") for s in (a, b))
    used = (x != GAP.encode()) | (y != GAP.encode())
    return float((x[used] == y[used]).mean())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = pa.array([order_minhash(t or "") for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), signed], ["doc_id", "fingerprint"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(sign, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _with_successors(docs: DataFrame, ranges: int) -> DataFrame:
    """``slot, halo, doc_id, text`` dealt by slot and sorted; a slot ends with the first row of the next one.

    The slots are quantile ranges of a numeric id, from one pass over the id column;
    any bounds give the same successors.
    """
    value = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    points = docs.agg(F.percentile_approx(F.col("doc_id").cast("double"), shares, 8 * ranges)).first()[0] or []
    splits = [float("-inf"), *sorted(set(points)), float("inf")]

    def slotted(df: DataFrame) -> DataFrame:
        numbered = df.withColumn("v", value)
        if len(splits) < 3:
            return numbered.withColumn("slot", F.lit(0.0)).drop("v")
        return Bucketizer(splits=splits, inputCol="v", outputCol="slot", handleInvalid="keep").transform(numbered).drop("v")

    # a struct orders and compares nulls like values
    firsts = slotted(docs.select("doc_id")).groupBy("slot").agg(F.min(F.struct("doc_id")).alias("of"))
    along = Window.orderBy("slot")
    over_all = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("slot").over(along), F.last("slot").over(over_all))
    halo = firsts.select("of", before.alias("before"))  # one row per slot: at most ``ranges`` rows
    rows = slotted(docs).withColumn("of", F.struct("doc_id")).join(F.broadcast(halo), "of", "left")
    own = F.struct(F.col("slot").alias("slot"), F.lit(False).alias("halo"))
    copy = F.struct(F.col("before").alias("slot"), F.lit(True).alias("halo"))
    stands = F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy)))
    return (
        rows.select(stands.alias("at"), "doc_id", "text").select("at.*", "doc_id", "text")
        .repartition("slot").sortWithinPartitions("slot", "halo", "doc_id", F.xxhash64("text"))
    )


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None
) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    spark = docs.sparkSession
    ranges = ranges or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = _with_successors(slim, ranges)
    kind = slim.schema["doc_id"].dataType.simpleString()
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

    def finish(row: tuple, text: str, print_: str) -> tuple:
        doc_id, own, own_print = row
        quarter = len(own) // 4
        edited = own[: len(own) - quarter] + text[:quarter]
        edited_print = own_print if edited == own else order_minhash(edited)
        return (
            doc_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_print, edited_print,
            likeness(own_print, edited_print), likeness(own_print, print_),
        )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None  # the row before, without its successor
        slot = None
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("slot", "halo", "doc_id", "text"))
            for at, halo, doc_id, text in zip(*columns):
                if at != slot:
                    slot, waiting = at, None
                if halo and waiting is None:
                    continue  # a further row of the same id
                print_ = waiting[2] if waiting is not None and waiting[1] == text else order_minhash(text)
                if waiting is not None:
                    out.append(finish(waiting, text, print_))
                waiting = None if halo else (doc_id, text, print_)
            if out:
                arrays = [pa.array(c) for c in zip(*out)]
                arrays[0] = pa.array([r[0] for r in out], batch.schema.field("doc_id").type)
                yield pa.RecordBatch.from_arrays(arrays, list(names))

    return dealt.mapInArrow(
        sign,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
