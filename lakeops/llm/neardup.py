"""Near duplicates with MinHash bands, odd sketches and exact confirmation.

A document's set is its distinct five-word shingles.  Documents of one set form a
class; the work goes on with one row per class.

1. Every class gets ``BANDS * ROWS`` MinHash samples.  Their bands are bucket keys;
   the samples are also folded into an odd sketch, a bitmap in which each sample
   flips one bit.  The number of ones in the XOR of two sketches estimates a high
   similarity well.
2. Buckets with the same members are looked at once.  Inside a bucket, sketches and
   set sizes sort out pairs that are clearly below the limit (``MARGIN`` under it,
   five standard deviations of the estimate); what remains connected is passed on as
   stars, one edge a row.
3. The connected families of those stars hold every link that the bands found.  Each
   family's full sets are compared exactly, and the stars of the true links give the
   components.

No step lists the pairs of a group: buckets and families are dealt in blocks, every
two blocks meet in one task, and a task returns at most as many edges as it has rows.
The share of links lost by the bands is (1 - s^ROWS)^BANDS, 3e-9 at a similarity of
0.85, and a document is lost to its component only when all its links are.

Defined results: without words or text a set is empty, linked with nothing, and kept;
with fewer words than a shingle the whole sequence is the one shingle.  In the report
rows that repeat an id and a set share a verdict, and null ids are never a component's
id unless it has no other; such rows are kept only then.  The filter decides by row:
of each component exactly one row stays, that of the smallest id (null last), then of
the smallest class, then of the smallest row key; of rows equal in all columns any one.
Every row without words stays.  An empty table gives an empty table; other columns are
ignored but for that key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.exprs import NOT_SPACE
from lakeops.llm.graph import components
from lakeops.session import materialise

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 42, 6
BITS = 512
MARGIN = 0.13
BLOCK = 128
BLOCK_SHINGLES = 2_000_000
WORD_CACHE = 500_000
SEED = 0x5EED

_FOLD = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: multiply and shift until every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN + np.uint64(seed)) | np.uint64(1)


class Words(dict):
    """Word -> 64-bit hash, bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, words: Words, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    found = (text or "").encode().translate(_FOLD).split()
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(size, len(hashed))
    weights = odd_numbers(size, SEED)
    total = np.full(len(hashed) - width + 1, width, np.uint64)
    for j in range(width):
        total += hashed[j : len(hashed) - width + 1 + j] * weights[j]
    return np.unique(mix(total))


class MinHash:
    def __init__(self, samples: int, seed: int = SEED):
        self.a = (odd_numbers(samples, seed + 1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.b = (odd_numbers(samples, seed + 2) >> np.uint64(32)).astype(np.uint32)

    def of(self, hashes: np.ndarray, chunk: int = 1024) -> np.ndarray:
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        best = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), chunk):
            values = np.multiply.outer(self.a, x[at : at + chunk])
            values += self.b[:, None]
            np.minimum(best, values.min(axis=1), out=best)
        return best


def band_keys(samples: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(documents, bands * rows) to (documents, bands) signed keys."""
    parts = samples.reshape(len(samples), bands, rows).astype(np.uint64)
    weights = odd_numbers(rows, SEED + 3)
    total = (parts * weights).sum(axis=2, dtype=np.uint64) + odd_numbers(bands, SEED + 4)
    return mix(total).view(np.int64)


def odd_sketches(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(documents, samples) to (documents, bits / 64) words; a sample flips the bit its index and value hash to."""
    n, k = samples.shape
    place = mix(samples.astype(np.uint64) * _GOLDEN + odd_numbers(k, SEED + 5)) % np.uint64(bits)
    at = place + np.arange(n, dtype=np.uint64)[:, None] * np.uint64(bits)
    flips = np.bincount(at.ravel().astype(np.int64), minlength=n * bits) & 1
    return np.packbits(flips.astype(np.uint8).reshape(n, bits), axis=1).view(np.uint64)


def estimate(differing: np.ndarray, samples: int, bits: int = BITS) -> np.ndarray:
    """Similarity from the ones in the XOR of two odd sketches."""
    rest = np.maximum(1 - 2 * differing / bits, 1e-9)
    return 1 + bits / (4 * samples) * np.log(rest)


def stars(links: np.ndarray, nodes: np.ndarray) -> tuple[list[int], list[int]]:
    """Ties every node to the smallest of its component; ``links`` is symmetric."""
    order = np.argsort(nodes, kind="stable")
    links, nodes = links[np.ix_(order, order)], nodes[order]
    left = np.ones(len(links), bool)
    centre, tied = [], []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            new = np.flatnonzero(links[queue.pop()] & left)
            left[new] = False
            queue.extend(new.tolist())
            centre.extend([int(nodes[root])] * len(new))
            tied.extend(nodes[new].tolist())
    return centre, tied


def alike_by_sketch(sketches: np.ndarray, sizes: np.ndarray, percent: int, samples: int) -> np.ndarray:
    differing = np.bitwise_count(sketches[:, None, :] ^ sketches[None, :, :]).sum(axis=2, dtype=np.int64)
    near = estimate(differing, samples, sketches.shape[1] * 64) >= percent / 100 - MARGIN
    low, high = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    return near & (100 * low >= percent * high)


def shared(sets: list[np.ndarray], chunk: int = 8192) -> np.ndarray:
    """Sizes of the intersections of different sets, by products of incidence matrices over slices of the shingles.

    Shingles that only one set has are left out, so the diagonal is not the sets' sizes.
    """
    n = len(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows, column = rows[count[column] > 1], column[count[column] > 1]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    total = np.zeros((n, n), np.int64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, chunk):
        a, b = np.searchsorted(column, [low, low + chunk])
        present = np.zeros((n, chunk), np.float32)
        present[rows[a:b], column[a:b] - low] = 1
        total += (present @ present.T).astype(np.int64)  # sums of ones up to the chunk's width are exact
    return total


def alike_exactly(sets: list[np.ndarray], percent: int) -> np.ndarray:
    sizes = np.array([len(s) for s in sets])
    both = shared(sets)
    return 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of equal values in the first ``keys`` columns of sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in codes:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change).tolist()
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for stop in starts:
            held.append(batch.slice(at, stop - at))
            yield pa.Table.from_batches(held)
            held, at = [], stop
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _edges(batches: Iterator[pa.RecordBatch], alike) -> Iterator[pa.RecordBatch]:
    """Stars of each group's linked rows; columns: three keys, node, block, and what ``alike`` reads."""
    one: list[int] = []
    other: list[int] = []

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(other, pa.int64())], ["a", "b"])
        one.clear()
        other.clear()
        return out

    for group in _groups(batches, 3):
        if group.num_rows > 1:
            a, b = stars(alike(group), group.column("node").to_numpy())
            one.extend(a)
            other.extend(b)
            if len(one) > 10_000:
                yield flush()
    yield flush()


def _in_blocks(members: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Deals the members of each key into blocks; a row for every pair of blocks its own is in."""
    dealt = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    paired = dealt.select("*", other)
    return paired.select(
        F.col(key).alias("key"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        *(c for c in members.columns if c != key),
    )


def _dealt(paired: DataFrame) -> DataFrame:
    return paired.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """128-bit hash of all columns but the id."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    # JSON escapes control characters, so the mark before it is the last one
    return F.unhex(F.md5(F.concat_ws("\x1f", F.col(text_col), F.to_json(F.struct(*rest)) if rest else F.lit(""))))


def signatures(keyed: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, row, n_shingles, class, bands, sketch`` of ``doc_id, text, row``.

    The class is a 128-bit hash of the set, null for an empty one.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words, sampler = Words(), MinHash(bands * rows)
        for batch in batches:
            count, classes = [], []
            samples = np.full((batch.num_rows, bands * rows), 0xFFFFFFFF, np.uint32)
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = shingles(text, words)
                count.append(len(found))
                classes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                if len(found):
                    samples[i] = sampler.of(found)
            keys, sketches = band_keys(samples, bands, rows), odd_sketches(samples)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"), pa.array(count, pa.int64()), pa.array(classes, pa.binary()),
                    pa.array(list(keys), pa.list_(pa.int64())), pa.array([s.tobytes() for s in sketches], pa.binary()),
                ],
                ["doc_id", "row", "n_shingles", "class", "bands", "sketch"],
            )

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(
        sign, f"doc_id {kind}, row binary, n_shingles bigint, class binary, bands array<bigint>, sketch binary"
    )


def candidate_edges(classes: DataFrame, percent: int, samples: int, block: int) -> DataFrame:
    """Stars of what is connected by pairs that share a bucket and pass sketch and size."""
    placed = classes.select("node", F.explode("bands").alias("key"))
    buckets = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("members"), F.min("node").alias("first")
    ).where("n > 1")
    once = buckets.groupBy("n", "members", "first").agg(F.min("key").alias("key")).select("key", "n")
    # Spark takes an exploded array for one value: neither side of the join on the keys may be broadcast by its estimate
    inside = placed.join(once.hint("merge"), "key").join(classes.select("node", "n_shingles", "sketch"), "node")
    blocks = F.ceil(F.col("n") / block)
    paired = _in_blocks(inside.select("key", "n", "node", "n_shingles", "sketch"), "key", blocks).drop("n")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def alike(group: pa.Table) -> np.ndarray:
            raw = b"".join(group.column("sketch").to_pylist())
            sketches = np.frombuffer(raw, np.uint64).reshape(group.num_rows, -1)
            return alike_by_sketch(sketches, group.column("n_shingles").to_numpy(), percent, samples)

        return _edges(batches, alike)

    return _dealt(paired).mapInArrow(compare, "a bigint, b bigint")


def class_texts(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """The columns of ``classes`` and a ``text`` of each class: that of the one row that stands for it."""
    wanted = classes.withColumn("of", F.struct(F.col("rep").alias("doc_id"), F.col("rep_row").alias("row")))
    texts = keyed.select(F.struct("doc_id", "row").alias("of"), "text")
    return texts.join(wanted.hint("merge"), "of").dropDuplicates(["of"]).drop("of")


def confirmed_edges(
    keyed: DataFrame, families: DataFrame, percent: int, block: int, block_shingles: int
) -> DataFrame:
    """Stars of what true links connect inside each family, on full sets.

    ``families`` has ``node, rep, rep_row, n_shingles, family`` per class, ``keyed`` has ``doc_id, text, row``.
    """

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            sets = [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("family", "blocks", "node")] + [pa.array(sets, pa.binary())],
                ["family", "blocks", "node", "set"],
            )

    many = families.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("total") / block_shingles))
    wanted = families.join(many.select("family", blocks.alias("blocks")), "family").select(
        "rep", "rep_row", "family", "blocks", "node"
    )
    sets = (
        class_texts(keyed, wanted).select("family", "blocks", "node", "text")
        .mapInArrow(full, "family bigint, blocks bigint, node bigint, set binary")
    )
    paired = _in_blocks(sets, "family", F.col("blocks")).drop("blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def alike(group: pa.Table) -> np.ndarray:
            return alike_exactly([np.frombuffer(s, np.uint64) for s in group.column("set").to_pylist()], percent)

        return _edges(batches, alike)

    return _dealt(paired).mapInArrow(compare, "a bigint, b bigint")


def _resolved(
    docs: DataFrame, id_col: str, text_col: str, key: Column, percent: int, bands: int, rows: int, block: int,
    block_shingles: int,
) -> tuple[DataFrame, DataFrame]:
    """The signatures, and ``class, rep, rep_row, component`` per class; equal components belong together."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), key.alias("row"))
    signed = materialise(signatures(keyed, bands, rows), "near-signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = materialise(
        signed.where("class is not null").groupBy("class").agg(
            first, F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"),
        ).select(
            "class", F.col("first.doc_id").alias("rep"), F.col("first.row").alias("rep_row"), "n_shingles", "bands",
            "sketch", F.monotonically_increasing_id().alias("node"),
        ),
        "near-classes",
    )
    families = components(candidate_edges(classes, percent, bands * rows, block), "near-families")
    named = materialise(
        families.withColumnRenamed("component", "family").join(
            classes.select("node", "rep", "rep_row", "n_shingles"), "node"
        ),
        "near-named",
    )
    linked = components(
        confirmed_edges(keyed, named, percent, block, block_shingles), "near-components"
    )
    of_class = classes.select("node", "class", "rep", "rep_row").join(linked, "node", "left").select(
        "class", "rep", "rep_row", F.coalesce("component", "node").alias("component")
    )
    return signed, of_class


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    key = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    signed, classes = _resolved(docs, id_col, text_col, key, percent, bands, rows, block, block_shingles)
    least = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = classes.join(least, "component").select("class", "component_id")
    out = signed.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def without_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row of each component and every row without words, with their columns as they are."""
    key = row_key(docs, id_col, text_col)
    signed, classes = _resolved(docs, id_col, text_col, key, percent, bands, rows, block, block_shingles)
    first = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "class", "rep_row")).alias("first")
    chosen = classes.groupBy("component").agg(first).select(F.struct("first.rep", "first.rep_row"))
    wordless = signed.where("class is null").select(F.struct("doc_id", "row")).distinct()
    wanted = chosen.union(wordless).toDF("of").hint("merge")
    # rows without words are all told apart, others by id and key alone
    alone = F.when(~F.coalesce(F.col(text_col).rlike(NOT_SPACE), F.lit(False)), F.monotonically_increasing_id())
    whole = docs.select(
        F.struct(F.col(id_col), key).alias("of"), alone.alias("alone"), F.struct("*").alias("whole")
    )
    return whole.join(wanted, "of", "left_semi").dropDuplicates(["of", "alone"]).select("whole.*")
