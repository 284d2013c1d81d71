"""Text rendering, batched embedding, vector and hybrid top-k."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.text import template, text_or
from lakeops.operators.joins import keep_not_in
from lakeops.operators.topk import dedup_keep_first, top_n_per_group, union_tagged
from lakeops.operators.windows import max_normalise
from lakeops.session import materialise


def render_text(
    df: DataFrame, parts: Sequence[str | Column], out: str = "text", null_as: str | None = None
) -> DataFrame:
    """One sentence per row from literals, columns and conditional clauses.

    A null part makes the text null unless ``null_as`` is given.
    """
    return df.withColumn(out, template(parts, null_as))


def render_sections(
    df: DataFrame, sections: dict[str, dict[str, Column | str]], out: str = "text", missing: str = "unknown"
) -> DataFrame:
    """Labelled sections joined by newlines: ``{title: {label: column}}``; nulls become ``missing``."""
    lines = []
    for title, fields in sections.items():
        lines.append(F.lit(f"{title}:"))
        for label, col in fields.items():
            value = F.col(col) if isinstance(col, str) else col
            lines.append(F.concat(F.lit(f"{label}: "), text_or(value, missing)))
    return df.withColumn(out, F.concat_ws("\n", *lines))


def metadata_struct(df: DataFrame, cols: Sequence[str], out: str = "metadata") -> DataFrame:
    """The filterable fields of a row as one struct."""
    return df.withColumn(out, F.struct(*cols))


def embed(
    df: DataFrame,
    id_col: str,
    text_col: str,
    fn: Callable[[list[str]], Sequence[Sequence[float]]],
    batch: int = 20,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Vector per row from a model call that takes ``batch`` texts at a time.

    Runs where the rows are: no numbering, no driver loop, one pass.  A null text does not
    reach the model and has a null vector.  Only the texts of one call are Python objects at a
    time, and rows leave as slices of the Arrow batch they came in.
    """
    src = df.select(id_col, text_col, *carry)
    schema = T.StructType([*src.schema.fields, T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    at_text = src.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                some = rows.slice(at, batch)
                texts = some.column(at_text).to_pylist()
                there = [t for t in texts if t is not None]
                made = iter(fn(there) if there else [])
                vectors = [None if t is None else [float(x) for x in next(made)] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(vectors, pa.list_(pa.float64()))], [*some.schema.names, "embedding"]
                )

    return src.mapInArrow(run, schema)


def words(col: Column) -> Column:
    """Lower-case words of a text."""
    return F.array_remove(F.split(F.lower(col), r"[^\p{L}\p{N}]+"), "")


def hash_embed(df: DataFrame, id_col: str, text_col: str, dims: int = 256) -> DataFrame:
    """Default embedding: hashed term frequencies weighted by inverse document frequency, length 1."""
    tokens = df.select(id_col, text_col, words(F.coalesce(F.col(text_col), F.lit(""))).alias("_w"))
    stages = [
        HashingTF(inputCol="_w", outputCol="_tf", numFeatures=dims),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    fitted = Pipeline(stages=stages).fit(tokens)
    return fitted.transform(tokens).select(id_col, text_col, vector_to_array("_unit").alias("embedding"))


def incremental_embed(
    df: DataFrame,
    done: DataFrame,
    id_col: str,
    text_col: str,
    fn: Callable[[list[str]], Sequence[Sequence[float]]],
    batch: int = 20,
    null_aware: bool = True,
) -> DataFrame:
    """Vectors of only those ids that ``done`` does not hold yet; append the result to it."""
    return embed(keep_not_in(df, done, id_col, null_aware), id_col, text_col, fn, batch)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays; null when one has length zero."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(
            F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v
        )

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return dot(a, b) / F.nullif(norm, F.lit(0.0))


QUERY_BLOCK = 2_048
INDEX_BLOCK = 16_384


def _pieces(n: int, size: int, tasks: int) -> int:
    """Number of blocks of at most ``size`` rows; more, down to a sixteenth of that, while tasks would idle."""
    return max(1, -(-n // size), min(tasks, -(-n * 16 // size)))


def _every(count: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.lit(count) if isinstance(count, int) else count) - 1))


def _own(name: str, count: Column | int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(count) if isinstance(count, int) else count).cast("int")


def _blocks(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_size: int, right_size: int
) -> tuple[DataFrame, DataFrame]:
    """Deal both sides into blocks so that every left block meets every right block in one group.

    The sizes are rows of a block, so a group stays as large as it is however many rows
    there are.  A row of one side is repeated once per block of the other.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, m = _pieces(left.count(), left_size, 1), _pieces(right.count(), right_size, tasks)
    l = left.withColumn("_i", _own(left_id, n)).withColumn("_j", _every(m))
    r = right.withColumn("_j", _own(right_id, m)).withColumn("_i", _every(n))
    return l, r


def _unit(vectors) -> np.ndarray:
    m = np.array(vectors.tolist(), dtype=np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.full_like(m, np.nan), where=norm > 0)


def _scored_blocks(
    left: DataFrame, right: DataFrame, by: Sequence[str], k: int, query_id: str, index_id: str, schema: T.StructType
) -> DataFrame:
    """One matrix product per group of ``by``; the k best per query of each group, then of all."""

    def best(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if q.empty or x.empty:
            return pd.DataFrame({query_id: q[query_id].iloc[:0], index_id: x[index_id].iloc[:0], "score": []})
        return _keep_best(_unit(q["_v"]) @ _unit(x["_v"]).T, q[query_id], x[index_id], k, query_id, index_id)

    kept = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(best, schema)
    return top_n_per_group(kept, query_id, ["-score", index_id], k, out="rank")


def _hit_schema(queries: DataFrame, index: DataFrame, query_id: str, index_id: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(index_id, index.schema[index_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def vector_topk(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    query_id: str = "query_id",
    index_id: str = "id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    index_block: int = INDEX_BLOCK,
) -> DataFrame:
    """The k most similar index rows of every query, with ``score`` and ``rank``: the exact way.

    Blocks of queries meet blocks of the index; a group scores its rows with one matrix product
    and keeps its k best per query.  Only those meet in the last shuffle.  Neither side passes the
    driver, the plan is the same for any number of queries, and rows without a vector match nothing.
    """
    asked = queries.filter(F.col(vector).isNotNull()).select(query_id, F.col(vector).cast("array<double>").alias("_v"))
    found = index.filter(F.col(vector).isNotNull()).select(index_id, F.col(vector).cast("array<double>").alias("_v"))
    left, right = _blocks(asked, found, query_id, index_id, query_block, index_block)
    return _scored_blocks(left, right, ["_i", "_j"], k, query_id, index_id, _hit_schema(queries, index, query_id, index_id))


@dataclass
class VectorIndex:
    """Centres of the lists, and every row in the list of its nearest centre.

    ``centres`` are at most ``MAX_LISTS`` unit vectors; ``rows`` is a stored table
    ``_list, id, _v``, partitioned by nothing and read by list.
    """

    centres: np.ndarray
    rows: DataFrame
    index_id: str


MAX_LISTS = 4_096
SAMPLE_ROWS = 65_536


def _nearest(df: DataFrame, centres, ids: Sequence[str], probes: int) -> DataFrame:
    """Each row once per list of its ``probes`` nearest centres, as column ``_list``."""
    schema = T.StructType([df.schema[c] for c in (*ids, "_v")] + [T.StructField("_list", T.ArrayType(T.IntegerType()))])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = centres.value
        for pdf in batches:
            near = [[]] * len(pdf)
            if len(pdf) and len(own):
                near = np.argsort(-(_unit(pdf["_v"]) @ own.T), axis=1, kind="stable")[:, :probes]
            yield pdf.assign(_list=[list(map(int, x)) for x in near])

    placed = df.select(*ids, "_v").mapInPandas(place, schema)
    return placed.withColumn("_list", F.explode("_list"))


def vector_index(
    index: DataFrame,
    index_id: str = "id",
    vector: str = "embedding",
    lists: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
    iterations: int = 10,
    seed: int = 7,
) -> VectorIndex:
    """An inverted file over all rows that have a vector of length above zero.

    The centres are fitted by k-means on about ``sample_rows`` rows, drawn by a hash of
    the id over the whole table; every row is then put into the list of its nearest
    centre and stored once.  ``lists`` is the square root of the number of rows unless
    given, ``MAX_LISTS`` at most.
    """
    found = index.select(index_id, F.col(vector).cast("array<double>").alias("_v"))
    found = found.filter(F.exists("_v", lambda x: x != 0))
    n = found.count()
    lists = max(1, min(lists or math.isqrt(n), MAX_LISTS, n or 1))
    share = min(1.0, sample_rows / max(n, 1))
    # over a million buckets of the hash, so that the sample is spread over every source and file
    drawn = found.filter(F.pmod(F.xxhash64(index_id, F.lit(seed)), F.lit(1_000_000)) < math.ceil(share * 1_000_000))
    if n:
        units = drawn.select(array_to_vector("_v").alias("features"))
        fitted = KMeans(k=lists, distanceMeasure="cosine", maxIter=iterations, seed=seed).fit(units)
        centres = _unit(pd.Series([c.tolist() for c in fitted.clusterCenters()]))
    else:
        centres = np.zeros((0, 0))  # no list, so no query finds one
    sent = index.sparkSession.sparkContext.broadcast(centres)
    placed = _nearest(found, sent, [index_id], 1).repartition("_list").sortWithinPartitions("_list")
    return VectorIndex(centres, materialise(placed, "vector-index"), index_id)


def probe_topk(
    queries: DataFrame,
    index: VectorIndex,
    k: int,
    probes: int = 8,
    query_id: str = "query_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    index_block: int = INDEX_BLOCK,
) -> DataFrame:
    """The k most similar rows among the ``probes`` lists nearest to each query, with exact scores.

    A list is cut into blocks of ``index_block`` rows and its queries into blocks of
    ``query_block``, so a group keeps its size while lists grow.  With as many probes as
    lists the result is that of :func:`vector_topk`.
    """
    asked = queries.select(query_id, F.col(vector).cast("array<double>").alias("_v"))
    asked = asked.filter(F.exists("_v", lambda x: x != 0))
    sent = queries.sparkSession.sparkContext.broadcast(index.centres)
    wanted = materialise(_nearest(asked, sent, [query_id], min(probes, len(index.centres))), "vector-probes")
    sizes = index.rows.groupBy("_list").agg(F.count(F.lit(1)).alias("_n"))
    loads = wanted.groupBy("_list").agg(F.count(F.lit(1)).alias("_q"))
    blocks = F.broadcast(  # a row per list, MAX_LISTS at most
        sizes.join(loads, "_list").select(
            "_list", F.ceil(F.col("_n") / index_block).cast("int").alias("_parts"), F.ceil(F.col("_q") / query_block).cast("int").alias("_turns")
        )
    )
    left = wanted.join(blocks, "_list").withColumn("_i", _own(query_id, F.col("_turns"))).withColumn("_j", _every(F.col("_parts")))
    right = index.rows.join(blocks, "_list").withColumn("_j", _own(index.index_id, F.col("_parts"))).withColumn("_i", _every(F.col("_turns")))
    slim = lambda df, name: df.select("_list", "_i", "_j", name, "_v")
    schema = _hit_schema(queries, index.rows, query_id, index.index_id)
    return _scored_blocks(slim(left, query_id), slim(right, index.index_id), ["_list", "_i", "_j"], k, query_id, index.index_id, schema)


def probes_for(
    index: VectorIndex, queries: DataFrame, truth: DataFrame, recall: float = 0.95, query_id: str = "query_id", vector: str = "embedding"
) -> int:
    """The fewest lists to probe that hold a share ``recall`` of the true neighbours of ``queries``.

    ``truth`` are their exact hits, by :func:`vector_topk` on a sample of queries.  How far
    down a query's order of lists each neighbour's list stands is counted in the cluster;
    the driver gets a row per place, ``MAX_LISTS`` at most.
    """
    asked = queries.select(query_id, F.col(vector).cast("array<double>").alias("_v")).filter(F.exists("_v", lambda x: x != 0))
    sent = queries.sparkSession.sparkContext.broadcast(index.centres)
    schema = T.StructType([asked.schema[query_id], T.StructField("_order", T.ArrayType(T.IntegerType()))])

    def orders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            near = np.argsort(-(_unit(pdf["_v"]) @ sent.value.T), axis=1, kind="stable") if len(pdf) else []
            yield pd.DataFrame({query_id: pdf[query_id], "_order": [list(map(int, x)) for x in near]})

    wanted = truth.select(query_id, index.index_id).join(index.rows.select(index.index_id, "_list"), index.index_id)
    placed = wanted.join(asked.mapInPandas(orders, schema), query_id)
    counts = placed.groupBy(F.array_position("_order", F.col("_list")).alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, held = sum(r.n for r in counts), 0
    for r in sorted(counts, key=lambda r: r.place):
        held += r.n
        if held >= recall * total:
            return int(r.place)
    return 1


def recall_at(found: DataFrame, truth: DataFrame, query_id: str = "query_id", index_id: str = "id") -> DataFrame:
    """``hits, wanted, recall`` of one result against another."""
    got = found.select(query_id, index_id).withColumn("_hit", F.lit(1))
    both = truth.select(query_id, index_id).join(got, [query_id, index_id], "left")
    return both.agg(F.count("_hit").alias("hits"), F.count(F.lit(1)).alias("wanted")).withColumn("recall", F.col("hits") / F.col("wanted"))


def _keep_best(scores: np.ndarray, rows: pd.Series, cols: pd.Series, k: int, row_name: str, col_name: str) -> pd.DataFrame:
    """Highest k of each row of a score matrix, ties to the smallest column id; NaN is no score."""
    order = np.argsort(cols.to_numpy(), kind="stable")
    scores, ids = scores[:, order], cols.to_numpy()[order]
    ranked = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    at = np.repeat(np.arange(len(scores)), ranked.shape[1])
    picked = ranked.ravel()
    value = scores[at, picked]
    good = ~np.isnan(value)
    return pd.DataFrame({row_name: rows.to_numpy()[at[good]], col_name: ids[picked[good]], "score": value[good]})


BLOCK_DOCS = 16_384


@dataclass
class KeywordIndex:
    """Postings stored once, in blocks of documents, with the highest share of each word in each block.

    ``postings``: ``_block, term, ids, parts, lens``, one row per word and block, whose lists
    are as long as a block has documents at most; ``terms``: ``term, idf``; ``peaks``:
    ``_block, term, peak, dense``, the highest part and the highest part per length.
    """

    postings: DataFrame
    terms: DataFrame
    peaks: DataFrame
    doc_id: str


def keyword_index(
    docs: DataFrame,
    doc_id: str = "id",
    text: str = "text",
    k1: float = 1.2,
    b: float = 0.75,
    vocabulary: DataFrame | None = None,
    block_docs: int = BLOCK_DOCS,
) -> KeywordIndex:
    """BM25 postings of all documents, or of the words ``vocabulary`` (``term``) alone; null ids cannot be found."""
    split = docs.select(doc_id, words(F.coalesce(F.col(text), F.lit(""))).alias("_w")).withColumn("_len", F.size("_w"))
    own = F.coalesce(F.regexp_count(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}]+")), F.lit(0))  # as many as the split gives
    n, mean = docs.agg(F.count(F.lit(1)), F.avg(own)).first()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = split.filter(F.col(doc_id).isNotNull()).select(doc_id, "_len", F.explode("_w").alias("term"))
    if vocabulary is not None:
        each = each.join(vocabulary, "term", "left_semi")
    # one document is one row, so no document is hot
    counted = each.repartition(doc_id).groupBy(doc_id, "_len", "term").agg(F.count(F.lit(1)).alias("_tf"))
    part = F.col("_tf") * (k1 + 1) / (F.col("_tf") + k1 * (1 - b + b * F.col("_len") / F.lit(mean or 1.0)))
    entry = F.struct(F.col(doc_id).alias("id"), part.alias("part"), F.col("_len").alias("len"))
    listed = counted.select(_own(doc_id, _pieces(n, block_docs, tasks)).alias("_block"), "term", entry.alias("_e"))
    held = listed.groupBy("_block", "term").agg(F.collect_list("_e").alias("_e"))  # at most a block's documents
    postings = materialise(held.select("_block", "term", *(F.col(f"_e.{f}").alias(f"{f}s") for f in ("id", "part", "len"))), "postings")
    df = postings.groupBy("term").agg(F.sum(F.size("ids")).alias("_df"))
    idf = F.log(1 + (F.lit(n) - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    dense = F.array_max(F.transform(F.arrays_zip("parts", "lens"), lambda x: x["parts"] / (1 + x["lens"])))
    peaks = postings.select("_block", "term", F.array_max("parts").alias("peak"), dense.alias("dense"))
    return KeywordIndex(postings, df.select("term", idf.alias("idf")), peaks, doc_id)


#: Lists by name: whether a score is divided by one more than the document's words, and its digits.
PLAIN = {"words": (False, 6)}


def keyword_lists(
    queries: DataFrame,
    index: KeywordIndex,
    k: int,
    query_id: str = "query_id",
    text: str = "text",
    lists: dict[str, tuple[bool, int]] = PLAIN,
    query_block: int | None = None,
) -> DataFrame:
    """The k documents with the best BM25 score per query and list: ``list, query_id, id, score, rank``.

    A query first meets the block with its highest bound, which gives a score to beat;
    then only the blocks whose bound, the sum of the peaks of its words, can still reach
    that.  A task reads a block's postings once and lets the block's queries pass by, so
    the index is never copied per query; with ``query_block`` it is read once per so many
    queries, each in a task of its own.  Scores are rounded before they are ranked.
    """
    doc_id = index.doc_id
    turns = _pieces(queries.count(), query_block, 1) if query_block else 1
    asked = queries.select(query_id, F.explode(F.array_distinct(words(F.col(text)))).alias("term"))
    weighed = materialise(asked.join(index.terms, "term"), "asked-words")
    terms = weighed.groupBy(query_id).agg(F.collect_list(F.struct("term", "idf")).alias("_terms"))  # a query's own words
    bound = weighed.join(index.peaks, "term").groupBy(query_id, "_block").agg(
        F.sum(F.col("idf") * F.col("peak")).alias("plain"), F.sum(F.col("idf") * F.col("dense")).alias("dense")
    )
    bounds = materialise(bound, "block-bounds")

    def hits(pairs: DataFrame) -> DataFrame:
        return _stream_blocks(index, pairs.select(query_id, "_block").join(terms, query_id), query_id, queries.schema[query_id].dataType, k, lists, turns)

    first = top_n_per_group(bounds, query_id, ["-plain", "_block"], 1)
    seed = materialise(hits(first), "first-hits")
    beaten = seed.groupBy("list", query_id).agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    spread = beaten.filter(F.col("n") >= k).groupBy(query_id).pivot("list", list(lists)).agg(F.first("least"))
    rest = bounds.join(first.select(query_id, "_block"), [query_id, "_block"], "left_anti").join(spread, query_id, "left")
    reach = F.lit(False)
    for name, (per_length, digits) in lists.items():
        reach = reach | F.col(f"`{name}`").isNull() | (F.col("dense" if per_length else "plain") + 10.0**-digits >= F.col(f"`{name}`"))
    every = seed.unionByName(hits(rest.filter(reach)))
    return top_n_per_group(every, ["list", query_id], ["-score", doc_id], k, out="rank")


def _stream_blocks(
    index: KeywordIndex, pairs: DataFrame, query_id: str, kind: T.DataType, k: int, lists: dict[str, tuple[bool, int]], turns: int = 1
) -> DataFrame:
    """Scores each ``(query, block, words)`` row against its block; postings come first within a block and turn."""
    doc_id, id_kind = index.doc_id, index.postings.schema["ids"].dataType.elementType
    pairs = pairs.withColumn("_cell", F.col("_block").cast("long") * turns + _own(query_id, turns))
    blocks = pairs.select("_block", "_cell").distinct()
    stored = index.postings.join(blocks, "_block").select(
        F.col("_cell").alias("_block"), F.lit(0).alias("_kind"), F.lit(None).cast(kind).alias("_q"), F.lit(None).cast(pairs.schema["_terms"].dataType).alias("_terms"),
        "term", "ids", "parts", "lens",
    )
    passing = pairs.select(F.col("_cell").alias("_block"), F.lit(1).alias("_kind"), F.col(query_id).alias("_q"), "_terms")
    laid = stored.unionByName(passing, allowMissingColumns=True).repartition("_block").sortWithinPartitions("_block", "_kind")
    schema = T.StructType(
        [T.StructField("list", T.StringType()), T.StructField(query_id, kind), T.StructField(doc_id, id_kind), T.StructField("score", T.DoubleType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held, ready = None, {}, None

        def prepared():
            ids = np.unique(np.concatenate([h[0] for h in held.values()]))
            length = np.zeros(len(ids))
            words_of = {}
            for term, (own, parts, lens) in held.items():
                at = np.searchsorted(ids, own)
                length[at] = lens
                words_of[term] = (at, parts)
            return ids, length, words_of

        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row[0] != block:
                    block, held, ready = row[0], {}, None
                if row[1] == 0:
                    held[row.term] = (np.asarray(row.ids), np.asarray(row.parts), np.asarray(row.lens))
                    continue
                ids, length, words_of = ready = ready or prepared()
                score, seen = np.zeros(len(ids)), np.zeros(len(ids), bool)
                for word in row[3]:
                    if word["term"] in words_of:
                        at, parts = words_of[word["term"]]
                        score[at] += word["idf"] * parts
                        seen[at] = True
                there = np.flatnonzero(seen)
                for name, (per_length, digits) in lists.items():
                    value = np.round(score[there] / (1 + length[there]) if per_length else score[there], digits)
                    best = np.argsort(-value, kind="stable")[:k]
                    out += [(name, row[2], ids[there[i]], value[i]) for i in best]
            yield pd.DataFrame(out, columns=schema.names)

    return laid.mapInPandas(run, schema)


def keyword_topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    query_id: str = "query_id",
    doc_id: str = "id",
    text: str = "text",
    k1: float = 1.2,
    b: float = 0.75,
    per_length: bool = False,
    digits: int = 6,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k documents with the best BM25 score of every query, with ``score`` and ``rank``.

    One list of :func:`keyword_lists`, over an index of the queries' own words.  With
    ``per_length`` a score is divided by one more than the document's number of words.
    """
    index = keyword_index(docs, doc_id, text, k1, b, query_words(queries, text))
    return keyword_lists(queries, index, k, query_id, text, {"words": (per_length, digits)}, query_block).drop("list")


def query_words(queries: DataFrame, text: str = "text") -> DataFrame:
    """The distinct words of all queries."""
    return queries.select(F.explode(F.array_distinct(words(F.col(text)))).alias("term")).distinct()


def hybrid_topk(
    vector_hits: DataFrame,
    keyword_hits: DataFrame,
    k: int,
    query_id: str = "query_id",
    doc_id: str = "id",
    depth: int = 60,
) -> DataFrame:
    """Reciprocal-rank fusion of two scored lists: sum of 1/(depth + rank) over each list's best."""
    lists = []
    for hits in (vector_hits, keyword_hits):
        best = top_n_per_group(hits.select(query_id, doc_id, "score"), query_id, ["-score", doc_id], k, out="_r")
        lists.append(best.select(query_id, doc_id, (F.lit(1.0) / (depth + F.col("_r"))).alias("_s")))
    fused = lists[0].unionByName(lists[1]).groupBy(query_id, doc_id).agg(F.sum("_s").alias("score"))
    return top_n_per_group(fused, query_id, ["-score", doc_id], k, out="rank")


def merge_indexes(
    hits: dict[str, DataFrame],
    k: int = 10,
    per_index: int = 8,
    query_id: str = "query_id",
    doc_id: str = "id",
    text: str = "text",
    texts: DataFrame | None = None,
) -> DataFrame:
    """One ranked list per query from the hits of several indexes.

    The best ``per_index`` of each index are scaled by the index's best score (at
    least 1), united in index order, reduced to the first row per text (null or
    empty text goes) and cut to the k best.  ``texts`` (id, text) supplies the text
    of hits that come without one, after the cut.
    """
    parts = {}
    for pos, (name, frame) in enumerate(hits.items()):
        best = top_n_per_group(frame, query_id, ["-score", doc_id], per_index, out="_r")
        parts[name] = max_normalise(best, query_id, "score").withColumn("_pos", F.lit(pos))
    united = union_tagged(parts, "source")
    if texts is not None:
        united = united.join(texts.select(doc_id, text), doc_id)
    united = united.filter(F.col(text).isNotNull() & (F.col(text) != ""))
    once = dedup_keep_first(united, [query_id, text], ["_pos", "_r"])
    ranked = top_n_per_group(once, query_id, ["-norm_score", "_pos", "_r"], k, out="rank")
    return ranked.drop("_pos", "_r")


def build_context(
    ranked: DataFrame, query_id: str = "query_id", rank: str = "rank", source: str = "source", text: str = "text"
) -> DataFrame:
    """Numbered block of at most k ranked texts per query."""
    entry = F.concat(
        F.lit("\n["), F.col(rank).cast("string"), F.lit("] Source: "), F.col(source), F.lit("\n"), F.col(text), F.lit("\n")
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), entry.alias("t"))))
    return ranked.groupBy(query_id).agg(F.array_join(F.transform(ordered, lambda s: s["t"]), "\n").alias("context"))


def headline_filter(
    df: DataFrame, tickers: DataFrame, title: str = "title", ticker: str = "ticker", head: int = 4
) -> DataFrame:
    """Headlines paired with every ticker their text contains.

    Tickers meet headlines by equality on their first ``head`` characters (shorter ones whole), of
    which a headline has at most ``head`` per position; the match is then confirmed on the text.
    The tickers are stored first, so that their size is known before the headlines are cut: unless
    they are many, the pieces of a headline never leave its task.  Pieces are only cut in lengths
    that a ticker's first characters have.
    """
    wanted = tickers.select(ticker).filter(F.length(ticker) > 0).distinct()
    keyed = materialise(wanted.withColumn("_head", F.substring(ticker, 1, head)), "tickers")
    sizes = [r.k for r in keyed.select(F.length("_head").alias("k")).distinct().collect()]  # at most ``head``
    n, none = F.length(title), F.array().cast("array<string>")

    def pieces(k: int) -> Column:
        return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(F.col(title), i, F.lit(k)))).otherwise(none)

    cut = df.withColumn("_head", F.explode(F.array_distinct(F.concat(none, *map(pieces, sorted(sizes))))))
    return cut.join(keyed, "_head").filter(F.contains(F.col(title), F.col(ticker))).drop("_head")
