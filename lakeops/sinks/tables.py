"""Batch sinks and table maintenance on plain Parquet tables.

Nothing overwrites a table while reading it: changed rows are first written to
the shared scratch folder and then moved in by one write.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions.times import day_parts
from lakeops.operators.ordered import names
from lakeops.session import materialise, session_conf
from lakeops.sinks.swap import file_of, files_with, finish_swaps, swap_files
from lakeops.sources.files import read_csv

DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
BUCKET = "_bucket"


def spread(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Group rows by partition value before a partitioned write.

    The rebalance hint lets adaptive execution split a partition value that
    holds a large share of the rows over several tasks and files.
    """
    return df.hint("rebalance", *[F.col(c) for c in cols]) if cols else df


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    fmt: str = "parquet",
    **options,
) -> None:
    """Write to a path (anything with a slash) or a managed table."""
    parts = names(partition_by)
    writer = spread(df, parts).write.format(fmt).mode(mode).options(**options)
    if parts:
        writer = writer.partitionBy(*parts)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def export_single_csv(df: DataFrame, path: str, order: Sequence[str] | None = None) -> None:
    """One CSV part file with a header, for small report tables."""
    one = df.repartition(1)
    if order:
        one = one.sortWithinPartitions(*order)
    one.write.mode("overwrite").option("header", True).csv(path)


def partition_last(df: DataFrame, part: str | Sequence[str]) -> DataFrame:
    parts = names(part)
    return df.select(*[c for c in df.columns if c not in parts], *parts)


def overwrite_partition(df: DataFrame, table: str, part: str | Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df``; create the table on first load."""
    spark = df.sparkSession
    parts = names(part)
    ordered = partition_last(df, parts)
    if not spark.catalog.tableExists(table):
        write_table(ordered, table, partition_by=parts)
        return
    with session_conf(spark, DYNAMIC):
        spread(ordered, parts).write.mode("overwrite").insertInto(table)


def replace_partitions_by_drop(df: DataFrame, table: str, part: str | Sequence[str]) -> None:
    """Clear the partitions present in ``df`` and load it, as one dynamic overwrite.

    No partition value comes to the driver, and there is no moment between drop and append.
    """
    overwrite_partition(df, table, part)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows whose columns may be new; read back with :func:`read_evolving`."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All rows with the union of all columns ever appended."""
    return spark.read.option("mergeSchema", True).parquet(path)


def align_columns(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing in one frame is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r.col_name: r.data_type for r in rows if r.col_name}


def rebuild_table(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Replace all rows of a table by a query that may read the old ones; create it if it isn't there.

    The new rows are first written to the shared folder, so a failed load can be repeated from
    there.  With the same columns they are loaded into the table as it is: format, partitioning
    and properties stay.  With other columns the table is created anew, partitioned and stored as
    before.
    """
    exists = spark.catalog.tableExists(name)
    rows = materialise(df, "rebuild")
    columns = spark.table(name).columns if exists else []
    if exists and sorted(columns) == sorted(rows.columns):
        parts = partition_columns(spark, name)
        with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
            spread(rows.select(*columns), parts).write.mode("overwrite").insertInto(name)
    else:
        parts = [c for c in partition_columns(spark, name) if c in rows.columns] if exists else []
        fmt = _described(spark, name).get("Provider", "parquet") if exists else "parquet"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        write_table(partition_last(rows, parts), name, mode="errorifexists", partition_by=parts, fmt=fmt)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


FILES_PER_TASK, FIELD_BYTES = 64, 16


def _small_tasks(columns: int, max_rows: int) -> dict[str, str]:
    """Sizes for adaptive execution by which a task writes some ``FILES_PER_TASK`` files, where its own would make more."""
    size = max_rows * FILES_PER_TASK * FIELD_BYTES * columns
    if size >= 64 << 20:
        return {}
    return dict.fromkeys(
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"), str(size)
    )


def write_chunked(df: DataFrame, path: str, ts: str, max_rows: int = 100, codec: str = "snappy") -> None:
    """Land rows under year/month/day in files of at most ``max_rows`` rows.

    Small files cost by their number, so small ``max_rows`` make more and smaller tasks.
    """
    parts = day_parts(F.col(ts))
    dated = df.withColumns(parts)
    with session_conf(df.sparkSession, _small_tasks(len(dated.columns), max_rows)):
        (
            spread(dated, list(parts))
            .write.mode("append")
            .partitionBy(*parts)
            .option("maxRecordsPerFile", max_rows)
            .option("compression", codec)
            .parquet(path)
        )


def write_keyed_json(df: DataFrame, path: str, key: str, date: str) -> None:
    """JSON under key/date; a rerun of the same day replaces that day only."""
    with session_conf(df.sparkSession, DYNAMIC):
        spread(df, [key, date]).write.mode("overwrite").partitionBy(key, date).json(path)


def load_csv_to_table(
    spark: SparkSession, path: str, table: str, schema: StructType | str, **options
) -> None:
    """Append landed CSV files (header skipped) to a table."""
    rows = read_csv(spark, path, schema, header=True, **options)
    rows.write.mode("append").saveAsTable(table)


def compact(spark: SparkSession, table: str, target_files: int) -> None:
    """Rewrite a table into ``target_files`` files, or so many per partition value."""
    parts = partition_columns(spark, table)
    rows = materialise(spark.table(table), "compact")
    deal = [*parts, F.pmod(F.xxhash64(*rows.columns), F.lit(target_files))] if parts else []
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
        dealt = rows.repartition(*deal) if parts else rows.repartition(target_files)
        dealt.write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Change rows between two snapshots: ``change`` I, U or D with the new (or deleted) row."""
    keys = names(keys)
    rest = [c for c in new.columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*rest).alias("_o"))
    n = new.select(*[F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)], F.struct(*rest).alias("_n"))
    cond = None
    for i in range(len(keys)):
        test = F.col(f"_k{i}").eqNullSafe(F.col(f"_j{i}"))
        cond = test if cond is None else cond & test
    change = (
        F.when(F.col("_o").isNull(), "I")
        .when(F.col("_n").isNull(), "D")
        .when(~F.col("_o").eqNullSafe(F.col("_n")), "U")
    )
    pick = F.when(F.col("_n").isNull(), F.col("_o")).otherwise(F.col("_n"))
    both = o.join(n, cond, "full_outer").withColumn("change", change).filter(F.col("change").isNotNull())
    chosen = [
        F.when(F.col("_n").isNull(), F.col(f"_k{i}")).otherwise(F.col(f"_j{i}")).alias(k)
        for i, k in enumerate(keys)
    ]
    return both.withColumn("_row", pick).select("change", *chosen, "_row.*")


def apply_diff(old: DataFrame, diff: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The new snapshot from the old one and its change rows."""
    keys = names(keys)
    key = F.struct(*keys)
    kept = old.withColumn("_on", key).join(diff.select(key.alias("_on")), "_on", "left_anti").drop("_on")
    return kept.unionByName(diff.filter("change <> 'D'").drop("change"))


def write_time_partitioned(df: DataFrame, target: str, ts: str, sort_keys: Sequence[str]) -> None:
    """Partition by day, rows sorted inside each file so column statistics prune."""
    day = f"{ts}_date"
    dated = df.withColumn(day, F.to_date(ts))
    # with the date column first the writer needs no further sort
    laid = spread(dated, [day]).sortWithinPartitions(day, *sort_keys)
    writer = laid.write.mode("overwrite").partitionBy(day)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def write_resorted(df: DataFrame, target: str, sort_keys: Sequence[str]) -> None:
    """A second copy of the rows, range-partitioned and sorted by other keys.

    All sort keys take part in the ranges, so a hot first key spans several files.
    """
    laid = df.repartitionByRange(*sort_keys).sortWithinPartitions(*sort_keys)
    writer = laid.write.mode("overwrite")
    if "/" in target:
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def update_where(spark: SparkSession, table: str, cond: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns on the rows where ``cond`` is true; other rows stay as they are.

    Of a partitioned table only the partitions with such rows are rewritten, unless a partition
    column itself changes; of a table without partitions only the files with such rows.
    """
    rows = spark.table(table)
    hit = F.coalesce(cond, F.lit(False))
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def changed(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                F.when(hit, changes[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
                for c in df.columns
            ]
        )

    parts = partition_columns(spark, table)
    if not parts:
        return _rewrite_files(spark, table, hit, changed)
    if set(parts) & set(changes):
        return rebuild_table(spark, table, changed(rows))
    touched = materialise(rows.filter(hit).select(F.struct(*parts).alias("_on")).distinct(), "touched")
    return _replace_touched(spark, table, parts, changed(_in_partitions(rows, parts, touched)))


def delete_where(spark: SparkSession, table: str, cond: Column) -> DataFrame:
    """Remove the rows where ``cond`` is true; a null condition keeps the row.

    Of a partitioned table only the partitions with such rows are rewritten, and those left
    without a row are dropped; of a table without partitions only the files with such rows are
    rewritten.
    """
    rows = spark.table(table)
    hit = F.coalesce(cond, F.lit(False))
    parts = partition_columns(spark, table)
    if not parts:
        return _rewrite_files(spark, table, hit, lambda part: part.filter(~hit))
    touched = materialise(rows.filter(hit).select(F.struct(*parts).alias("_on")).distinct(), "touched")
    left = materialise(_in_partitions(rows, parts, touched).filter(~hit), "left")
    out = _replace_touched(spark, table, parts, left, staged=True)
    still = left.select(F.struct(*parts).alias("_on")).distinct()
    emptied = touched.join(still, "_on", "left_anti").select("_on.*")
    # catalog entries to drop: a part of the table's own list of partitions
    _drop_partitions(spark, table, [r.asDict() for r in emptied.toLocalIterator()])
    return out


def _drop_partitions(spark: SparkSession, table: str, specs: Sequence[dict], at_once: int = 500) -> None:
    """Drop partitions, many in one statement."""
    told = [
        "PARTITION ("
        + ", ".join(f"{p} = " + ("null" if v is None else f"'{_quoted(str(v))}'") for p, v in spec.items())
        + ")"
        for spec in specs
    ]
    for i in range(0, len(told), at_once):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(told[i : i + at_once])}")


def _rewrite_files(spark: SparkSession, table: str, hit: Column, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rewrite the files that hold a hit; tables in text formats or bucketed ones are rewritten whole.

    A swap that an ended driver left half done is finished first.
    """
    facts = _described(spark, table)
    fmt = facts.get("Provider", "").lower()
    if fmt not in ("parquet", "orc") or "Num Buckets" in facts:
        return rebuild_table(spark, table, change(spark.table(table)))
    finish_swaps(spark, facts["Location"])
    spark.catalog.refreshTable(table)
    rows = spark.table(table)
    old = files_with(rows, hit)
    if old:
        # the literal list lets the scan skip all other files
        swap_files(spark, facts["Location"], fmt, old, change(rows.filter(file_of(rows).isin(old))))
        spark.catalog.refreshTable(table)
    return spark.table(table)


def _in_partitions(rows: DataFrame, parts: Sequence[str], touched: DataFrame) -> DataFrame:
    return rows.withColumn("_on", F.struct(*parts)).join(touched, "_on", "left_semi").drop("_on")


def _replace_touched(
    spark: SparkSession, table: str, parts: Sequence[str], rows: DataFrame, staged: bool = False
) -> DataFrame:
    """Load rows read from the table itself back into their partitions."""
    rows = rows if staged else materialise(rows, "touched")
    with session_conf(spark, DYNAMIC):
        spread(rows.select(*spark.table(table).columns), parts).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
    return spark.table(table)


DEPTH_KEY, ROWS_KEY, MERGE_KEY = "lakeops.depth", "lakeops.rows", "lakeops.merge"
DELTA = 0  # partition of the rows that are not merged yet; leaves are numbered from 1
DEEPEST = 30


def _node(keys: Sequence[str], depth: int) -> Column:
    """Node of the key at a depth of the hash tree: a 1 before the low bits of its hash."""
    return (F.pmod(F.xxhash64(*keys), F.lit(1 << depth)) + F.lit(1 << depth)).cast("int")


def _depth(node: int) -> int:
    return node.bit_length() - 1


def _parent(node: int) -> int:
    depth = _depth(node) - 1
    return (1 << depth) | (node & ((1 << depth) - 1))


def _split_nodes(nodes: set[int], depth: int) -> set[int]:
    """Nodes that were split: those above a node that is there."""
    found = set()
    for node in nodes - {DELTA}:
        while _depth(node) > depth:
            node = _parent(node)
            found.add(node)
    return found


def _leaf(keys: Sequence[str], depth: int, split: set[int]) -> Column:
    """The key's first node from the tree's first depth down that was not split."""
    last = max(map(_depth, split), default=depth - 1) + 1
    tries = []
    for d in range(depth, last):
        node = _node(keys, d)
        tries.append(F.when(~node.isin([n for n in split if _depth(n) == d]), node))
    return F.coalesce(*tries, _node(keys, last))


def _leaves_cut(rows: DataFrame, keys: Sequence[str], rows_per_bucket: int) -> DataFrame:
    """Rows of leaves with more than ``rows_per_bucket`` rows go to deeper leaves; ``rows`` must be staged."""
    large = rows.groupBy(BUCKET).count().filter(F.col("count") > rows_per_bucket).collect()
    deeper: dict[int, list[int]] = {}
    for r in large:
        more = (-(-r["count"] // rows_per_bucket) - 1).bit_length()
        deeper.setdefault(min(_depth(r[BUCKET]) + more, DEEPEST), []).append(r[BUCKET])
    to = [F.when(F.col(BUCKET).isin(nodes), _node(keys, d)) for d, nodes in deeper.items()]
    return rows.withColumn(BUCKET, F.coalesce(*to, F.col(BUCKET)))


def _nodes(spark: SparkSession, table: str) -> set[int]:
    return {int(r.partition.split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


@dataclass(frozen=True)
class Keyed:
    """What a keyed table says of itself."""

    keys: list[str]
    order_col: str
    depth: int  # first depth of the hash tree
    rows: int  # merged rows


def _keyed(spark: SparkSession, table: str) -> Keyed:
    stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if MERGE_KEY not in stored:
        raise ValueError(f"{table} was not created by upsert_batch: it has no {MERGE_KEY}")
    *keys, order_col = json.loads(stored[MERGE_KEY])
    return Keyed(keys, order_col, int(stored[DEPTH_KEY]), int(stored.get(ROWS_KEY, 0)))


def _base(spark: SparkSession, table: str, split: set[int]) -> DataFrame:
    """Merged rows.  A split leaf that an ended merge has not dropped yet does not count."""
    return spark.table(table).filter(~F.col(BUCKET).isin([DELTA, *split]))


def _note(spark: SparkSession, table: str, keys: Sequence[str], order_col: str, depth: int) -> None:
    spark.catalog.refreshTable(table)
    n = _base(spark, table, _split_nodes(_nodes(spark, table), depth)).count()
    merge = _quoted(json.dumps([*keys, order_col]))
    told = f"'{DEPTH_KEY}' = '{depth}', '{ROWS_KEY}' = '{n}', '{MERGE_KEY}' = '{merge}'"
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({told})")


def upsert_batch(
    df: DataFrame,
    table: str,
    keys: str | Sequence[str],
    order_col: str,
    buckets: int = 64,
    fold_share: float = 0.125,
    rows_per_bucket: int = 5_000_000,
) -> None:
    """Merge rows into a table that holds one row per key; the highest ``order_col`` wins.

    A batch is appended to the partition of unmerged rows, so it writes as much as it holds.  Once
    these are more than ``fold_share`` of the merged rows, the buckets they touch are rewritten:
    a row is rewritten a bounded number of times on average, however large the table is.  Buckets
    are leaves of a tree over the hash of the key; one with more than ``rows_per_bucket`` rows is
    split when it is rewritten.  ``buckets`` is rounded up to a power of two and counts when the
    table is created.  Repeating a batch changes nothing.  One writer at a time; read the table
    with :func:`read_upserted`.
    """
    spark, keys = df.sparkSession, names(keys)
    fresh = _latest(df, keys, order_col)
    if not spark.catalog.tableExists(table):
        depth = min((buckets - 1).bit_length(), DEEPEST)
        placed = materialise(fresh.withColumn(BUCKET, _node(keys, depth)), "merge-first")
        write_table(_leaves_cut(placed, keys, rows_per_bucket), table, partition_by=BUCKET)
        _note(spark, table, keys, order_col, depth)
        return
    told = _keyed(spark, table)
    if (told.keys, told.order_col) != (keys, order_col):
        raise ValueError(f"{table} is merged by {told.keys} and {told.order_col}")
    columns = spark.table(table).columns
    fresh.withColumn(BUCKET, F.lit(DELTA)).select(*columns).write.mode("append").insertInto(table)
    spark.catalog.refreshTable(table)
    if spark.table(table).filter(F.col(BUCKET) == DELTA).count() > fold_share * told.rows:
        fold_upserts(spark, table, rows_per_bucket)


def fold_upserts(spark: SparkSession, table: str, rows_per_bucket: int = 5_000_000) -> None:
    """Merge the unmerged rows into the buckets they touch.

    The unmerged rows and the leaves that were split go last, so an ended call loses nothing and
    can be repeated.
    """
    told = _keyed(spark, table)
    keys, order_col, depth = told.keys, told.order_col, told.depth
    before = _nodes(spark, table)
    split = _split_nodes(before, depth)
    delta = spark.table(table).filter(F.col(BUCKET) == DELTA).drop(BUCKET)
    fresh = materialise(_latest(delta, keys, order_col).withColumn(BUCKET, _leaf(keys, depth, split)), "merge-batch")
    old = _base(spark, table, split).join(fresh.select(BUCKET).distinct(), BUCKET, "left_semi")
    merged = _latest(old.unionByName(fresh).drop(BUCKET), keys, order_col)
    placed = materialise(merged.withColumn(BUCKET, _leaf(keys, depth, split)), "merge")
    overwrite_partition(_leaves_cut(placed, keys, rows_per_bucket), table, BUCKET)
    done = _split_nodes(_nodes(spark, table), depth) & before
    _drop_partitions(spark, table, [{BUCKET: n} for n in sorted(done | {DELTA})])
    _note(spark, table, keys, order_col, depth)


def _latest(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    from lakeops.operators.topk import latest_by_key

    return latest_by_key(df, keys, order_col)


def read_upserted(spark: SparkSession, table: str) -> DataFrame:
    """One row per key.  Only merged rows whose key has unmerged ones are compared."""
    told = _keyed(spark, table)
    keys, order_col = told.keys, told.order_col
    nodes = _nodes(spark, table)
    base = _base(spark, table, _split_nodes(nodes, told.depth)).drop(BUCKET)
    if DELTA not in nodes:
        return base
    delta = _latest(spark.table(table).filter(F.col(BUCKET) == DELTA).drop(BUCKET), keys, order_col)
    on = F.struct(*keys)
    late, held = delta.select(on.alias("_on")), base.withColumn("_on", on)
    same = held.join(late, "_on", "left_semi").drop("_on")
    rest = held.join(late, "_on", "left_anti").drop("_on")
    return rest.unionByName(_latest(same.unionByName(delta), keys, order_col))


def rows_of_keys(spark: SparkSession, table: str, wanted: DataFrame) -> DataFrame:
    """The current rows of the keys in ``wanted``; only the buckets of these keys are read.

    ``wanted`` is read twice.  The numbers of its buckets, a part of the table's own list of
    partitions, come to the driver so that the scan is pruned.
    """
    told = _keyed(spark, table)
    nodes = _nodes(spark, table)
    split = _split_nodes(nodes, told.depth)
    kinds = spark.table(table).schema
    keys = wanted.select(*[F.col(k).cast(kinds[k].dataType).alias(k) for k in told.keys]).distinct()
    leaves = [r[0] for r in keys.select(_leaf(told.keys, told.depth, split)).distinct().collect()]
    on = F.struct(*told.keys)
    late = keys.select(on.alias("_on"))

    def held(rows: DataFrame) -> DataFrame:
        return rows.drop(BUCKET).withColumn("_on", on).join(late, "_on", "left_semi").drop("_on")

    base = held(_base(spark, table, split).filter(F.col(BUCKET).isin(leaves)))
    if DELTA not in nodes:
        return base
    delta = held(spark.table(table).filter(F.col(BUCKET) == DELTA))
    return _latest(base.unionByName(delta), told.keys, told.order_col)


def store_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store one micro-batch's rows under its id; a replayed batch replaces itself.

    A batch that :func:`compact_batches` has folded into the base is not stored again.
    """
    spark = df.sparkSession
    if batch_id <= _folded_through(spark, path):
        return
    with session_conf(spark, DYNAMIC):
        df.withColumn("_batch", F.lit(int(batch_id))).write.mode("overwrite").partitionBy("_batch").parquet(path)


def _pointer(path: str) -> str:
    return f"{path.rstrip('/')}__base"


def _folded_through(spark: SparkSession, path: str) -> int:
    base = _newest_base(spark, path)
    return -1 if base is None else base[0]


def _newest_base(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Highest batch folded and the folder of that base; a base counts once its success mark is there."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(_pointer(path))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    done = []
    for status in fs.listStatus(root):
        place = status.getPath()
        if fs.exists(jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS")):
            done.append((int(place.getName().split("=")[1]), place.toString()))
    return max(done, default=None)


def compact_batches(spark: SparkSession, path: str, through: int, fold) -> None:
    """Fold the base and all batches up to ``through`` into a new base with ``fold(rows)``.

    Readers see either the old base with its tail or the new one: a base is valid from its success
    mark on, and batches it covers are skipped by number.
    """
    rows = read_batches(spark, path, through)
    fold(rows).write.mode("overwrite").parquet(f"{_pointer(path)}/through={int(through)}")


def read_batches(spark: SparkSession, path: str, through: int | None = None) -> DataFrame:
    """The newest base and the batches after it, as plain rows."""
    base = _newest_base(spark, path)
    tail = spark.read.parquet(path)
    if base is not None:
        tail = tail.filter(F.col("_batch") > base[0])
    if through is not None:
        tail = tail.filter(F.col("_batch") <= through)
    tail = tail.drop("_batch")
    return tail if base is None else spark.read.schema(tail.schema).parquet(base[1]).unionByName(tail)


def rollup_upsert(
    df: DataFrame, path: str, keys: Sequence[str], sums: Sequence[str], batch_id: int
) -> None:
    """Store the batch's partial sums per key; a repeated batch replaces its own part."""
    store_batch(df.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums]), path, batch_id)


def read_rollup(spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Fold the partial sums of the base and the batches after it."""
    return read_batches(spark, path).groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])


def compact_rollup(spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[str], through: int) -> None:
    compact_batches(spark, path, through, lambda rows: rows.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums]))


def dedup_on_insert(df: DataFrame, path: str, batch_id: int) -> None:
    """Append the distinct rows of one batch; :func:`read_distinct` folds across batches."""
    store_batch(df.distinct(), path, batch_id)


def read_distinct(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path).distinct()


def compact_distinct(spark: SparkSession, path: str, through: int) -> None:
    compact_batches(spark, path, through, lambda rows: rows.distinct())
