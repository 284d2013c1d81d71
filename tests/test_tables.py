"""Sinks: reruns change nothing, maintenance keeps the other rows."""

from pyspark.sql import functions as F

from lakeops.catalog.base import scratch_db
from lakeops.sinks import tables as T
from lakeops.sources import files as S
from lakeops.sources import streams as X


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_partition_replacement_is_idempotent(spark):
    first = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], "id int, race string, v int")
    again = spark.createDataFrame([(9, "a", 9)], "id int, race string, v int")
    for load in (T.overwrite_partition, T.replace_partitions_by_drop):
        name = f"{scratch_db(spark)}.t"
        for df in (first, again, again):
            load(df, name, "race")
        assert rows(spark.table(name)) == rows(spark.createDataFrame([(9, "a", 9), (3, "b", 3)], first.schema))


def test_many_partition_values(spark):
    name = f"{scratch_db(spark)}.t"
    df = spark.range(30).selectExpr("id", "id % 10 AS p")
    for _ in range(2):
        T.replace_partitions_by_drop(df, name, "p")
    assert spark.table(name).count() == 30


def partitioned(spark):
    name = f"{scratch_db(spark)}.t"
    df = spark.range(30).selectExpr("id", "id AS v", "IF(id % 3 = 0, NULL, concat('p ', id % 3, chr(39))) AS p")
    T.write_table(df, name, partition_by="p")
    return name


def test_update_and_delete_keep_the_partitions(spark):
    name = partitioned(spark)
    T.update_where(spark, name, F.col("id") == 4, {"v": F.lit(-1)})
    T.delete_where(spark, name, F.col("id") == 7)
    assert T.partition_columns(spark, name) == ["p"]
    one = spark.createDataFrame([(100, 100, "p 1'")], "id bigint, v bigint, p string")
    T.overwrite_partition(one, name, "p")
    want = {(i, i) for i in range(30) if i % 3 != 1} | {(100, 100)}
    assert {(r.id, r.v) for r in spark.table(name).collect()} == want


def test_delete_of_whole_partitions(spark):
    name = partitioned(spark)
    T.delete_where(spark, name, F.col("p").isNull() | (F.col("id") % 3 == 2))
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(1, 30, 3))
    assert T.partition_columns(spark, name) == ["p"]


def test_delete_rewrites_only_what_it_touches(spark):
    name = partitioned(spark)
    files = lambda: {r[0] for r in spark.table(name).filter("p = 'p 2' || chr(39)").select(F.input_file_name()).distinct().collect()}
    before = files()
    T.delete_where(spark, name, F.col("id") == 7)
    assert before and files() == before


def test_rebuild_keeps_format_and_properties(spark):
    name = f"{scratch_db(spark)}.t"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, p STRING) USING json PARTITIONED BY (p) TBLPROPERTIES ('owner.team' = 'ours')")
    T.write_table(spark.range(4).selectExpr("id", "string(id % 2) AS p"), f"{name}_in")
    T.rebuild_table(spark, name, spark.table(f"{name}_in"))
    kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert kept["owner.team"] == "ours" and T.partition_columns(spark, name) == ["p"]
    assert T._described(spark, name)["Provider"].lower() == "json" and spark.table(name).count() == 4
    T.compact(spark, name, 1)
    assert spark.table(name).count() == 4


def test_upsert_keeps_its_bucket_count(spark):
    name = f"{scratch_db(spark)}.t"
    df = spark.range(50).selectExpr("id AS k", "1 AS ver")
    for buckets in (8, 16):
        T.upsert_batch(df, name, "k", "ver", buckets=buckets)
    assert spark.table(name).count() == 50


def test_upsert_last_write_wins_and_replay(spark):
    name = f"{scratch_db(spark)}.t"
    frames = [
        [("k", 1, "old"), ("m", 1, "m1")], [("k", 3, "new"), ("k", 2, "mid")], [("k", 2, "late")], [("n", 5, None)],
    ]
    for f in frames * 2:
        T.upsert_batch(spark.createDataFrame(f, "k string, ver int, v string"), name, "k", "ver", buckets=4)
    assert rows(T.read_upserted(spark, name)) == [("k", "new", 3), ("m", "m1", 1), ("n", None, 5)]


def test_snapshot_diff_handles_nulls_and_applies(spark):
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "n")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (None, "m")], schema)
    diff = T.snapshot_diff(old, new, "k")
    kinds = {(r.k, r.change) for r in diff.collect()}
    assert kinds == {(2, "U"), (3, "D"), (4, "I"), (None, "U")}
    assert rows(T.apply_diff(old, diff, "k")) == rows(new)


def test_update_and_delete_keep_null_conditions(spark):
    name = f"{scratch_db(spark)}.t"
    spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, v int").write.saveAsTable(name)
    T.update_where(spark, name, F.col("v") > 10, {"v": F.lit(0)})
    assert rows(spark.table(name)) == [(1, 5), (2, None), (3, 0)]
    T.delete_where(spark, name, F.col("v") == 5)
    assert rows(spark.table(name)) == [(2, None), (3, 0)]


def test_rebuild_from_itself(spark):
    name = f"{scratch_db(spark)}.t"
    T.rebuild_table(spark, name, spark.range(5))
    T.rebuild_table(spark, name, spark.table(name).filter("id > 2"))
    assert rows(spark.table(name)) == [(3,), (4,)]


def test_rollup_replay_of_a_batch(spark, fresh):
    path = fresh()
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "k string, v double")
    for batch in (0, 0, 1):
        T.rollup_upsert(df, path, ["k"], ["v"], batch)
    assert rows(T.read_rollup(spark, path, ["k"], ["v"])) == [("a", 6.0)]


def test_compaction_of_batches(spark, fresh):
    path, total = fresh(), 0
    for batch in range(6):
        T.rollup_upsert(spark.createDataFrame([("a", batch), ("b", 1)], "k string, v long"), path, ["k"], ["v"], batch)
        total += batch
        if batch in (2, 4):
            T.compact_rollup(spark, path, ["k"], ["v"], batch)
        # a replay of a batch that is already in the base
        T.rollup_upsert(spark.createDataFrame([("a", batch), ("b", 1)], "k string, v long"), path, ["k"], ["v"], batch)
        assert rows(T.read_rollup(spark, path, ["k"], ["v"])) == [("a", total), ("b", batch + 1)]
    distinct = fresh()
    for batch, ids in enumerate([(1, 2), (2, 3), (1, 3)]):
        T.dedup_on_insert(spark.createDataFrame([(i,) for i in ids], "i int"), distinct, batch)
    T.compact_distinct(spark, distinct, 1)
    assert rows(T.read_distinct(spark, distinct)) == [(1,), (2,), (3,)]


def test_hot_partition_is_written_whole(spark, fresh):
    path = fresh()
    df = spark.range(30000).selectExpr("id", "IF(id < 20000, 'hot', concat('d', id % 7)) AS p")
    T.write_table(df, path, partition_by="p")
    assert spark.read.parquet(path).groupBy("p").count().filter("p = 'hot'").first()["count"] == 20000


def test_chunk_bound(spark, fresh):
    path = fresh()
    df = spark.range(1050).withColumn("ts", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    T.write_chunked(df, path, "ts", max_rows=100)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1050


def test_latest_file_by_path(spark, fresh):
    root = fresh()
    for day, v in (("20240101", 1), ("20240301", 3), ("20240201", 2)):
        spark.createDataFrame([("s", v)], "symbol string, v int").coalesce(1).write.json(f"{root}/{day}")
    got = S.latest_file_per_key(spark, f"{root}/*", "symbol", "symbol string, v int")
    assert rows(got) == [("s", 3)]


def test_ingest_takes_only_new_files_and_keeps_schema(spark, fresh):
    src, base, name = fresh("src"), fresh("base"), f"{scratch_db(spark)}.t"
    for lo in (0, 5):
        spark.range(lo, lo + 5).write.mode("append").json(src)
        for _ in range(2):
            X.ingest_available(spark, src, base, "ids", name, "json")
    assert rows(spark.table(name).select("id")) == [(i,) for i in range(10)]
    assert X.tracked_schema(spark, "unused", f"{base}/schemas/ids", "json").names == ["id"]


def test_small_files_are_written_by_many_tasks(spark, fresh):
    df = spark.range(40_000).select("id", F.timestamp_seconds(F.col("id") % 12 * 86_400).alias("at"), F.sha2(F.col("id").cast("string"), 512).alias("wide"))
    path = fresh("chunks")
    T.write_chunked(df, path, "at", max_rows=20)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert max(r.n for r in files) == 20 and sum(r.n for r in files) == 40_000
    assert len({r.f.rsplit("/", 1)[1].split("-")[1] for r in files}) >= 3  # before, one task wrote all of them
    assert spark.read.parquet(path).agg(F.countDistinct("id")).first()[0] == 40_000
