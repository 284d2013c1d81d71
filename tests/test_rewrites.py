"""Maintenance writes in proportion to what changed, and an ended call can be finished."""

import os

import pytest
from pyspark.sql import functions as F

from lakeops.catalog.base import scratch_db
from lakeops.sinks import swap as W
from lakeops.sinks import tables as T
from lakeops.streaming import windows as K


def parts_of(spark, name):
    """Path and size of every data file of a table."""
    root = T._described(spark, name)["Location"].removeprefix("file:")
    found = {}
    for folder, _, files in os.walk(root):
        found |= {
            os.path.join(folder, f): os.path.getsize(os.path.join(folder, f)) for f in files if f.endswith(".parquet")
        }
    return found


def twenty_files(spark):
    name = f"{scratch_db(spark)}.t"
    spark.range(0, 2000, 1, 20).selectExpr("id", "id AS v").write.saveAsTable(name)
    return name


def pairs(spark, name):
    return {(r.id, r.v) for r in spark.table(name).collect()}


def test_one_changed_row_keeps_the_other_files(spark):
    name = twenty_files(spark)
    before = parts_of(spark, name)
    T.update_where(spark, name, F.col("id") == 150, {"v": F.lit(-1)})
    assert len(before) == 20 and len(before.keys() & parts_of(spark, name).keys()) == 19
    T.delete_where(spark, name, F.col("id") == 150)
    assert len(before.keys() & parts_of(spark, name).keys()) == 19
    assert pairs(spark, name) == {(i, i) for i in range(2000) if i != 150}
    assert spark.table(name).count() == 1999


def test_no_hit_writes_nothing_and_all_hits_leave_an_empty_table(spark):
    name = twenty_files(spark)
    before = parts_of(spark, name)
    T.update_where(spark, name, F.col("id") < 0, {"v": F.lit(0)})
    assert parts_of(spark, name) == before
    assert T.delete_where(spark, name, F.col("id") >= 0).count() == 0
    assert spark.table(name).columns == ["id", "v"]


def test_a_column_may_be_named_like_the_file_metadata(spark):
    name = f"{scratch_db(spark)}.t"
    spark.range(6).selectExpr("id AS _metadata", "id AS v").write.saveAsTable(name)
    T.update_where(spark, name, F.col("v") == 2, {"v": F.lit(9)})
    assert {(r["_metadata"], r.v) for r in spark.table(name).collect()} == {(i, 9 if i == 2 else i) for i in range(6)}


def test_text_formats_and_bucketed_tables_are_rewritten(spark):
    db = scratch_db(spark)
    spark.range(10).selectExpr("id", "id AS v").write.format("csv").option("header", True).saveAsTable(f"{db}.c")
    spark.range(10).selectExpr("id", "id AS v").write.bucketBy(2, "id").saveAsTable(f"{db}.b")
    for name in (f"{db}.c", f"{db}.b"):
        T.delete_where(spark, name, F.col("id") == 3)
        assert pairs(spark, name) == {(i, i) for i in range(10) if i != 3}


@pytest.mark.parametrize("at", ["before", "moving", "deleting"])
def test_an_ended_swap_is_finished_by_the_next_call(spark, monkeypatch, at):
    name = twenty_files(spark)
    location = T._described(spark, name)["Location"]
    with monkeypatch.context() as m:
        m.setattr(T, "swap_files", lambda *a: staged(spark, *a[1:]))
        T.update_where(spark, name, F.col("id") < 150, {"v": F.lit(-1)})
    root = location.removeprefix("file:")
    place = os.path.join(root, W.PLACE, os.listdir(os.path.join(root, W.PLACE))[0])
    made = [f for f in os.listdir(f"{place}/new") if f.startswith("part-")]
    if at != "before":
        for f in made if at == "deleting" else made[:1]:
            os.rename(f"{place}/new/{f}", f"{root}/{f}")
    T.delete_where(spark, name, F.col("id") == 1999)
    assert pairs(spark, name) == {(i, -1 if i < 150 else i) for i in range(1999)}
    assert spark.table(name).count() == 1999 and not os.listdir(os.path.join(root, W.PLACE))


def staged(spark, location, fmt, old, rows):
    """A swap whose driver ends before the first move."""
    place = f"{location}/{W.PLACE}/ended"
    rows.write.format(fmt).save(f"{place}/new")
    spark.createDataFrame([(p,) for p in old], "path string").coalesce(1).write.text(f"{place}/old")


def test_an_undecided_swap_does_not_count(spark):
    name = twenty_files(spark)
    location = T._described(spark, name)["Location"]
    spark.range(5).selectExpr("id", "id AS v").write.parquet(f"{location}/{W.PLACE}/torn/new")
    T.update_where(spark, name, F.col("id") == 0, {"v": F.lit(7)})
    assert pairs(spark, name) == {(i, i or 7) for i in range(2000)} and spark.table(name).count() == 2000


def versions(spark, lo, hi, ver):
    return spark.range(lo, hi).selectExpr("id AS k", f"{ver} AS ver", f"concat('v{ver}-', id) AS v")


def read(spark, name):
    got = [(r.k, r.ver) for r in T.read_upserted(spark, name).collect()]
    assert len(got) == len(set(k for k, _ in got))
    return dict(got)


def test_a_small_batch_writes_what_it_holds(spark):
    name = f"{scratch_db(spark)}.t"
    T.upsert_batch(versions(spark, 0, 200_000, 1), name, "k", "ver", buckets=16)
    before = parts_of(spark, name)
    T.upsert_batch(versions(spark, 500, 600, 2), name, "k", "ver")
    after = parts_of(spark, name)
    assert before.items() <= after.items()
    assert sum(after.values()) - sum(before.values()) < sum(before.values()) / 20
    assert read(spark, name) == {k: 2 if 500 <= k < 600 else 1 for k in range(200_000)}


def test_replay_and_late_versions(spark):
    name = f"{scratch_db(spark)}.t"
    T.upsert_batch(versions(spark, 0, 1000, 5), name, "k", "ver", buckets=4)
    want = dict.fromkeys(range(1000), 5)
    for lo, hi, ver in [(10, 20, 7), (10, 20, 7), (15, 30, 6), (990, 1010, 1), (10, 20, 7)]:
        T.upsert_batch(versions(spark, lo, hi, ver), name, "k", "ver")
        want |= {k: max(want.get(k, 0), ver) for k in range(lo, hi)}
        assert read(spark, name) == want
    T.fold_upserts(spark, name)
    assert read(spark, name) == want and spark.table(name).count() == len(want)


def test_splitting_keeps_one_row_per_key(spark):
    name, want = f"{scratch_db(spark)}.t", {}
    for i, n in enumerate((40, 300, 1500, 700)):
        lo = i * 200
        T.upsert_batch(versions(spark, lo, lo + n, i), name, "k", "ver", buckets=2, rows_per_bucket=50)
        want |= dict.fromkeys(range(lo, lo + n), i)
        assert read(spark, name) == want
    assert spark.table(name).groupBy(T.BUCKET).count().agg(F.max("count")).first()[0] <= 100
    nodes = T._nodes(spark, name)
    assert len(nodes) > 30 and not nodes & T._split_nodes(nodes, 1)


def test_a_fold_that_ended_before_its_drops(spark, monkeypatch):
    name = f"{scratch_db(spark)}.t"
    T.upsert_batch(versions(spark, 0, 100, 1), name, "k", "ver", buckets=2, rows_per_bucket=50)
    with monkeypatch.context() as m:
        m.setattr(T, "_drop_partitions", lambda *a, **k: None)
        T.upsert_batch(versions(spark, 50, 400, 2), name, "k", "ver", rows_per_bucket=50)
    want = {k: 2 if k >= 50 else 1 for k in range(400)}
    assert T.DELTA in T._nodes(spark, name) and read(spark, name) == want
    T.upsert_batch(versions(spark, 0, 5, 3), name, "k", "ver", rows_per_bucket=50)
    want |= dict.fromkeys(range(5), 3)
    assert read(spark, name) == want
    T.fold_upserts(spark, name, 50)
    assert read(spark, name) == want and spark.table(name).count() == 400


def test_null_keys_and_empty_batches(spark):
    name, schema = f"{scratch_db(spark)}.t", "k string, j int, ver int, v string"
    T.upsert_batch(spark.createDataFrame([], schema), name, ["k", "j"], "ver")
    for rows in ([(None, 1, 1, "a"), ("x", None, 1, "b")], [], [(None, 1, 2, None), (None, 1, 2, "c")]):
        T.upsert_batch(spark.createDataFrame(rows, schema), name, ["k", "j"], "ver")
    got = {tuple(r) for r in T.read_upserted(spark, name).collect()}
    assert got == {(None, 1, 2, "c"), ("x", None, 1, "b")}


def test_other_keys_are_refused(spark):
    name = f"{scratch_db(spark)}.t"
    T.upsert_batch(versions(spark, 0, 5, 1), name, "k", "ver")
    with pytest.raises(ValueError, match="is merged by"):
        T.upsert_batch(versions(spark, 0, 5, 1), name, "v", "ver")


def test_many_partitions_are_dropped_at_once(spark):
    name = f"{scratch_db(spark)}.t"
    T.write_table(spark.range(40).selectExpr("id", "string(id) AS p"), name, partition_by="p")
    T.delete_where(spark, name, F.col("id") >= 10)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 10 and spark.table(name).count() == 10


def test_rows_of_keys_reads_their_buckets_only(spark):
    name = f"{scratch_db(spark)}.t"
    T.upsert_batch(versions(spark, 0, 4000, 1), name, "k", "ver", buckets=64)
    T.upsert_batch(versions(spark, 7, 9, 2), name, "k", "ver")
    wanted = spark.createDataFrame([(7,), (11,), (7,), (None,), (5000,)], "k int")
    got = T.rows_of_keys(spark, name, wanted)
    assert {(r.k, r.ver) for r in got.collect()} == {(7, 2), (11, 1)}
    read_parts = got.select(F.input_file_name()).distinct()
    assert T.DELTA in T._nodes(spark, name) and read_parts.count() <= 6


TRIP = "trip_id string, vehicle_id string, driver_id string, s long, delta_m double, speed_kmph double"


def trip_moves(spark, data):
    rows = spark.createDataFrame(data, TRIP)
    return rows.withColumn("event_time", F.timestamp_seconds("s")).drop("s")


def sums(data):
    """Rows and metres per trip, by hand."""
    found = {}
    for trip, vehicle, driver, _, metres, _ in data:
        n, m = found.get((trip, vehicle, driver), (0, 0.0))
        found[trip, vehicle, driver] = (n + 1, m + metres)
    return found


def test_trips_are_sent_again_on_change(spark):
    name = f"{scratch_db(spark)}.trips"
    batches = [
        [("a", "v", "d", 10, 1.0, 5.0), ("b", "v", None, 20, 2.0, None)],
        [("a", "v", "d", 5, 4.0, 9.0), ("c", "w", "d", 30, 8.0, 1.0), ("a", "v", "d", 40, 16.0, 7.0)],
        [("b", "v", None, 25, 32.0, 3.0), ("c", "w", "d", 31, 64.0, 2.0)],
    ]
    seen, last = [], {}
    for n, data in enumerate(batches):
        seen += data
        for _ in range(2):  # the second time as after an ended batch
            sent = K.apply_trip_batch(trip_moves(spark, data), name, n).collect()
            assert {(r.trip_id, r.change) for r in sent} == {(t[0], "U" if t[:3] in last else "I") for t in data}
            for r in sent:
                key = (r.trip_id, r.vehicle_id, r.driver_id)
                assert (r.event_count, r.distance_m) == sums(seen)[key]
                assert (r.before and (r.before.event_count, r.before.distance_m)) == last.get(key)
            held = K.read_trips(spark, name).collect()
            assert {(r.trip_id, r.vehicle_id, r.driver_id): (r.event_count, r.distance_m) for r in held} == sums(seen)
        last = sums(seen)
    a = next(r for r in held if r.trip_id == "a")
    assert (a.trip_duration_sec, a.min_speed, a.max_speed, a.avg_speed) == (35, 5.0, 9.0, 7.0)


def test_an_empty_batch_changes_no_trip(spark):
    name = f"{scratch_db(spark)}.trips"
    for n, data in enumerate(([], [("a", "v", "d", 10, 1.0, 5.0)], [])):
        assert K.apply_trip_batch(trip_moves(spark, data), name, n).count() == len(data)
    assert K.read_trips(spark, name).count() == 1
