"""Incremental ingest of files with changing columns."""

import json
import os

import pytest

from lakeops.sources import ingest as I


@pytest.fixture()
def place(spark, fresh):
    src, base = fresh("landing"), fresh("base")
    os.makedirs(src)
    name = f"ingest_{base.rsplit('-', 1)[1]}"

    def put(file, text):
        with open(f"{src}/{file}", "w") as f:
            f.write(text)

    def load(**options):
        I.ingest_available(spark, src, base, "d", name, **options)
        return [tuple(r)[:-1] for r in spark.table(name).collect()]

    yield put, load, name, base
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_reordered_header_new_column_and_bad_value(spark, place):
    put, load, name, base = place
    put("a.csv", "id,name,amt\n1,x,10\n2,y,\n")
    assert set(load()) == {(1, "x", 10, None), (2, "y", None, None)}
    put("b.csv", "name,id,amt,extra\nz,3,30,2.5\nw,4,many,3.5\n")
    put("c.csv", "ID,AMT\n5,50\n")
    want = {
        (1, "x", 10, None, None), (2, "y", None, None, None), (3, "z", 30, None, 2.5), (4, "w", None, '{"amt":"many"}', 3.5),
        (5, None, 50, None, None),
    }
    assert set(load()) == want
    assert spark.table(name).columns == ["id", "name", "amt", "_rescued", "extra", "_batch"]
    assert sorted(map(repr, load())) == sorted(map(repr, want))  # nothing new: nothing changes
    assert [s.names for s in I.SchemaLog(spark, f"{base}/schemas/d").versions()] == [["id", "name", "amt"], ["id", "name", "amt", "extra"]]
    put("d.csv", "extra,id\n9.5,6\n")  # a restart goes on with the newest version
    assert set(load()) == want | {(6, None, None, None, 9.5)}


def test_replayed_batch_changes_nothing(spark, place):
    put, load, name, base = place
    put("a.csv", "id,v\n1,a\n")
    load()
    put("b.csv", "id,v\n2,b\n")
    first = load()
    commits = f"{base}/checkpoints/d/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):  # as if the driver died behind the write
        os.remove(f"{commits}/{f}") if os.path.exists(f"{commits}/{f}") else None
    assert sorted(load()) == sorted(first) and spark.table(name).count() == 2


def test_records_that_do_not_parse(spark, place):
    put, load, name, _ = place
    put("a.csv", "id,v\n1,a\n2,b,c\n3\n")
    rows = load()
    assert {r[:2] for r in rows} == {(1, "a"), (2, "b"), (3, None)}
    assert {json.loads(r[2])["_record"] for r in rows if r[2]} == {"2,b,c", "3"}


def test_json_types_and_nested_values(spark, place):
    put, load, name, _ = place
    put("a.json", '{"id": 1, "o": {"x": 1, "y": ["p"]}}\n{"id": 2}\n')
    load(fmt="json")
    put("b.json", '{"id": "bad", "new": true, "o": {"x": 2, "y": []}}\nno json\n{"o": 5, "id": 3}\n')
    load(fmt="json")
    rows = {(r.id, r.o.x if r.o else None, r.new, r["_rescued"]) for r in spark.table(name).collect()}
    assert rows == {
        (1, 1, None, None), (2, None, None, None), (None, 2, True, '{"id":"bad"}'), (None, None, None, '{"_record":"no json"}'),
        (3, None, None, '{"o":"5"}'),
    }


def test_without_evolution_new_columns_are_rescued(spark, place):
    put, load, name, _ = place
    put("a.csv", "id,extra\n1,x\n")
    assert set(load(schema="id BIGINT, v STRING", evolve=False)) == {(1, None, '{"extra":"x"}')}


def test_parquet_files_by_name_and_type(spark, place, fresh):
    put, load, name, base = place
    src = put.__closure__[0].cell_contents
    spark.createDataFrame([(1, "a")], "id int, v string").coalesce(1).write.mode("append").parquet(src)
    load(fmt="parquet")
    spark.createDataFrame([("b", 2), ("c", 1 << 40)], "v string, id bigint").coalesce(1).write.mode("append").parquet(src)
    assert set(load(fmt="parquet")) == {(1, "a", None), (2, "b", None), (None, "c", '{"id":"1099511627776"}')}


def test_empty_folder_and_partition_folders(spark, place):
    put, load, name, _ = place
    src = put.__closure__[0].cell_contents
    os.makedirs(f"{src}/day=2024-01-02")
    put("day=2024-01-02/a.csv", "id\n1\n")
    put("day=2024-01-02/empty.csv", "")
    load()
    assert [(r.id, str(r.day)) for r in spark.table(name).collect()] == [(1, "2024-01-02")]


def test_files_per_batch(spark, place):
    put, load, name, _ = place
    for i in range(5):
        put(f"{i}.csv", f"id\n{i}\n")
    load(max_files=2)
    assert {(r.id) for r in spark.table(name).collect()} == set(range(5))
    assert spark.table(name).select("_batch").distinct().count() == 3
