"""The as-of join, ranges over any key, the top ranks and the vector index."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import joins as J
from lakeops.operators import ordered as O
from lakeops.operators import retrieval as V
from lakeops.operators import topk as K


def brute(left, right, forward, strict):
    out = []
    for k, t, i in left:
        fits = [
            (rt, v) for rk, rt, v in right
            if None not in (k, t, rk, rt) and rk == k and ((rt > t or rt == t and not strict) if forward else (rt < t or rt == t and not strict))
        ]
        best = (min(x[0] for x in fits) if forward else max(x[0] for x in fits)) if fits else None
        out.append((k, t, i, best, min(v for rt, v in fits if rt == best) if fits else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("strict", [True, False])
def test_asof(spark, forward, strict):
    pick = random.Random(5)
    one = lambda: (pick.choice(["hot", "hot", "a", "b", None]), pick.choice([None, *range(60)]))
    left, right = [(*one(), i) for i in range(300)], [(*one(), pick.randint(0, 9)) for i in range(150)]
    l = spark.createDataFrame(left, "k string, t int, i int").repartition(4)
    r = spark.createDataFrame(right, "k string, t int, v int").repartition(3)
    got = J.asof_join(l, r, "k", "t", ["v"], forward, strict, "at", F.floor(F.col("_t") / 7))
    assert sorted(map(tuple, got.select("k", "t", "i", "at", "v").collect()), key=repr) == brute(left, right, forward, strict)


def test_nearest_makes_no_pairs(spark):
    """2,000 starts and 2,000 ends of one key in one bucket: rows, not their square."""
    df = spark.range(4000).selectExpr("'k' AS k", "timestamp_seconds(1700000000 + id DIV 2) AS ts", "IF(id % 2 = 0, 's', 'e') AS kind", "id")
    near = J.pair_within(df, "k", "ts", F.col("kind") == "s", F.col("kind") == "e", 3600, ["id"], first_only=True)
    assert {(r.start_id, r.end_id, r.break_seconds) for r in near.collect()} == {(i, i + 3, 1) for i in range(0, 3998, 2)}


def test_ranges_hold_with_an_outlier_and_a_long_prefix(spark):
    urls = spark.range(10_000).selectExpr("concat('https://example.org/catalogue/items/', lpad(id, 6, '0')) AS u")
    df = urls.union(spark.sql("SELECT 'zzz'"))
    sizes = {r["_chunk"]: r.n for r in O.quantile_chunk(df, "u", 8).groupBy("_chunk").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(sizes) == 8 and max(sizes.values()) < 2_600
    many = {r["_chunk"]: r.n for r in O.quantile_chunk(df, "u", 200).groupBy("_chunk").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(many) > 150 and max(many.values()) < 500


@pytest.mark.parametrize("kind", ["double", "string", "timestamp", "date", "decimal(10,2)", "binary", "timestamp_ntz"])
@pytest.mark.parametrize("ranges", [3, 60])
def test_ranges_never_decrease(spark, kind, ranges):
    raw = {"timestamp": "timestamp_seconds(id * 7919)", "date": "date_add(date'1970-01-01', CAST(id AS INT))", "binary": "CAST(hex(id) AS BINARY)",
           "timestamp_ntz": "CAST(timestamp_seconds(id * 7919) AS TIMESTAMP_NTZ)"}
    df = spark.range(2000).selectExpr(f"IF(id % 9 = 0, NULL, CAST({raw.get(kind, 'id * 7919 % 1009')} AS {kind})) AS v")
    if kind == "double":
        df = df.union(spark.sql("SELECT double('NaN') UNION ALL SELECT double('-inf')"))
    rows = O.quantile_chunk(df, "v", ranges).orderBy("v").select("_chunk").collect()
    found = [r["_chunk"] for r in rows]
    assert found == sorted(found) and len(set(found)) > ranges // 2 and None not in found


def test_top_ranks_with_ties_and_nulls(spark):
    pick = random.Random(2)
    rows = [(i, pick.choice([None, 1.5, 2.5, float("nan"), 9.0, *range(20)]), pick.choice("ab")) for i in range(400)]
    df = spark.createDataFrame([(i, None if v is None else float(v), s) for i, v, s in rows], "i int, v double, s string")
    from pyspark.sql import Window

    for order in (["-v", "s"], ["v"], ["s", "-v"]):
        for n in (1, 30, 1000):
            want = df.withColumn("rank", F.rank().over(Window.orderBy(*O.sort_columns(order)))).where(F.col("rank") <= n)
            got = K.top_ranked(df, order, n)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = K.top_ranked(df, ["-v"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_inverted_file(spark):
    pick = random.Random(8)
    centres = [[pick.gauss(0, 1) for _ in range(12)] for _ in range(15)]
    rows = [(i, [x + pick.gauss(0, 0.4) for x in pick.choice(centres)]) for i in range(1500)] + [(-1, None), (-2, [0.0] * 12)]
    rows += [(2000 + i, rows[0][1]) for i in range(30)]
    index = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)
    asked = index.where("id % 50 = 0").withColumnRenamed("id", "query_id")
    exact = V.vector_topk(asked, index, 10, query_block=7, index_block=50)
    built = V.vector_index(index, lists=20)
    everything = V.probe_topk(asked, built, 10, probes=20, query_block=3, index_block=20)
    assert sorted((r.query_id, r.id, r["rank"]) for r in everything.collect()) == sorted((r.query_id, r.id, r["rank"]) for r in exact.collect())
    probes = V.probes_for(built, asked.where("query_id % 100 = 0"), exact.where("query_id % 100 = 0"))
    assert probes < 10
    assert V.recall_at(V.probe_topk(asked, built, 10, probes), exact).first()["recall"] >= 0.9
    empty = V.vector_index(index.limit(0))
    assert V.probe_topk(asked, empty, 10).count() == 0


def test_null_texts_do_not_reach_the_model(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, t string").coalesce(1)
    got = {r.id: r.embedding for r in V.embed(df, "id", "t", lambda ts: [[float(len(t))] for t in ts], batch=2).collect()}
    assert got == {1: [1.0], 2: None, 3: [1.0]}


def test_keyword_lists_against_every_document(spark):
    """Blocks that are skipped hold nothing better; text ids, null texts and null ids."""
    pick = random.Random(3)
    names = ["common", "often", *(f"w{i}" for i in range(80))]
    text = lambda n: " ".join(pick.choices(names, [40, 20, *([1] * 80)], k=n))
    docs = [(f"d{i:03}", text(pick.choice([2, 10, 60]))) for i in range(400)] + [("e", None), (None, "w1 w2"), ("f", "")]
    asked = [(i, text(4)) for i in range(25)] + [(90, "unknown"), (91, None)]
    d = spark.createDataFrame(docs, "id string, text string").repartition(3)
    q = spark.createDataFrame(asked, "query_id int, text string")
    index = V.keyword_index(d, block_docs=20)
    lists = {"words": (False, 6), "density": (True, 9)}
    got = {(r.list, r.query_id, r["rank"]): (r.id, r.score) for r in V.keyword_lists(q, index, 5, lists=lists).collect()}

    split = [(k, (t or "").split()) for k, t in docs]
    mean, n = sum(len(w) for _, w in split) / len(split), len(split)
    df = {t: sum(k is not None and t in w for k, w in split) for t in names}
    want = {}
    for qid, t in asked:
        terms = set((t or "").split()) & set(names)
        for name, (per_length, digits) in lists.items():
            scored = []
            for k, w in split:
                if k is None or not terms & set(w):
                    continue
                s = sum(
                    math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * w.count(x) * 2.2 / (w.count(x) + 1.2 * (0.25 + 0.75 * len(w) / mean))
                    for x in terms if x in w
                )
                scored.append((-round(s / (1 + len(w)) if per_length else s, digits), k))
            for rank, (s, k) in enumerate(sorted(scored)[:5], 1):
                want[name, qid, rank] = (k, -s)
    assert got.keys() == want.keys()
    assert all(got[x][0] == want[x][0] and abs(got[x][1] - want[x][1]) < 2e-6 for x in want)


def test_partitions_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(O, "ROWS_PER_TASK", 10)
    left = spark.createDataFrame([(k, t) for k in (1, 2, None) for t in [*range(0, 90, 4), None]], "k int, t long")
    right = spark.createDataFrame([(k, t, 100 * k + t) for k in (1, 2) for t in range(0, 90, 7)], "k int, t long, v int")
    few, many = (J.asof_join(left, right, "k", "t", ["v"], chunk=F.floor(F.col("_t") / 10), count=n) for n in (None, 170))
    shown = lambda df: sorted(map(repr, df.collect()))
    assert shown(many) == shown(few)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert ", 17)" in plan  # before, as many as spark.sql.shuffle.partitions whatever the rows
