"""Forecasts and retrieval against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.operators import forecast as FC
from lakeops.operators import retrieval as V


def series(spark, name, values):
    rows = [(name, i, float(v), float(v) + 1, float(v) - 1, float(v), 1) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "symbol string, i int, open double, high double, low double, close double, volume long")
    return df.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i"))).drop("i")


def levels(df, symbol):
    return [r.forecast for r in df.filter(F.col("symbol") == symbol).orderBy("step").collect()]


def test_autoregression_equals_numpy(spark):
    rng = random.Random(1)
    closes = list(np.cumsum([rng.gauss(0, 1) for _ in range(80)]) + 100)
    got = levels(FC.forecast_ar(series(spark, "s", closes), p=3, horizon=5), "s")
    d = np.diff(closes)
    x = np.column_stack([d[3 - i - 1 : len(d) - i - 1] for i in range(3)])
    coef = np.linalg.lstsq(x, d[3:], rcond=None)[0]
    steps, level, want = list(d[-1:-4:-1]), closes[-1], []
    for _ in range(5):
        s = float(np.dot(coef, steps))
        level += s
        want.append(level)
        steps = [s, *steps[:-1]]
    assert got == pytest.approx(want, rel=1e-6)


def test_short_series_stay_flat(spark):
    df = series(spark, "s", [3, 4, 5])
    assert levels(FC.forecast_ar(df, horizon=3), "s") == [5.0] * 3
    assert levels(FC.forecast_trend_seasonal(df, horizon=3), "s") == [5.0] * 3


def test_trend_follows_a_line(spark):
    got = levels(FC.forecast_trend_seasonal(series(spark, "s", [10 + 2 * i for i in range(60)]), horizon=4), "s")
    assert got == pytest.approx([130, 132, 134, 136], abs=1e-4)
    line = FC.trend_line(series(spark, "s", [1, 3, 5])).first()
    assert line.slope == pytest.approx(2) and line.intercept == pytest.approx(1)


def test_forest_levels(spark):
    long = series(spark, "a", [50 + (i % 7) for i in range(120)])
    short = series(spark, "b", [7.0] * 12)
    out = FC.forecast_forest(long.unionByName(short), horizon=2, trees=5)
    assert levels(out, "b") == [7.0, 7.0]
    assert all(50 <= v <= 56 for v in levels(out, "a"))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    return rng.normal(size=(300, 8)), rng.normal(size=(23, 8))


@pytest.mark.parametrize("bound", [4096, 20, 5])
def test_vector_topk_equals_brute_force(spark, vectors, bound):
    index, asked = vectors
    idf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(index)], "id long, embedding array<double>")
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, embedding array<double>")
    got = V.vector_topk(qdf, idf.repartition(5), 4, query_block=bound).collect()
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = unit(asked) @ unit(index).T
    want = {(q, r + 1): int(i) for q in range(len(asked)) for r, i in enumerate(np.argsort(-scores[q])[:4])}
    assert {(r.query_id, r["rank"]): r.id for r in got} == want


def test_null_vectors_and_no_queries(spark):
    idx = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 2.0])], "id long, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 1.0]), (2, None)], "query_id long, embedding array<double>")
    assert sorted((r.query_id, r.id, r["rank"]) for r in V.vector_topk(q, idx, 5).collect()) == [(1, 1, 1), (1, 3, 2)]
    for none, some in ((q.limit(0), idx), (q, idx.limit(0))):
        out = V.vector_topk(none, some, 5)
        assert out.columns == ["query_id", "id", "score", "rank"] and out.count() == 0


@pytest.mark.parametrize("bound", [2048, 2])
def test_keyword_topk_equals_brute_force(spark, bound):
    docs = {i: " ".join(f"w{(i * k) % 11}" for k in range(1, 3 + i % 5)) for i in range(60)} | {99: "", 98: None}
    asked = {1: "w1 w2 W3", 2: "nothing here", 3: "w5 w5", 4: None, 5: "w0 w7"}
    d = spark.createDataFrame(list(docs.items()), "id long, text string").repartition(4)
    q = spark.createDataFrame(list(asked.items()), "query_id long, text string")
    got = V.keyword_topk(q, d, 7, query_block=bound).collect()
    split = {i: (t or "").split() for i, t in docs.items()}
    n, mean = len(docs), np.mean([len(w) for w in split.values()])
    want = {}
    for qid, text in asked.items():
        scores = {}
        for term in set((text or "").lower().split()):
            df = sum(term in w for w in split.values())
            for i, w in split.items():
                tf = w.count(term)
                if tf:
                    part = np.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
                    scores[i] = scores.get(i, 0) + part
        ranked = sorted(scores, key=lambda i: (-round(scores[i], 6), i))[:7]
        want |= {(qid, r + 1): (i, round(scores[i], 6)) for r, i in enumerate(ranked)}
    assert {(r.query_id, r["rank"]): (r.id, r.score) for r in got} == want


def test_zero_vector_scores_nothing(spark):
    idx = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "id long, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 1.0])], "query_id long, embedding array<double>")
    assert [r.id for r in V.vector_topk(q, idx, 5).collect()] == [2]


def test_embedding_holds_few_texts_at_once(spark):
    texts = {i: None if i % 7 == 0 else f"t{i}" * (i % 5) for i in range(95)}
    df = spark.createDataFrame(list(texts.items()), "id long, text string").withColumn("at", F.lit("2024-01-01").cast("timestamp")).coalesce(1)
    sizes = spark.sparkContext.accumulator(0)
    rows = V.embed(df, "id", "text", lambda ts: (sizes.add(len(ts)), [[float(len(t))] for t in ts])[1], batch=10, carry=["at"])
    got = {r.id: (r.text, r.embedding) for r in rows.collect()}
    assert got == {i: (t, None if t is None else [float(len(t))]) for i, t in texts.items()}
    assert sizes.value == sum(t is not None for t in texts.values()) and {r.at for r in rows.collect()} == {r.at for r in df.collect()}
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan  # before, a whole Arrow batch became Python objects


def test_embedding_batches(spark):
    seen = V.embed(spark.range(45).selectExpr("id", "concat('t', id) AS text").coalesce(1), "id", "text", lambda t: [[float(len(t))]] * len(t))
    sizes = sorted(r.embedding[0] for r in seen.collect())
    assert sizes == [5.0] * 5 + [20.0] * 40


def test_hash_embedding_has_unit_length(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a a d"), (3, "")], "id long, text string")
    got = {r.id: sum(x * x for x in r.embedding) for r in V.hash_embed(df, "id", "text", 32).collect()}
    assert got[1] == pytest.approx(1) and got[2] == pytest.approx(1) and got[3] == 0


def test_hybrid_prefers_agreement(spark):
    hits = lambda rows: spark.createDataFrame(rows, "query_id int, id int, score double")
    out = V.hybrid_topk(hits([(1, 1, 0.9), (1, 2, 0.8)]), hits([(1, 2, 7.0), (1, 3, 6.0)]), 3).orderBy("rank").collect()
    assert [r.id for r in out] == [2, 1, 3]


def test_merge_drops_repeated_and_empty_text(spark):
    hits = lambda rows: spark.createDataFrame(rows, "query_id int, id int, score double, text string")
    merged = V.merge_indexes(
        {"one": hits([(1, 1, 4.0, "x"), (1, 2, 2.0, "y")]), "two": hits([(1, 9, 0.5, "x"), (1, 8, 0.4, None), (1, 7, 0.3, "z"), (1, 6, 0.2, "")])}
    )
    got = [(r.source, r.id, r.norm_score) for r in merged.orderBy("rank").collect()]
    assert got == [("one", 1, 1.0), ("one", 2, 0.5), ("two", 7, 0.3)]
    context = V.build_context(merged).first().context
    assert context.startswith("\n[1] Source: one\nx\n") and "[3] Source: two\nz" in context


def test_headline_substrings(spark):
    news = spark.createDataFrame([(1, "ABCD rises, EFGH falls"), (2, "nothing"), (3, "")], "id int, title string")
    tickers = spark.createDataFrame([("ABCD",), ("EFGH",), ("QRSTUV",), ("",)], "ticker string")
    assert sorted((r.id, r.ticker) for r in V.headline_filter(news, tickers).collect()) == [(1, "ABCD"), (1, "EFGH")]


def test_headline_pieces_stay_in_their_tasks(spark):
    titles = {1: "AB CDEFG AB", 2: "xAByz", 3: "", 4: None, 5: "A", 6: "CDEF", 7: "AB CDEFG AB"}
    news = spark.createDataFrame(list(titles.items()), "id long, title string").repartition(3)
    words = ["AB", "CDEFG", "CDEF", "A", "zz", "", None, "AB"]
    tickers = spark.createDataFrame([(w,) for w in words], "ticker string").repartition(2)
    out = V.headline_filter(news, tickers)
    want = sorted((i, w) for i, t in titles.items() for w in {*words} - {"", None} if t and w in t)
    assert sorted((r.id, r.ticker) for r in out.collect()) == want
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # before, every piece was shuffled
    assert V.headline_filter(news, tickers.limit(0)).count() == 0


def test_decisions_pick_the_model_with_the_smallest_held_out_error(spark):
    from lakeops.plans import signals

    line = series(spark, "line", [10 + 0.5 * i for i in range(120)])
    wave = series(spark, "wave", [50 + 10 * np.sin(2 * np.pi * i / 30) + 0.1 * i for i in range(150)])
    short = series(spark, "short", [7.0, 7.5, 8.0])
    bars = line.unionByName(wave).unionByName(short)
    errors = {(r.symbol, r.model): r.rmse for r in signals.hold_out_errors(bars, trees=5).collect()}
    assert errors["line", "trend_seasonal"] < 1e-3 and errors["wave", "trend_seasonal"] < 1e-2
    assert errors["line", "forest"] > 1 and not any(s == "short" for s, _ in errors)
    got = {r.symbol: r for r in signals.forecast_decisions(bars, trees=5).collect()}
    assert set(got) == {"line", "wave", "short"}
    assert got["wave"].best_model == "trend_seasonal" and got["short"].best_rmse is None
    assert str(got["line"].sell_date) == "2024-05-29" and got["line"].expected_return > 0
    # the wave's next crest and trough, by its own formula
    ahead = [50 + 10 * np.sin(2 * np.pi * i / 30) + 0.1 * i for i in range(150, 180)]
    day = lambda i: str(np.datetime64("2024-01-01") + 150 + int(i))
    assert (str(got["wave"].buy_date), str(got["wave"].sell_date)) == (day(np.argmin(ahead)), day(np.argmax(ahead)))
