"""The chunked operators equal the plain windows, also with a hot key and ties."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import ordered as O
from lakeops.operators import windows as W

ORDER = ["t", "id"]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, repeated times, null values and a null key."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(20)}"
        value = None if rng.random() < 0.3 else round(rng.uniform(-5, 5), 2)
        rows.append((key, rng.randrange(400), i, value))
    return spark.createDataFrame(rows, "key string, t long, id long, value double").cache()


def same(a, b):
    rows = lambda df: sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
    assert rows(a) == rows(b)


def window(order=ORDER):
    return Window.partitionBy("key").orderBy(*O.sort_columns(order))


CHUNKS = [None, 10, 1000]


def cut(width):
    return None if width is None else F.floor(F.col("t") / width)


@pytest.mark.parametrize("chunk", CHUNKS)
def test_with_previous(skewed, chunk):
    got = O.with_previous(skewed, "key", ORDER, ["value", "id"], cut(chunk))
    want = skewed.withColumns({"prev_value": F.lag("value").over(window()), "prev_id": F.lag("id").over(window())})
    same(got, want)


def test_with_previous_descending(skewed):
    order = ["-t", "-id"]
    got = O.with_previous(skewed, "key", order, ["id"], F.floor(F.col("t") / 10))
    same(got, skewed.withColumn("prev_id", F.lag("id").over(window(order))))


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("order", [ORDER, ["-t", "id"]])
def test_row_numbers(skewed, chunk, order):
    same(O.row_numbers(skewed, "key", order, "n", cut(chunk)), skewed.withColumn("n", F.row_number().over(window(order))))


def test_row_numbers_overall(skewed):
    got = O.row_numbers(skewed, None, ["value", "id"], "n")
    same(got, skewed.withColumn("n", F.row_number().over(Window.orderBy("value", "id"))))


@pytest.mark.parametrize("kind,fold", [("sum", F.sum), ("max", F.max), ("min", F.min)])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running(skewed, kind, fold, inclusive):
    got = O.running(skewed, "key", ORDER, {"r": F.col("id")}, kind, F.floor(F.col("t") / 10), inclusive)
    frame = window().rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = skewed.withColumn("r", fold("id").over(frame))
    if kind == "sum":
        want = want.fillna(0, ["r"])
    same(got, want)


@pytest.mark.parametrize("by", ["key", None])
@pytest.mark.parametrize("order", [["-t"], ["t", "-value"]])
def test_ranks_in_pieces(skewed, by, order):
    got = O.ranks(skewed, by, order, "r")
    w = Window.partitionBy(*([by] if by else [])).orderBy(*O.sort_columns(order))
    same(got, skewed.withColumn("r", F.rank().over(w)))


def test_ranks_all_equal(spark):
    df = spark.range(500).withColumn("v", F.lit(1.0))
    assert O.ranks(df, None, ["-v"], "r").agg(F.max("r")).first()[0] == 1


def test_fill_both_ways(skewed):
    upto = window().rowsBetween(Window.unboundedPreceding, 0)
    onwards = window().rowsBetween(0, Window.unboundedFollowing)
    tens = cut(10)
    same(
        O.fill_forward(skewed, "key", ORDER, ["value"], tens),
        skewed.withColumn("value", F.last("value", ignorenulls=True).over(upto)),
    )
    same(
        O.fill_backward(skewed, "key", ORDER, ["value"], tens),
        skewed.withColumn("value", F.first("value", ignorenulls=True).over(onwards)),
    )


@pytest.mark.parametrize("size", [9, 10, 64, 5000])
def test_blocks_give_the_plain_trailing_sum(skewed, size):
    b = O.split_blocks(skewed, "key", ORDER, 9, size, F.floor(F.col("t") / 10))
    got = O.drop_halo(b.withColumn("s", F.sum("id").over(O.block_window("key", 10))))
    same(got, skewed.withColumn("s", F.sum("id").over(window().rowsBetween(-9, 0))))


def test_block_halo_must_fit(skewed):
    with pytest.raises(ValueError):
        O.split_blocks(skewed, "key", ORDER, 10, 5)


def test_ema_blocks_equal_one_run(spark):
    rng = random.Random(3)
    rows = [("a", i, rng.uniform(50, 60)) for i in range(1200)]
    df = spark.createDataFrame(rows, "key string, t long, x double")
    got = {r.t: r.y for r in W.ema(df, "key", "t", {"y": ("x", 5)}, cut(100), size=150).collect()}
    y = rows[0][2]
    for _, t, x in rows:
        y = y if t == 0 else y + (x - y) * 2 / 6
        assert got[t] == pytest.approx(y, abs=1e-11)


@pytest.mark.parametrize("kind", ["text", "date", "decimal", "flag", "bytes"])
@pytest.mark.parametrize("sign", ["", "-"])
def test_any_orderable_type(spark, kind, sign):
    cast = {
        "text": "IF(id % 50 = 0, NULL, concat('Name é', format_string('%04d', id % 700)))",
        "date": "date_add(date'2020-01-01', int(id % 300))",
        "decimal": "CAST(id % 400 AS DECIMAL(20, 3))",
        "flag": "id % 2 = 0",
        "bytes": "CAST(concat('x', id % 90) AS BINARY)",
    }[kind]
    df = spark.range(3000).selectExpr("id", f"{cast} AS s")
    order = [f"{sign}s"]
    w = Window.orderBy(*O.sort_columns(order))
    same(O.ranks(df, None, order, "r"), df.withColumn("r", F.rank().over(w)))
    both = [f"{sign}s", "id"]
    w = Window.orderBy(*O.sort_columns(both))
    same(O.row_numbers(df, None, both, "r"), df.withColumn("r", F.row_number().over(w).cast("long")))
