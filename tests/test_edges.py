"""Hand-written edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from lakeops.functions import cases, geo, payload, text, times
from lakeops.operators import aggregate as A
from lakeops.operators import insurance as I
from lakeops.operators import joins as J
from lakeops.operators import portfolio as P
from lakeops.operators import project as PR
from lakeops.operators import series as S
from lakeops.operators import topk as K
from lakeops.operators import windows as W
from lakeops.sources import messages as M
from lakeops.sources.files import flatten_struct


def one(df):
    return df.first()[0]


def expr(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


def test_haversine_properties(spark):
    v = [F.lit(float(x)) for x in (12.9, 77.6, 13.1, 77.9)]
    there = expr(spark, geo.haversine_m(*v))
    back = expr(spark, geo.haversine_m(v[2], v[3], v[0], v[1]))
    assert there == pytest.approx(back) and there > 0
    assert expr(spark, geo.haversine_m(v[0], v[1], v[0], v[1])) == 0
    zero, half = F.lit(0.0), F.lit(180.0)
    assert expr(spark, geo.haversine_m(zero, zero, zero, half)) == pytest.approx(math.pi * 6_371_000)


def test_bearing_quadrants(spark):
    z, o = F.lit(0.0), F.lit(1.0)
    assert expr(spark, geo.bearing_deg(z, z, o, z)) == pytest.approx(0)
    assert expr(spark, geo.bearing_deg(z, z, z, o)) == pytest.approx(90)
    assert expr(spark, geo.bearing_deg(z, o, z, z)) == pytest.approx(270)


def test_delta_resets(spark):
    rows = [
        (1, "v", None, 1.0, 1.0), (2, "v", "a", 1.0, 2.0), (3, "v", "a", 1.0, 2.0), (4, "v", "", 1.0, 3.0),
        (5, "v", "b", 1.0, 4.0), (6, "v", "c", 1.0, 5.0), (7, "v", None, 1.0, 6.0), (1, "w", "z", 5.0, 5.0),
    ]
    df = spark.createDataFrame(rows, "s long, vehicle_id string, trip_id string, lat double, lon double")
    df = df.withColumn("event_time", F.timestamp_seconds(F.col("s") * 1800))
    got = {(r.vehicle_id, r.s): r.delta_m for r in W.with_delta_m(df).collect()}
    assert got[("v", 1)] == 0  # no previous point
    assert got[("v", 2)] > 100_000  # previous trip is null: not a change
    assert got[("v", 3)] == 0  # same place
    assert got[("v", 4)] == 0 and got[("v", 5)] == 0  # blank trip, then blank to named
    assert got[("v", 6)] == 0 and got[("v", 7)] == 0  # changed trip, null trip
    assert got[("w", 1)] == 0


def test_not_in_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = lambda rows: spark.createDataFrame(rows, "k int")
    got = lambda rows, **kw: sorted(str(r.k) for r in J.keep_not_in(left, keys(rows), "k", **kw).collect())
    assert got([(1,)]) == ["2"]
    assert got([(1,), (None,)]) == []
    assert got([]) == ["1", "2", "None"]
    assert got([(1,), (None,)], null_aware=False) == ["2", "None"]


def test_pair_within_bounds(spark):
    rows = [("d", "s", 0), ("d", "e", 0), ("d", "e", 4_999_999), ("d", "e", 5_000_000), ("d", "e", 1), ("x", "e", 1_000_000)]
    df = spark.createDataFrame(rows, "k string, kind string, us long").withColumn("ts", F.timestamp_micros("us"))
    pairs = J.pair_within(df, "k", "ts", F.col("kind") == "s", F.col("kind") == "e", 5, ["us"])
    assert sorted((r.end_us, r.break_seconds) for r in pairs.collect()) == [(1, 0), (4_999_999, 4)]
    first = J.pair_within(df, "k", "ts", F.col("kind") == "s", F.col("kind") == "e", 5, ["us"], first_only=True)
    assert [r.end_us for r in first.collect()] == [1]


def test_explode_join_keeps_empty(spark):
    df = spark.createDataFrame([(1, [("A", 1.0), ("B", 2.0)]), (2, []), (3, None)], "id int, t array<struct<ticker:string,s:double>>")
    got = sorted((r.id, r.ticker or "") for r in J.explode_join(df, "t").collect())
    assert got == [(1, "A"), (1, "B"), (2, ""), (3, "")]


def test_envelope_cases(spark):
    bodies = [
        '{"Message": "{\\"detail\\": {\\"a\\": 1}}"}', '{"detail": {"a": 2}}', '{"a": 3}', "", "  ", None, "oops",
        '{"Message": "not json"}', '{"Message": "{\\"x\\": 1}"}', '{"detail": {}}', '{"Message": null}', '{"a": 4} trailing',
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = sorted(r.detail for r in M.unwrap_envelope(df).collect())
    assert got == ['{"a": 3}', '{"a":1}', '{"a":2}']


def test_tolerant_parse(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "{broken"), (3, '{"b": 2}')], "id int, v string")
    good, bad = M.parse_json_tolerant(df, "v", "a INT")
    assert sorted((r.id, r.a) for r in good.collect()) == [(1, 1), (3, None)]
    assert [r.id for r in bad.collect()] == [2]


def test_base64_and_repair(spark):
    assert expr(spark, payload.from_base64(F.lit("eyJhIjoxfQ=="))) == '{"a":1}'
    assert expr(spark, payload.from_base64(F.lit("%%%"))) is None
    assert expr(spark, payload.repair_quotes(F.lit('{"a":"1""b":"2"}'))) == '{"a":"1","b":"2"}'
    assert expr(spark, payload.rebuild_object(F.lit(' ["a":1\n"b":2] '))) == '{"a":1,"b":2}'
    assert expr(spark, payload.safe_unsigned(F.lit("256"), 8)) is None
    assert expr(spark, payload.safe_unsigned(F.lit("255"), 8)) == 255
    assert expr(spark, payload.safe_number(F.lit(""))) is None
    assert expr(spark, payload.int_field(F.lit('{"a": "x"}'), "a")) == 0


def test_times(spark):
    a, b = F.lit("2024-01-01 00:00:00.9").cast("timestamp"), F.lit("2024-01-01 00:00:05.8").cast("timestamp")
    assert expr(spark, times.seconds_between(a, b)) == 4
    assert expr(spark, times.text_seconds_between(a, b)) == 5
    assert expr(spark, times.parse_iso(F.lit("nonsense"))) is None
    assert expr(spark, times.iso_head(F.lit("2024-01-01T10:00:00.123456Z"))) == "2024-01-01 10:00:00.123"


def test_buckets_and_status(spark):
    bucket = lambda v: expr(spark, cases.bucketize(F.lit(v).cast("double"), [10, 20], ["low", "mid", "high"], "unknown"))
    assert [bucket(v) for v in (None, 9.99, 10.0, 20.0)] == ["unknown", "low", "mid", "high"]
    day = lambda d: F.lit(d).cast("date")
    status = lambda d: expr(spark, cases.validity_status(day("2024-01-01"), day("2024-12-31"), day(d)))
    assert [status(d) for d in ("2024-01-01", "2024-12-31", "2025-01-01")] == ["ACTIVE", "ACTIVE", "EXPIRED"]


def test_title_cleaning(spark):
    page = "<!DOCTYPE html><script>var a;</script><h1>Hello,&nbsp;big &amp; <b>wide</b> world of data</h1>"
    title = lambda t: expr(spark, text.clean_title(F.lit(t)))
    assert title(page) == "Hello big wide world of"
    steps = {
        "<!doctype HTML><p>a</p>": "a", "x<STYLE a=b>p{}</style>y": "xy", "a&NBSP;b": "a b", "a&lt;b&gt;c": "abc",
        "*snake_case* `code` \"it's\"": "snakecase code its", "a-b/c, d.": "abc d", "  a \t\n b  ": "a b", "1 2 3 4 5 6": "1 2 3 4 5",
    }
    assert {t: title(t) for t in steps} == steps


def test_optional_and_resolved_filters(spark):
    df = spark.createDataFrame([("Mountain Lions",), ("Coast Kings",)], "name string")
    lookup = spark.createDataFrame([("ML", "Mountain Lions")], "short string, full string")
    names = lambda t: [r.name for r in PR.resolve_name(df, "name", t, lookup).collect()]
    assert names(" ml ") == ["Mountain Lions"]
    assert names("king") == ["Coast Kings"]
    assert PR.where_optional(df, "name", None).count() == 2


def bars(spark, closes, **fixed):
    rows = [("s", i, c, c + fixed.get("up", 1), c - fixed.get("down", 1), c, 10) for i, c in enumerate(closes)]
    df = spark.createDataFrame(rows, "symbol string, i int, open double, high double, low double, close double, volume long")
    return df.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")))


def by_day(df, col):
    return [r[col] for r in df.orderBy("date").collect()]


def test_rsi_without_losses_and_flat(spark):
    assert by_day(S.rsi(bars(spark, [1.0, 2.0, 3.0])), "rsi") == [50.0, 50.0, 50.0]
    assert by_day(S.rsi(bars(spark, [5.0] * 4)), "rsi") == [50.0] * 4
    got = by_day(S.rsi(bars(spark, [10.0, 9.0, 11.0])), "rsi")
    assert got[0] == 50 and got[1] == 0 and got[2] == pytest.approx(100 - 100 / 3)


def test_atr_first_row_and_volatility(spark):
    assert by_day(S.atr(bars(spark, [10.0, 12.0])), "atr14")[0] == 2
    flat = S.annualised_volatility(bars(spark, [3.0, 3.0, 3.0])).first()
    assert flat.volatility == 0


def test_patterns_need_three_bars(spark):
    assert S.candle_patterns(bars(spark, [1.0, 2.0])).count() == 0
    flat = S.best_pattern(bars(spark, [1.0, 1.0, 1.0], up=0, down=0)).first()
    assert (flat.best_pattern, flat.pattern_strength) == ("Doji", 0)


def test_pattern_rule_by_hand(spark):
    rows = [("s", 1, 10.0, 11.0, 9.0, 10.5), ("s", 2, 10.0, 10.2, 8.0, 8.5), ("s", 3, 8.0, 11.5, 7.9, 11.0)]
    df = spark.createDataFrame(rows, "symbol string, date int, open double, high double, low double, close double")
    found = {r.pattern for r in S.detected_patterns(df).collect()}
    assert "Bullish Engulfing" in found and "Piercing Line" in found and "Bearish Engulfing" not in found
    assert S.best_pattern(df).first().best_pattern == "Bullish Engulfing"


@pytest.mark.parametrize("raws", [[1.0], [0.0] * 4, [0.0, 0.0, 100.0], [1.0] * 33, [float(i) for i in range(34)], [50.0] + [0.1] * 20])
def test_allocation_floor(spark, raws):
    df = spark.createDataFrame(list(enumerate(raws)), "id int, raw_allocation double")
    got = [r.allocation_pct for r in P.normalise_with_floor(df).collect()]
    assert sum(got) == pytest.approx(100)
    assert min(got) >= min(3.0, 100 / len(raws)) - 1e-9


def test_weights_fall_back_to_equal(spark):
    df = spark.createDataFrame([("s", 0.0, 10.0), ("s", None, 20.0)], "symbol string, rmse double, forecast double")
    assert P.weighted_forecast(df).first().weighted_forecast == 15


def test_scalar_rules(spark):
    v = lambda x: F.lit(float(x))
    assert expr(spark, P.kelly_fraction(v(0.1), v(0))) == 0 and expr(spark, P.kelly_fraction(v(-1), v(2))) == 0
    assert expr(spark, P.confidence(v(0.1), v(2))) == 0.75 and expr(spark, P.confidence(v(-9), v(-2))) == -1
    assert expr(spark, P.confidence(v(0.2), v(-1))) == 0.1
    assert [expr(spark, P.risk_category(v(x), v(0))) for x in (0.19, 0.2, 0.5)] == ["Low", "Medium", "High"]
    said = P.decision_text(v(0), v(0.125), F.lit("Low"), F.lit(None).cast("string"))
    assert expr(spark, said) == "Hold | Confidence: 12.5% | Risk: Low"
    assert expr(spark, P.raw_allocation(v(-1), v(0), v(0), v(0), F.lit("?"))) == 0


def test_rmse_masks_nulls_and_directions(spark):
    df = spark.createDataFrame([("s", 1, 1.0, 2.0), ("s", 2, None, 9.0), ("s", 3, 3.0, 3.0)], "s string, t int, a double, p double")
    assert P.rmse(df, "s", "a", "p").first().rmse == pytest.approx(math.sqrt(0.5))
    steps = spark.createDataFrame([("s", 1, 1.0, 1.0), ("s", 2, 2.0, 3.0), ("s", 3, 1.0, 4.0), ("s", 4, 0.0, 3.0)], "s string, t int, a double, p double")
    assert P.directional_accuracy(steps, "s", "t", "a", "p").first().directional_accuracy == pytest.approx(2 / 3)


def test_argmax_takes_the_earliest(spark):
    df = spark.createDataFrame([("s", 3, 5.0), ("s", 1, 5.0), ("s", 2, 1.0)], "k string, t int, v double")
    assert K.arg_extreme(df, "k", "v", "t", "max").first().max_at == 1
    assert K.arg_extreme(df, "k", "v", "t", "min").first().min_at == 2


def test_standings_tie_has_gap(spark):
    df = spark.createDataFrame([(1, "a", 10, 2), (1, "b", 10, 2), (1, "c", 5, 0)], "y int, n string, p int, w int")
    got = {r.n: r["rank"] for r in W.rank_within(df, "y", ["-p", "-w"]).collect()}
    assert got == {"a": 1, "b": 1, "c": 3}


def test_profile_and_flatten(spark):
    df = spark.createDataFrame([(1, None), (3, 2.0)], "a int, b double")
    got = {r.column_name: r for r in A.profile(df, ["a", "b"]).collect()}
    assert got["a"]["mean"] == 2 and got["b"]["null_count"] == 1
    nested = spark.sql("SELECT named_struct('x', named_struct('y', 1), 'z', 2) AS a, 3 AS b")
    assert flatten_struct(nested).columns == ["a.x.y", "a.z", "b"]


def test_profile_of_any_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('10', DATE'2024-01-02', map('a', 1), true, array(2)), ('x', NULL, NULL, false, array(1)) "
        "AS t(`a text`, d, m, b, l)"
    )
    got = {r.column_name: r for r in A.profile(df, df.columns).collect()}
    assert (got["a text"]["mean"], got["a text"].least, got["a text"].greatest) == (10, "10", "x")
    assert (got["d"]["mean"], got["d"].null_count, got["d"].least) == (None, 1, "2024-01-02")
    assert (got["m"].null_count, got["m"].least) == (1, None)
    assert (got["b"]["mean"], got["b"].greatest, got["l"].least) == (0.5, "true", "[1]")
    none = A.profile(df.limit(0), ["a text"]).first()
    assert (none.row_count, none["mean"], none.least) == (0, None, None)


def test_rows_with_keys_of_another(spark):
    keys = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    assert [r.id for r in A.with_keys_of(spark.range(5), keys, "id").collect()] == [1]


def test_coverage_gaps_and_overlaps(spark):
    rows = [("h", 1, "2024-01-01", "2024-01-31"), ("h", 2, "2024-01-15", "2024-02-10"), ("h", 3, "2024-02-11", "2024-02-20"), ("h", 4, "2024-03-01", "2024-03-05")]
    df = spark.createDataFrame(rows, "h string, id int, s string, e string").selectExpr("h", "id", "date(s) s", "date(e) e")
    got = [(str(r.cover_start), str(r.cover_end), r.policies, r.overlaps, r.gap_days) for r in I.coverage_timeline(df, "h", "s", "e", "id").orderBy("cover_start").collect()]
    assert got == [("2024-01-01", "2024-02-20", 3, 1, 0), ("2024-03-01", "2024-03-05", 1, 0, 9)]


def test_sketch_estimate(spark):
    df = spark.range(2000).selectExpr("id % 3 AS k", "id % 500 AS u")
    got = I.merge_sketches(I.distinct_sketch(df, ["k"], "u"), ["k"]).collect()
    assert all(abs(r.distinct_estimate - 500) < 25 for r in got)
