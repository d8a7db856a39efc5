import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnstat import EngineError, Weight, summarize
from cairnstat.functions.labels import auto_format, clean_label, ordinal, stat_label


def rank(values, p):
    values, n = sorted(values), len(values) * p
    return (values[n // 100 - 1] + values[n // 100]) / 2 if n % 100 == 0 else values[n // 100]


def test_percentile_rule(spark):
    out = summarize(spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double"), "x", stats=["p25", "median", "p75", "iqr"]).first()
    assert (out.p25, out["median"], out.p75, out.iqr) == (1.5, 2.5, 3.5, 2.0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=400), st.integers(1, 99))
def test_percentiles_against_ranks(spark, values, p):
    out = summarize(spark.createDataFrame([(float(x),) for x in values], "x double"), "x", stats=[f"p{p}"]).first()
    assert out[f"p{p}"] == rank(values, p)


def test_many_values_and_groups(spark):
    random.seed(1)
    data = [(random.randint(0, 2), random.gauss(0, 10)) for _ in range(3000)]
    out = {r.g: r for r in summarize(spark.createDataFrame(data, "g int, x double"), "x", by="g", stats=["p3", "p50", "p98"]).collect()}
    for g in (-1, 0, 1, 2):
        own = [x for k, x in data if g in (-1, k)]
        assert [out[g][f"p{p}"] for p in (3, 50, 98)] == [rank(own, p) for p in (3, 50, 98)]


def test_missing_groups_count_in_total(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (None, 3.0), (1, None), (0, float("nan"))], "g int, x double")
    out = {r.g: r["count"] for r in summarize(df, "x", by="g", stats=["count"]).collect()}
    assert out == {-1: 3, 0: 1, 1: 1}


def test_text_groups_and_subtotals(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)], "s string, k int, x double")
    out = {(r.s, r.k): r["sum"] for r in summarize(df, "x", by="s k", stats=["sum"], subtotals=True).collect()}
    assert out[("Total", -1)] == 6.0 and out[("a", -1)] == 3.0 and out[("b", 1)] == 3.0 and len(out) == 6


def test_weights(spark):
    df = spark.createDataFrame([(1.0, 2.0), (4.0, 1.0), (9.0, 0.0), (5.0, None)], "x double, w double")
    f = summarize(df, "x", stats=["count", "mean", "sum", "sd", "median"], weight=Weight("fweight", "w")).first()
    assert (f["count"], f["mean"], f["sum"], f["median"]) == (3, 2.0, 6.0, 1.0) and f["sd"] == pytest.approx(3 ** 0.5)
    a = summarize(df, "x", stats=["count", "mean", "sum"], weight=Weight("aweight", "w")).first()
    assert (a["count"], a["mean"], a["sum"]) == (2, 2.0, 4.0)
    with pytest.raises(EngineError):
        summarize(df, "x", stats=["sd"], weight=Weight("pweight", "w"))


def test_empty(spark):
    out = summarize(spark.createDataFrame([], "x double"), "x", stats=["count", "mean", "sum", "median"]).first()
    assert (out["count"], out["mean"], out["sum"], out["median"]) == (0, None, 0.0, None)


@pytest.mark.parametrize(("change", "code"), [({"variables": "s"}, 111), ({"variables": "nope"}, 111), ({"stats": ["mode"]}, 198), ({"excel": {"sheet": "a"}}, 198), ({"replace": True}, 198), ({"stats": ["first"]}, 198), ({"window": (1, 2)}, 198), ({"by": "minus"}, 198)])
def test_errors(spark, change, code):
    df = spark.createDataFrame([(1.0, "a", -1)], "x double, s string, minus int")
    with pytest.raises(EngineError) as e:
        summarize(df, **({"variables": "x"} | change))
    assert e.value.code == code


def test_window_before_filter(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 11)], "id int")
    assert summarize(df, "id", stats=["count"], where="id > 5", window=(1, 8), order_by="id").first()["count"] == 3


def test_labels():
    assert [ordinal(n) for n in (1, 2, 3, 4, 11, 12, 13, 21, 99)] == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "99th"]
    assert stat_label("p22") == "22nd percentile" and clean_label("A1. Age") == "Age" and clean_label("Age") == "Age"


def test_formats():
    from pyspark.sql import types as T

    assert auto_format(T.DoubleType(), 0, 1, True) == "%7.3f"
    assert auto_format(T.DoubleType(), -5, 12345.5, True) == "%10.1fc"
    assert auto_format(T.LongType(), 0, 999, False) == "%5.0f"
    assert auto_format(T.DateType(), None, None, False) == "%td"


def test_result_formats_and_labels(spark):
    from cairnstat.operators.metadata import annotate

    df = annotate(spark.createDataFrame([(1.5,), (2500.0,)], "x double"), "x", label="A1. Size")
    out = summarize(df, "x", stats=["count", "mean", "max"], format="auto")
    assert out.first().varlab == "Size"
    assert {f.name: f.metadata["format"] for f in out.schema if f.name in ("count", "max")} == {"count": "%3.0f", "max": "%7.0fc"}
    assert summarize(df, "x", stats=["max"], format="%9.2f").schema["max"].metadata["format"] == "%9.2f"


def test_weighted_spread_far_from_zero(spark):
    df = spark.createDataFrame([(1e9 + k, w) for k, w in ((0, 1.0), (1, 1.0), (2, 1.0))], "x double, w double")
    assert summarize(df, "x", stats=["sd"], weight=Weight("fweight", "w")).first().sd == pytest.approx(1.0, rel=1e-6)
    df = spark.createDataFrame([(g * 1e9 + k, float(w), g) for g in (0, 1) for k, w in ((0, 1), (1, 2), (2, 5), (7, 3))], "x double, w double, g int")
    got = {r.g: r.sd for r in summarize(df, "x", by="g", stats=["sd"], weight=Weight("fweight", "w")).collect()}
    every = [0] + [1] * 2 + [2] * 5 + [7] * 3
    mean = sum(every) / 11
    want = (sum((x - mean) ** 2 for x in every) / 10) ** 0.5
    assert got[0] == pytest.approx(want, rel=1e-9) and got[1] == pytest.approx(want, rel=1e-6)


def test_fast_with_weights(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, 1.0), (4.0, 1.0)], "x double, w double")
    assert summarize(df, "x", stats=["median"], fast=True, weight=Weight("fweight", "w")).first()["median"] == 0.0
    assert summarize(df, "x", stats=["median"], fast=True).first()["median"] == 2.0


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_percentile_levels(spark, levels):
    from cairnstat.operators.percentiles import percentiles

    random.seed(4)
    data = [(g, random.gauss(0, 5)) for g in (1, 2) for _ in range(5000)]
    rows = spark.createDataFrame(data, "g int, x double").selectExpr("g", "x", "1.0D AS w")
    out = {r.g: r for r in percentiles(rows, ["g"], [1, 50, 75, 99], levels=levels).collect()}
    for g in (1, 2):
        assert [out[g][f"p{p}"] for p in (1, 50, 75, 99)] == [rank([x for k, x in data if k == g], p) for p in (1, 50, 75, 99)]


def test_numbers_in_order(spark):
    from cairnstat.operators.select import group_number, number_sorted, row_window

    df = spark.range(0, 30_000, numPartitions=5).selectExpr("id", "(id * 7919) % 30011 AS k")
    want = {r: n for n, r in enumerate(sorted((k * 7919) % 30011 for k in range(30_000)), 1)}
    assert all(want[r.k] == r.position for r in number_sorted(df, "k").collect())
    got = sorted(r.k for r in row_window(df, 11_001, 11_010, "k").collect())
    assert [want[k] for k in got] == list(range(11_001, 11_011))
    assert {(r.id, r.group) for r in group_number(spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, s string"), ["s"]).collect()} == {(1, 2), (2, 3), (3, 1), (4, 2)}
