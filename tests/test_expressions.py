import pytest

from cairnstat import UnsupportedExpression
from cairnstat.functions.expressions import compile_filter, filter_rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.5), (4, "12", -1.0)], "x int, s string, v double")


@pytest.mark.parametrize(("text", "want"), [
    ("x > 2", [3, 4]), ("x == 1 | x = 3", [1, 3]), ("!(x > 2)", [1, 2]), ("!(v > 0)", [4]), ("(x==1 | x==2) & s != 'b'", [1]),
    ("missing(v)", [2]), ("!missing(s) & x >= 2", [2, 4]), ("inrange(x, 2, 3)", [2, 3]), ("inlist(s, 'a', \"b\")", [1, 2]),
    ("real(s) > 5", [4]), ("string(x) == '3'", [3]), ("v == .", [2]), ("v != .", [1, 3, 4]), ("v < -0.5", [4]), ("((x)) ~= 1", [2, 3, 4]),
])
def test_filter(df, text, want):
    assert sorted(r.x for r in filter_rows(df, text).collect()) == want


@pytest.mark.parametrize("text", ["mod(x,2)==0", "x", "x >", "", "x == 1 &", "foo(x) > 1", "x == 1)", "inlist(x)", "missing(x, v)", "unknown > 1", "x # 1"])
def test_rejected(df, text):
    with pytest.raises(UnsupportedExpression) as e:
        compile_filter(text, df.columns)
    assert e.value.code == 198


def test_extensions(df):
    assert sorted(r.x for r in filter_rows(df, "mod(x, 2) == 0", extensions=True).collect()) == [2, 4]


def test_pushdown(spark, sf_dir):
    plan = filter_rows(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderkey > 5").select("o_orderkey")._jdf.queryExecution().toString()
    assert "GreaterThan(o_orderkey,5)" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan
