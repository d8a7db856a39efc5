import pytest

from cairnstat import EngineError, tabulate
from cairnstat.operators.metadata import annotate


@pytest.fixture(scope="module")
def cars(spark):
    rows = [(3, 0, 1), (3, 1, 1), (4, 1, 0), (4, 1, 1), (5, 0, 0), (None, 0, 1), (3, None, 1)]
    return annotate(spark.createDataFrame(rows, "rep int, foreign int, b int"), "foreign", label="Origin", value_labels={0: "Domestic", 1: "Foreign made"})


def test_one_way(cars):
    out = {r.vallab: r for r in tabulate(cars, "rep", types=["prop", "pct"]).collect()}
    assert {k: r.freq for k, r in out.items()} == {"3": 3, "4": 2, "5": 1}
    assert out["3"].prop == 0.5 and out["3"].pct == 50.0 and out["3"].total == 6


def test_labels_and_fallback(cars):
    out = tabulate(cars, "foreign rep").collect()
    assert {r.vallab for r in out if r.varname == "foreign"} == {"Domestic", "Foreign made"}
    assert {r.varlab for r in out} == {"Origin", "rep"}


def test_cross_total_has_no_missing(cars):
    out = tabulate(cars, "rep", cross="foreign", stats=["row", "col", "cell"], types=["prop", "pct"])
    rows = out.collect()
    assert all(v is not None for r in rows for v in r)
    total = next(r for r in rows if r.vallab == "Total")
    assert (total.freq0, total.freq1, total.rowfreq, total.colprop0, total.pct_all, total.varlab) == (2, 3, 5, 1.0, 100.0, "Grand total")
    assert out.columns[:3] == ["varname", "varlab", "vallab"] and out.columns[-1] == "total_all"


def test_by_strata_fill_zero(cars):
    out = tabulate(cars, "rep", by="b", cross="foreign").collect()
    own = {(r.b, r.vallab): r for r in out}
    assert own[(1, "4")].freq0 == 0 and own[(-1, "Total")].total_all == 5


def test_pruning(cars):
    assert not [c for c in tabulate(cars, "rep", cross="foreign").columns if c.startswith(("row", "cell")) or "pct" in c]


def test_binary(cars):
    out = tabulate(cars, "foreign", binary=True).first()
    assert (out.freq_domestic, out.freq_foreign_made, out.total) == (3, 3, 6)


@pytest.mark.parametrize("kw", [
    {"stats": ["col"]}, {"cross": "foreign", "stats": ["col", "col"]}, {"cross": "foreign", "stats": ["x"]}, {"types": ["prop", "prop"]}, {"types": ["x"]}, {"by": "b", "cross": "b"}, {"binary": True}, {"replace": True}, {"excel": {"sheet": "a"}}])
def test_errors(cars, kw):
    with pytest.raises(EngineError) as e:
        tabulate(cars, "rep", **kw)
    assert e.value.code == 198


def test_binary_needs_equal_labels(spark):
    df = spark.createDataFrame([(0, 0), (1, 1)], "a int, b int")
    df = annotate(annotate(df, "a", value_labels={0: "No", 1: "Yes"}), "b", value_labels={0: "False", 1: "True"})
    with pytest.raises(EngineError):
        tabulate(df, "a b", binary=True)


def test_empty(spark):
    assert tabulate(spark.createDataFrame([], "a int"), "a").count() == 0
