import json
import zipfile
from dataclasses import asdict
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cairnstat import EngineError, Frames, Metadata, describe, describe_metadata, read, summarize, write
from cairnstat.operators.metadata import annotate, returned
from cairnstat.operators.select import encode_categories, widest
from cairnstat.sources import dta
from cairnstat.sources.parquetio import has_metadata_key, load_metadata
from cairnstat.sources.xlsx import save_tables


@pytest.fixture()
def ten(spark):
    return spark.createDataFrame([(n, float(n) * 1.5, f"row {n}", date(2020, 1, n), datetime(2020, 1, n, 12)) for n in range(1, 11)], "id int, v double, s string, d date, t timestamp_ntz")


def test_round_trip_types(spark, ten, tmp_path):
    back = read(spark, write(ten, f"{tmp_path}/all"))
    assert back.dtypes == ten.dtypes and back.orderBy("id").collect() == ten.orderBy("id").collect()


def test_window_then_filter(spark, ten, tmp_path):
    path = write(ten.coalesce(1), f"{tmp_path}/w")
    assert read(spark, path, "id", "id > 5", (1, 8)).count() == 3
    assert read(spark, path, window=(100, 200)).count() == 0


def test_window_over_files(spark, tmp_path):
    spark.range(1, 101, numPartitions=1).coalesce(1).write.option("maxRecordsPerFile", 30).parquet(f"{tmp_path}/many.parquet")
    assert sorted(r.id for r in read(spark, f"{tmp_path}/many.parquet", window=(25, 65)).collect()) == list(range(25, 66))


def test_large_filter(spark, tmp_path):
    df = spark.range(1, 120_001).withColumn("grp", (F.col("id") % 3).cast("byte"))
    out = read(spark, write(df, f"{tmp_path}/big"), where="grp > 0").agg(F.count("*"), F.min("id"), F.max("id")).first()
    assert tuple(out) == (80_000, 1, 119_999)


def test_categories(spark, tmp_path):
    df = spark.createDataFrame([(1, "red"), (2, "blue"), (3, "red"), (4, "green"), (5, ""), (6, None)], "i int, cat string")
    df.write.parquet(f"{tmp_path}/cat.parquet")
    out = read(spark, f"{tmp_path}/cat.parquet", catmode="encode", categories=["cat"])
    assert [r.cat for r in out.orderBy("i").collect()] == [3, 1, 3, 2, None, None] and out.schema["cat"].metadata["value_label"] == "cat_1"
    assert encode_categories(df, ["cat"], "both").columns == ["i", "cat", "cat_id"]
    taken = df.withColumns({"cat_id": F.lit(1), "cat_catid": F.lit(1)})
    with pytest.raises(EngineError):
        encode_categories(taken, ["cat"], "both")


def test_metadata_round_trip(spark, tmp_path):
    df = annotate(spark.createDataFrame([(1,), (2,)], "x int"), "x", label="Variable X", value_label="xlbl", value_labels={1: "One", 2: "Two"}, notes=["n1"])
    path = write(df, f"{tmp_path}/meta", label="Data", notes=["d1"])
    back = read(spark, path)
    assert back.schema["x"].metadata["value_labels"] == {"1": "One", "2": "Two"} and back.schema["x"].metadata["notes"] == ["n1"]
    frames = describe_metadata(back, notes=["d1"])
    assert set(frames) == {"_dtvars", "_dtlabel", "_dtnotes", "_dtinfo"}
    assert set(describe_metadata(spark.range(3).toDF("x"))) == {"_dtvars", "_dtinfo"}
    assert not read(spark, path, nolabel=True).schema["x"].metadata
    bad = Metadata.of(df)
    bad.min_reader_version = 99
    with pytest.raises(EngineError) as e:
        Metadata.from_json(bad.to_json())
    assert e.value.code == 459


def test_partitions_and_guards(spark, ten, tmp_path):
    df = ten.withColumn("g", (F.col("id") > 5).cast("int"))
    path = write(df, f"{tmp_path}/parts", partition_by="g")
    assert read(spark, path).filter("g = 1").count() == 5
    with pytest.raises(EngineError) as e:
        write(df, f"{tmp_path}/parts", partition_by="g")
    assert e.value.code == 602
    write(df, f"{tmp_path}/parts", partition_by="g", replace=True)
    for kw, code in (({"compress": "invalid"}, 198), ({"partition_by": "nope"}, 111)):
        with pytest.raises(EngineError) as e:
            write(df, f"{tmp_path}/x", **kw)
        assert e.value.code == code
    with pytest.raises(EngineError) as e:
        read(spark, f"{tmp_path}/nothing")
    assert e.value.code == 601
    with pytest.raises(EngineError) as e:
        read(spark, path, "zz*")
    assert e.value.code == 111


def test_texts_stay(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, "€ £ ¥ ©")], "i int, s string")
    assert [r.s for r in read(spark, write(df, f"{tmp_path}/u")).orderBy("i").collect()] == ["a", "", "€ £ ¥ ©"]


def test_wide(spark, tmp_path):
    df = spark.range(20).select("id", *[(F.col("id") * k).alias(f"var{k}") for k in range(200)])
    back = read(spark, write(df, f"{tmp_path}/wide"), "var19? id")
    assert back.columns == [f"var{k}" for k in range(190, 200)] + ["id"] and back.count() == 20


def test_filename_column_and_lists(spark, tmp_path):
    for k in ("2019", "2020x"):
        spark.range(2).write.parquet(f"{tmp_path}/y-{k}.parquet")
    assert {r.year for r in read(spark, f"{tmp_path}/y-*.parquet", filename="year").collect()} == {"2019", "2020x"}
    assert read(spark, [f"{tmp_path}/y-2019", f"{tmp_path}/y-2020x.parquet"]).count() == 4
    assert read(spark, f"{tmp_path}", recursive=True).count() == 4


def test_empty_table(spark, tmp_path):
    assert read(spark, write(spark.createDataFrame([], "x int"), f"{tmp_path}/none")).count() == 0


def test_describe(spark, ten, tmp_path):
    info, rows = describe(spark, write(ten, f"{tmp_path}/d"), detailed=True)
    assert info == {"N": 10, "k": 5, "varlist": "id v s d t"}
    assert {r.varname: r.vartype for r in rows.collect()} == {"id": "long", "v": "double", "s": "str6", "d": "date", "t": "datetime"}


def test_dta(spark, tmp_path):
    df = annotate(spark.createDataFrame([(1, 2.5, "a"), (2, -1.0, "b")], "k int, x double, s string"), "k", label="Key", value_labels={1: "One", 2: "Two"})
    path = dta.write_dta(df, f"{tmp_path}/f.dta")
    back = dta.read_dta(spark, path)
    assert back.schema["k"].metadata["label"] == "Key" and [r.x for r in back.orderBy("k").collect()] == [2.5, -1.0]
    out = dta.export(spark, f"{tmp_path}/from_dta", path)
    assert read(spark, out).count() == 2
    dta.import_(spark, f"{tmp_path}/g.dta", out)
    assert summarize(f"{tmp_path}/g.dta", "x", stats=["count"]).first()["count"] == 2
    with pytest.raises(EngineError):
        dta.write_dta(df, path)


def test_workbook(spark, tmp_path):
    df = annotate(spark.createDataFrame([(1, "a<b"), (None, None)], "n int, s string"), "n", label="Number")
    path = save_tables({"one": df}, f"{tmp_path}/book")
    with zipfile.ZipFile(path) as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
    assert "Number" in sheet and "a&lt;b" in sheet
    for bad, code in ((f"{tmp_path}/book", 602), ("../x", 198), (f"{tmp_path}/no/x", 601)):
        with pytest.raises(EngineError) as e:
            save_tables({"one": df}, bad)
        assert e.value.code == code


def test_frames(spark):
    frames = Frames(spark)
    frames.put("_df", spark.range(3))
    assert spark.table("_df").count() == 3 and frames.names() == ["_df"]
    frames.clear()
    with pytest.raises(EngineError):
        frames.get("_df")


def test_types_of_files_widen(spark, tmp_path):
    for k, df in enumerate((spark.range(3).selectExpr("cast(id as int) AS x", "'a' AS s"), spark.range(3).selectExpr("id + 0.5D AS x"), spark.range(2).selectExpr("id AS x"))):
        df.coalesce(1).write.parquet(f"{tmp_path}/w-{k}.parquet")
    out = read(spark, f"{tmp_path}/w-*.parquet", filename="k")
    assert dict(out.dtypes) == {"x": "double", "s": "string", "k": "bigint"}
    assert sorted((r.k, r.x, r.s) for r in out.collect()) == [(0, 0, "a"), (0, 1, "a"), (0, 2, "a"), (1, 0.5, None), (1, 1.5, None), (1, 2.5, None), (2, 0, None), (2, 1, None)]
    assert sorted(r.x for r in read(spark, f"{tmp_path}/w-*.parquet", window=(3, 5)).collect()) == [0.5, 1.5, 2]
    assert read(spark, [f"{tmp_path}/w-0.parquet", f"{tmp_path}/w-1.parquet"], "x").dtypes == [("x", "double")]


def test_single_file(spark, ten, tmp_path):
    path = write(annotate(ten.repartition(4), "id", label="Number"), f"{tmp_path}/one", single=True, label="Ten")
    assert sorted(f.name for f in tmp_path.iterdir() if not f.name.startswith(".")) == ["_one.parquet_dtmeta.json", "one.parquet"] and (tmp_path / "one.parquet").is_file()
    back = read(spark, path)
    assert back.count() == 10 and back.schema["id"].metadata["label"] == "Number" and load_metadata(spark, path).dta_label == "Ten"
    assert read(spark, str(tmp_path)).count() == 10
    with pytest.raises(EngineError) as e:
        write(ten, f"{tmp_path}/one", single=True)
    assert e.value.code == 602
    write(ten.limit(3), f"{tmp_path}/one", single=True, replace=True)
    assert read(spark, path).count() == 3


def test_folders_without_files(spark, ten, tmp_path):
    (tmp_path / "a" / "b" / "c" / "d").mkdir(parents=True)
    (tmp_path / "a" / "note.txt").write_text("x")
    with pytest.raises(EngineError) as e:
        read(spark, f"{tmp_path}/a")
    assert e.value.code == 601
    write(ten, f"{tmp_path}/a/b/c/d/deep", single=True)
    with pytest.raises(EngineError):
        read(spark, f"{tmp_path}/a", recursive=True)
    write(ten, f"{tmp_path}/a/b/near", single=True)
    assert read(spark, f"{tmp_path}/a/b", recursive=True).count() == 20


def test_footer_metadata(spark, tmp_path):
    bundle = {"schema_version": 1, "min_reader_version": 1, "dta_label": "d", "vars": [{"name": "z", "stata_type": "byte", "format": "%8.0g", "var_label": "z label", "value_label": "zlbl"}],
              "value_labels": [{"name": "zlbl", "value": 1, "text": "one"}, {"name": "zlbl", "value": 2, "text": "two"}], "var_notes": [{"varname": "z", "text": "n"}]}
    kept = pa.table({"z": [1, 2, 1]})
    pq.write_table(kept.replace_schema_metadata({"some.key": json.dumps(bundle)}), f"{tmp_path}/f.parquet")
    assert has_metadata_key(spark, f"{tmp_path}/f", "some.key") and not has_metadata_key(spark, f"{tmp_path}/f", "other")
    found = read(spark, f"{tmp_path}/f.parquet", metadata_key="some.key").schema["z"].metadata
    assert (found["label"], found["value_labels"], found["notes"], found["storage_type"]) == ("z label", {"1": "one", "2": "two"}, ["n"], "byte")
    assert "label" not in read(spark, f"{tmp_path}/f.parquet").schema["z"].metadata


def test_leaf_metadata(spark, tmp_path):
    df = annotate(spark.range(1, 11).selectExpr("cast(id > 5 as int) AS g", "cast(id as int) AS z"), "z", label="z label", value_labels={1: "one"})
    path = write(df.coalesce(1), f"{tmp_path}/p", partition_by="g", label="Parts")
    leaf = next((tmp_path / "p" / "g=0").glob("*.parquet"))
    for place in (str(leaf), f"{path}/g=0", f"{path}/g=*"):
        assert load_metadata(spark, place).dta_label == "Parts" and load_metadata(spark, place).dta_vars == 2
        assert read(spark, place).schema["z"].metadata["label"] == "z label"


def test_dictionaries_are_categories(spark, tmp_path):
    pq.write_table(pa.table({"i": [1, 2, 3, 4], "cat": pa.array(["red", "blue", "red", "green"]).dictionary_encode(), "s": ["a", "b", "c", "d"]}), f"{tmp_path}/c.parquet")
    out = read(spark, f"{tmp_path}/c.parquet", catmode="encode")
    assert [(r.cat, r.s) for r in out.orderBy("i").collect()] == [(3, "a"), (1, "b"), (3, "c"), (2, "d")] and out.schema["cat"].metadata["value_labels"] == {"1": "blue", "2": "green", "3": "red"}
    assert [r.cat for r in read(spark, f"{tmp_path}/c.parquet").orderBy("i").collect()] == ["red", "blue", "red", "green"]


def test_returned(spark):
    df = annotate(spark.range(3).selectExpr("cast(id as int) AS x", "id AS y"), "x", value_label="xl", value_labels={1: "One"})
    assert asdict(returned(df, "src")) == {"N": 3, "k": 2, "varlist": "x y", "labels": "xl", "source": "src"}


def test_widest():
    from pyspark.sql import types as T

    assert widest(T.ByteType(), T.IntegerType()) == T.IntegerType()
    assert widest(T.LongType(), T.FloatType()) == T.DoubleType()
    assert widest(T.LongType(), T.StringType()) == T.StringType()
