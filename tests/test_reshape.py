import pytest
from pyspark.sql import functions as F

from stratamerge.functions.names import lower_names
from stratamerge.operators import reshape


def test_split_range_cols(spark):
    golden = [
        ("30 - 200", True, 30, 200), ("2160 to4752", True, 2160, 4752), ("30 -200", True, 30, 200), ("upto 8%", True, 8, 8), ("Upto 5 - 10%", True, 5, 10), ("1.5-2.5", True, 1.5, 2.5),
        ("2017-2018", True, 2017, 2018), ("45", False, 45, 45), ("upto 30", False, 30, 30), ("5% - 10%", False, None, None), ("30 TO 40", False, None, None), ("10 20", False, None, None),
        ("-5", False, None, None), ("12_34", False, None, None), ("-", False, None, None), ("abc", False, None, None), ("", False, None, None), (None, False, None, None),
    ]
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(golden)], "i int, a string")
    assert [r[0] for r in df.orderBy("i").select(reshape.has_range_marker(F.col("a"))).collect()] == [x[1] for x in golden]
    got = reshape.split_range_cols(df).orderBy("i").select("a_min", "a_max").collect()
    assert [tuple(r) for r in got] == [x[2:] for x in golden]


def test_common_columns_are_not_taken_apart(spark):
    df = spark.createDataFrame([("12-34", "x")], "mws_id string, b string")
    assert reshape.detect_range_cols(df) == []


def test_unnest_json_names(spark):
    df = spark.createDataFrame([(1, '{"DeltaG": 10, "ok": true, "s": "t"}', None), (2, "broken", '{"DeltaG": 1.5}')], "id int, dw_2019_2020 string, `2019_2020` string")
    out = reshape.unnest_json_cols(df)
    assert set(out.columns) == {"id", *[f"{p}{k}_{s}" for p, s in (("dw_", "2019_2020"), ("2019_", "2020")) for k in ("deltag", "ok", "s")]}
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["dw_deltag_2019_2020"] == 10 and rows[1]["dw_ok_2019_2020"] == 1 and rows[2]["dw_deltag_2019_2020"] is None and rows[2]["2019_deltag_2020"] == 1.5


def test_union_relaxed_widens(spark):
    a, b = spark.createDataFrame([(1, 2)], "k int, n int"), spark.createDataFrame([("x", 1.5, True)], "k string, n double, extra boolean")
    out = reshape.union_relaxed(a, b)
    assert dict(out.dtypes) == {"k": "string", "n": "double", "extra": "boolean"} and out.count() == 2


def test_explode_locations_keeps_childless_parents(spark):
    schema = "label string, state_id string, district array<struct<label:string,district_id:string,blocks:array<struct<label:string,tehsil_id:string>>>>"
    df = spark.createDataFrame([("A", "1", [("d", "2", [("t", "3")]), ("e", "4", [])]), ("B", "5", None)], schema)
    assert sorted(map(tuple, reshape.explode_locations(df).collect()), key=str) == [("A", "1", "d", "2", "t", "3"), ("A", "1", "e", "4", None, None), ("B", "5", None, None, None, None)]


def test_clashing_lower_names(spark):
    with pytest.raises(ValueError):
        lower_names(spark.createDataFrame([(1, 2)], "a int, A int"))


def test_rename_and_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "uid int, Yeild__ int, gone int")
    out = reshape.prefix_cols(reshape.rename_and_drop(df, {"uid": "mws_id", "Yeild__": "Yield"}, ["gone", "absent"]), "aquifer")
    assert out.columns == ["aq_yield", "mws_id"]
