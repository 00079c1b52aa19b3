import pytest
from pyspark.sql import functions as F

from stratamerge.functions import names


def values(spark, f, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_clean_label(spark):
    assert values(spark, names.clean_label, ["Raipur District", "North-East Delhi", "  Pune  ", "", None]) == ["raipur_district", "north_east_delhi", "pune", "", None]


def test_normalize_area_name(spark):
    given = ["MADHYA PRADESH(DISPUTED)", "DISPUTED (WEST BENGAL)", "DISPUTED (RAJASTHAN & GUJARAT)", "ANDAMAN-NICOBAR", None]
    assert values(spark, names.normalize_area_name, given) == ["Madhya Pradesh", "West Bengal", "Rajasthan & Gujarat", "Andaman-Nicobar", None]


def test_partition_slug(spark):
    assert values(spark, names.partition_slug, ["Tamil Nadu", "A/B C", None]) == ["Tamil_Nadu", "A_B_C", "unknown"]


def test_lenient_cast(spark):
    assert values(spark, names.lenient_cast, ["1.5", "-2", "1d", " 3", "x", "", None, "1e3", "."]) == [1.5, -2.0, None, None, None, None, None, 1000.0, None]


def test_layer_prefix():
    given = {"annual_balance": "ab_", "water-balance": "wb_", "aquifer": "aq_", "deltaG_well_depth": "dw_", "deltaG_fortnight": "df_", "cropping_intensity": "ci_"}
    assert {k: names.layer_prefix(k) for k in given} == given
    with pytest.raises(ValueError):
        names.layer_prefix("trailing_")


def test_replace_first_and_split_get(spark):
    assert values(spark, lambda c: names.replace_first(c, "to", "-"), ["1to2to3", "x"]) == ["1-2to3", "x"]
    assert values(spark, lambda c: names.split_get(c, "-", 1), ["a-b", "a"]) == ["b", None]
