import pytest
from pyspark.sql import functions as F

from stratamerge.operators import merge, spatial
from stratamerge.plans import queries


def test_a_zone_in_several_files_gives_one_row(spark):
    base = spark.createDataFrame([("z", "g", 1.0, 1.2), ("y", "g", 1.0, 1.2)], "mws_id string, geometry string, area_in_ha double, version double")
    rows = [("z", 1.2, "t1", "d", "s", 5), ("z", 1.2, "t2", "d", "s", 5), ("y", 1.1, "t", "d", "s", 9)]
    layers = {n: spark.createDataFrame(rows, "mws_id string, version double, tehsil string, district string, state string, v int") for n in ("one", "two", "three")}
    out = {r["mws_id"]: r for r in merge.join_layers(base, layers).collect()}
    assert len(out) == 2 and out["z"]["v"] == 5 and out["z"]["v_two"] == 5 and out["z"]["tehsil"] == "t1"
    assert out["y"]["v"] is None  # version 1.1 doesn't match 1.2
    assert [r["mws_id"] for r in merge.missing_ids(base, layers).collect()] == ["y"]


def test_base_needs_its_columns(spark):
    with pytest.raises(ValueError):
        merge.prepare_base(spark.createDataFrame([(1,)], "uid int"))
    with pytest.raises(ValueError):
        merge.location_meta({"a": spark.createDataFrame([(1,)], "mws_id int")})


def test_spatial_join_plan_and_overlaps(spark):
    areas = queries.areas(spark)
    points = spark.createDataFrame([(1, 35.0, 7.0), (2, 15.0, 4.0), (3, 5.0, 5.0), (4, None, 1.0), (5, 0.0, 5.0), (6, 2900.0, 800.0)], "id int, x double, y double")
    out = spatial.spatial_left_join(points, areas.drop("is_hole"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    found = sorted((r["id"], r["state"]) for r in out.collect() if r["state"])
    assert found == [(1, "DISPUTED (WEST END)"), (1, "NORTH (DISPUTED)"), (3, "NORTH (DISPUTED)"), (6, "wide")]
    assert out.count() == 7


def test_fill_admin_keeps_rows_and_located_names(spark, sf_dir):
    zones = queries.zones(spark, sf_dir)
    out = spatial.fill_admin(zones, queries.areas(spark))
    assert out.count() == zones.count() == out.select("mws_id", "version").distinct().count()
    kept = out.where(F.col("state").startswith("S")).count()
    assert kept == zones.where("state IS NOT NULL").count()


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "id int, x double, y double")
    assert spatial.spatial_left_join(none, queries.areas(spark).drop("is_hole")).count() == 0
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id int, x double, y double")
    assert spatial.spatial_left_join(points, queries.areas(spark).drop("is_hole").limit(0)).first()["state"] is None
