"""A whole request, from feature files to partitioned GeoParquet."""

import json

import pytest

from stratamerge.functions.wkb import rings_to_wkb
from stratamerge.plans.config import Request
from stratamerge.plans.pipeline import integrate
from stratamerge.sources import features, geoparquet


def square(x, y):
    return [[[float(a), float(b)] for a, b in ((x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y))]]


def collection(rows):
    return json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": p, "geometry": {"type": "Polygon", "coordinates": c}} for p, c in rows]})


@pytest.mark.parametrize("base", ["features", "wkb"])
def test_integrate(spark, tmp_path, base):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/terrain_d_one_t_one.geojson").write_text(collection([({"uid": "a", "Slope": "5 - 10%", "2019_2020": '{"DeltaG": 2}'}, square(0, 0)), ({"uid": "b", "Slope": "7", "2019_2020": None}, square(2, 0))]))
    (tmp_path / "in/terrain_d_one_t_two.geojson").write_text(collection([]))
    (tmp_path / "base.geojson").write_text(collection([({"uid": u, "area_in_ha": 1.5}, square(x, 0)) for u, x in (("a", 0), ("b", 2), ("c", 10))]))
    (tmp_path / "areas.geojson").write_text(collection([({"STATE": "FAR (DISPUTED)", "District": "x-y", "TEHSIL": "z"}, [[[9.0, -1.0], [12.0, -1.0], [12.0, 2.0], [9.0, 2.0], [9.0, -1.0]]])]))
    (tmp_path / "locations.json").write_text(json.dumps([{"label": "S One", "state_id": "1", "district": [{"label": "D One", "district_id": "2", "blocks": [{"label": "T One", "tehsil_id": "3"}, {"label": "T Two", "tehsil_id": "4"}]}]}]))
    (tmp_path / "versions.csv").write_text("State,District,Tehsil,Algorithm Version\nS One,D One,T One,1.2\n")
    request = Request.from_json(json.dumps({
        "unit": "mws", "layers": ["terrain"], "output_path": f"file://{tmp_path}/out", "base_layer": {"mws": f"file://{tmp_path}/base.parquet"},
        "column_map": {"terrain": {"rename_columns": {"uid": "mws_id", "Slope": "slope"}, "drop_columns": []}}, "layer_version": f"file://{tmp_path}/versions.csv",
    }))
    if base == "wkb":
        rows = features.read_features(spark, f"file://{tmp_path}/base.geojson", None)
        rings_to_wkb(rows).write.parquet(f"file://{tmp_path}/base.parquet")
    done = integrate(spark, request, f"file://{tmp_path}/in", f"file://{tmp_path}/locations.json", f"file://{tmp_path}/areas.geojson")
    assert (done.uncovered, done.uncovered_ids, done.matched, done.unmatched, done.removed, done.shared_slugs.collect()) == (1, ["c"], 1, 0, 0, [])
    out = {r["mws_id"]: r for r in geoparquet.scan_partitioned(spark, f"file://{tmp_path}/out").collect()}
    assert {k: r["state"] for k, r in out.items()} == {"a": "S_One", "b": "S_One", "c": "Far"}
    assert (out["a"]["te_slope_min"], out["a"]["te_slope_max"], out["b"]["te_slope_max"]) == (5, 10, 7)
    assert out["a"]["te_2019_deltag_2020"] == 2 and out["c"]["district"] == "X-Y"
    report = geoparquet.geo_footer_report(spark, f"file://{tmp_path}/out").collect()
    assert {(r["version"], r["code"], r["covering"]) for r in report} == {("1.1.0", 4326, True)} and len(report) == 2


def test_write_twice_and_large_states(spark, tmp_path):
    rows = [(i, "s" if i else None, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]], [False]) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, state string, rings array<array<struct<x:double,y:double>>>, is_hole array<boolean>")
    path = f"file://{tmp_path}/out"
    for files in (2, 4):  # the second run replaces the first
        geoparquet.write_geoparquet(df, path, rows_a_file=49 // (files - 1) + 1)
        assert geoparquet.scan_partitioned(spark, path).count() == 50
        assert geoparquet.files(spark, path).count() <= files


def test_missing_layer(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        features.read_layer_features(spark, f"file://{tmp_path}", "nothing")
