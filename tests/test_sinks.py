"""WKB by batches, feature files cut into ranges, and what readers of a GeoParquet table see while it is replaced."""

import json
import struct
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratamerge.functions import wkb
from stratamerge.functions.geometry import morton
from stratamerge.operators.spatial import bbox_contained
from stratamerge.plans.queries import QUERIES
from stratamerge.sources import geojson, geoparquet
from stratamerge.sources.features import read_features

RINGS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def plain_wkb(rings, holes, order="<"):
    parts = []
    for ring, hole in zip(rings, holes, strict=True):
        if hole and parts:
            parts[-1].append(ring)
        else:
            parts.append([ring])
    polygon = lambda some: struct.pack(order + "BII", order == "<", 3, len(some)) + b"".join(struct.pack(f"{order}I{2 * len(r)}d", len(r), *[v for p in r for v in p]) for r in some)
    return polygon(parts[0]) if len(parts) == 1 else struct.pack(order + "BII", order == "<", 6, len(parts)) + b"".join(map(polygon, parts))


def arrays(shapes):
    rings = pa.array([None if s is None else [[{"x": x, "y": y} for x, y in r] for r in s[0]] for s in shapes], RINGS)
    return rings, pa.array([None if s is None else s[1] for s in shapes], pa.list_(pa.bool_()))


ring = st.lists(st.tuples(st.floats(-10, 10), st.floats(-10, 10)), max_size=5)
shape = st.none() | st.lists(st.tuples(ring, st.booleans()), max_size=5).map(lambda rs: ([r for r, _ in rs], [h and i > 0 for i, (_, h) in enumerate(rs)]))


@settings(max_examples=200, deadline=None)
@given(st.lists(shape, max_size=6), st.integers(0, 2))
def test_wkb_against_plain(shapes, cut):
    rings, holes = (a[cut:] for a in arrays(shapes))
    shapes = shapes[cut:]
    got = wkb.encode(rings, holes)
    assert got.to_pylist() == [s and plain_wkb(*s) for s in shapes]
    assert all(a.to_pylist() == b.to_pylist() for a, b in zip(wkb.decode(got), (rings, holes), strict=True))
    big = pa.array([None if s is None else plain_wkb(*s, order=">" if i % 2 else "<") for i, s in enumerate(shapes)], pa.binary())
    assert all(a.to_pylist() == b.to_pylist() for a, b in zip(wkb.decode(big), (rings, holes), strict=True))


def test_wkb_errors():
    for bad in (struct.pack("<BI2d", 1, 1, 0, 0), plain_wkb([[(0.0, 0.0)] * 4], [False])[:-1], b"\x01"):
        with pytest.raises(ValueError):
            wkb.decode(pa.array([bad], pa.binary()))
    with pytest.raises(ValueError):
        wkb.encode(*arrays([([[(0.0, 0.0)]], [])]))


def test_wkb_is_faster_than_rows(capsys):
    shapes = [([[(float(i), float(j)) for j in range(50)]] * 2, [False, True]) for i in range(20_000)]
    rings, holes = arrays(shapes)
    began = time.process_time()
    wkb.decode(wkb.encode(rings, holes))
    batch = time.process_time() - began
    began = time.process_time()
    some = rings[:2000].to_pylist()
    coded = [plain_wkb([[(p["x"], p["y"]) for p in r] for r in s], [False, True]) for s in some]
    back = [[struct.unpack_from("<100d", c, at) for at in (13, 817)] for c in coded]
    pa.array([[[{"x": x, "y": y} for x, y in zip(r[::2], r[1::2], strict=True)] for r in s] for s in back], RINGS)
    by_row = 10 * (time.process_time() - began)
    with capsys.disabled():
        print(f"\nWKB both ways, 20,000 shapes: {batch:.2f} s by batch, {by_row:.2f} s by row")
    assert batch < by_row / 3


# --- feature files


def collection(n, rng):
    props = ['q"uo\\te', "br{ace[s]}", "\\\\", "ü" * 5, '\\"', "{\"type\": \"Feature\"}"]
    features = []
    for i in range(n):
        square = [[i, 0], [i + 1, 0], [i + 1, 1], [i, 0]]
        kind, coordinates = ("Polygon", [square] * (i % 3 + 1)) if i % 4 else ("MultiPolygon", [[square], [square]])
        features.append({"type": "Feature", "properties": {"k": i, "s": props[i % len(props)], "o": {"type": "Feature", "a": [{}, {"b": 1}]}}, "geometry": {"type": kind, "coordinates": coordinates}})
        if i % 5 == 0:
            features[-1] = {k: features[-1][k] for k in ("properties", "geometry", "type")}
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}}, "bbox": [0, 1, 2, 3], "features": features, "extra": [[1], {"no": "feature"}]}


@pytest.mark.parametrize("size", [1, 7, 100, 1 << 20])
def test_ranges_give_every_feature_once(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(geojson, "MOST_TASKS", 4)
    for i, (n, indent) in enumerate([(40 if size > 7 else 6, None), (13 if size > 7 else 3, 2), (0, None)]):
        (tmp_path / f"l_{i}.geojson").write_text(json.dumps(collection(n, None), indent=indent, ensure_ascii=i > 0))
    (tmp_path / "l_9.geojson").write_text("")
    path = f"file://{tmp_path}/l_*.geojson"
    got = [(r["path"][-11:], r["feature"]) for r in geojson.feature_texts(spark, path, size).collect() if json.loads(r["feature"]).get("type") == "Feature"]
    want = [(f"l_{i}.geojson", f) for i in range(3) for f in json.loads((tmp_path / f"l_{i}.geojson").read_text())["features"]]
    assert sorted((p, json.dumps(json.loads(f), sort_keys=True)) for p, f in got) == sorted((p, json.dumps(f, sort_keys=True)) for p, f in want)


def test_a_large_file_equals_multiline(spark, tmp_path, monkeypatch):
    (tmp_path / "big.geojson").write_text(json.dumps(collection(3000, None)))
    path = f"file://{tmp_path}/big.geojson"
    old = spark.read.schema("features array<struct<properties:struct<k:long,s:string>,geometry:struct<type:string,coordinates:string>>>").json(path, multiLine=True).select(F.explode("features").alias("f"))
    monkeypatch.setattr(geojson.feature_texts, "__defaults__", (20_000,))
    new = read_features(spark, path)
    assert geojson.feature_texts(spark, path).select(F.spark_partition_id()).distinct().count() > 1
    assert sorted(map(tuple, new.select("k", "s", F.size("rings")).collect())) == sorted((r["k"], r["s"], len(c) if r["t"] == "Polygon" else sum(map(len, c))) for r in old.select("f.properties.*", F.col("f.geometry.type").alias("t"), F.col("f.geometry.coordinates").alias("c")).collect() for c in [json.loads(r["c"])])


# --- the table


def squares(spark, n, tag="a"):
    x, y = (F.col("id") * 7919 % 100).cast("double"), (F.col("id") * 104729 % 97).cast("double")
    corner = lambda a, b: F.struct((x + a).alias("x"), (y + b).alias("y"))
    rings = F.array(F.array(*[corner(a, b) for a, b in ((0, 0), (1, 0), (1, 1), (0, 0))]))
    return spark.range(n).select("id", F.when(F.col("id") % 3 > 0, "s/t").alias("state"), F.lit(tag).alias("tag"), rings.alias("rings"), F.array(F.lit(False)).alias("is_hole"))


@pytest.mark.parametrize("step", ["move", "delete_file"])
def test_a_crash_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step):
    path = f"file://{tmp_path}/t"
    geoparquet.write_geoparquet(squares(spark, 30, "old"), path)

    class Dying:
        def __init__(self, store):
            self.store = store

        def __getattr__(self, name):
            if name == step:
                raise OSError("dead")
            return getattr(self.store, name)

    real = geoparquet.located
    store, root = real(path)
    writer = geoparquet.GeoParquetWriter(path, "state", geoparquet.geo_footer(None), True)
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "state": ["x", "y"], "tag": ["new", "new"], "_file": ["0", "0"]})
    message = writer.write(iter([batch]))
    tags = lambda: {r["tag"] for r in geoparquet.scan_partitioned(spark, path).select("tag").collect()}
    assert tags() == {"old"}  # files that are written count for nothing yet
    monkeypatch.setattr(geoparquet, "located", lambda p: (Dying(store), root))
    with pytest.raises(OSError):
        writer.commit([message])
    monkeypatch.setattr(geoparquet, "located", real)
    assert tags() == ({"old"} if step == "move" else {"new"}) and geoparquet.files(spark, path).count() == 2
    geoparquet.write_geoparquet(squares(spark, 30, "last"), path)
    assert tags() == {"last"} and len(writer.present()) == 2  # what was left over is gone


def test_rows_lie_along_a_curve(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = squares(spark, 3000)
    geoparquet.write_geoparquet(df, path, rows_a_file=500, row_group=50)
    table = geoparquet.scan_partitioned(spark, path)
    assert sorted(r["id"] for r in table.select("id").collect()) == list(range(3000))
    assert 5 <= geoparquet.files(spark, path).count() <= 12
    for region, share in (((0, 0, 20, 20), 0.3), ((40, 40, 60, 50), 0.3), ((200, 0, 300, 10), 0)):
        met = geoparquet.row_groups_met(spark, path, region).first()
        assert met["row_groups"] >= 60 and met["met"] <= share * met["row_groups"]
        x, y = (F.col("id") * 7919 % 100), (F.col("id") * 104729 % 97)
        want = df.where((x >= region[0]) & (y >= region[1]) & (x + 1 <= region[2]) & (y + 1 <= region[3])).count()
        found = table.where(bbox_contained("bbox", *map(float, region)))
        assert found.count() == want and "PushedFilters: [IsNotNull(bbox.xmin)" in found._jdf.queryExecution().executedPlan().toString()


def test_input_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = squares(spark, 40)
    geoparquet.write_geoparquet(df.mapInArrow(count, df.schema), f"file://{tmp_path}/t")
    assert seen.value == 40


def test_morton(spark):
    at = lambda x, y: spark.range(1).select(morton(F.lit(x), F.lit(y))).first()[0]
    assert (at(0.0, 0.0), at(1 / 65536, 0.0), at(0.0, 1 / 65536), at(1.0, 1.0), at(None, 0.5)) == (0, 1, 2, (1 << 32) - 1, None)


def test_row_groups_are_full_but_the_last(tmp_path):
    writer = geoparquet.GeoParquetWriter(f"file://{tmp_path}/t", "state", geoparquet.geo_footer(None), True, 10)
    batches = [pa.RecordBatch.from_pydict({"id": list(range(i, i + 7)), "state": ["x"] * 7, "_file": ["0"] * 7}) for i in range(0, 35, 7)]
    writer.commit([writer.write(iter(batches))])
    file = pq.ParquetFile(writer.present()[0])
    assert [file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)] == [10, 10, 10, 5]
    assert file.read().column("id").to_pylist() == list(range(35))


def test_a_large_state_is_one_row_group_as_its_sql_says(spark, tmp_path):
    part = spark.range(110_000).selectExpr("id * 11 AS p_partkey", "'n' AS p_name", "'B' AS p_brand", "'t' AS p_type", "1 AS p_size", "1D AS p_retailprice")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    out = QUERIES["dataset_file_stats"](spark, str(tmp_path)).first()
    assert (out["files"], out["rows"], out["row_groups"]) == (1, 110_000, 1)


def test_the_curve_names_each_coordinate_once():
    assert str(morton(F.lit(0.25), F.lit(0.5))).lower().count("floor") == 2


def test_the_first_table_is_cut_for_all_cores(spark, tmp_path, monkeypatch):
    groups, real = [], geoparquet.materialize_zstd
    monkeypatch.setattr(geoparquet, "READ_ROWS", 100, raising=False)

    def counted(df, *a, **k):
        out = real(df, *a, **k)
        groups.extend(pq.ParquetFile(p.removeprefix("file:").replace("///", "/")).num_row_groups for p in out.inputFiles())
        return out

    monkeypatch.setattr(geoparquet, "materialize_zstd", counted)
    geoparquet.write_geoparquet(squares(spark, 3000).coalesce(1), f"file://{tmp_path}/t")
    assert sum(groups) >= 30
