"""Every query with SQL beside it agrees with DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from stratamerge.plans import queries as plans
from stratamerge.plans.queries import oracle_sql, queries
from stratamerge.sources import features

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def cells(df):
    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return "null"
        number = isinstance(v, (int, float)) or getattr(getattr(v, "dtype", None), "kind", "x") in "if"
        return f"{float(v):.6g}" if number else str(v)

    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries()))
def test_against_sql(spark, sf_dir, duck, name):
    got = queries()[name](spark, sf_dir).toPandas()
    if name in oracle_sql():
        want = duck.execute(oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert cells(got) == cells(want)
    assert len(got) >= 0


def test_large_areas_are_dealt_over_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(features, "FILE_ROWS", 20, raising=False)
    ring = "array(array(struct(0D AS x, 0D AS y), struct(1D AS x, 0D AS y), struct(1D AS x, 1D AS y), struct(0D AS x, 0D AS y)))"
    rows = spark.range(200).selectExpr("'a_b' AS slug", "id % 100 AS k", f"{ring} AS rings", "array(false) AS is_hole")
    n = features.write_features(rows, str(tmp_path), "soil")
    files = list(tmp_path.glob("soil_a_b*.geojson"))
    assert n == len(files) > 5 and all(f.read_text().count('"Feature"') < 60 for f in files)
    got = features.read_layer_features(spark, str(tmp_path), "soil").select("slug", "k").collect()
    assert sorted((r["slug"], r["k"]) for r in got) == sorted(("a_b", i % 100) for i in range(200))


def test_locations_are_documents_of_bounded_size(spark, sf_dir):
    rows = plans.bounded_locations(spark, sf_dir, most=2).selectExpr("size(district) AS d", "size(district[0].blocks) AS b").collect()
    assert len(rows) >= 5 and all((r["d"] or 0) <= 1 for r in rows) and max(r["b"] or 0 for r in rows) <= 8


def test_replace_first_keeps_all_of_its_columns(spark, sf_dir):
    rows = queries()["replace_first"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/part.parquet"), "p_partkey").collect()
    assert rows and all(r["first"] == r["p_type"].replace("E", "*", 1) and r["every"] == r["p_type"].replace("E", "*") for r in rows)
