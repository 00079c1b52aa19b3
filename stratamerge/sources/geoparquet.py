"""Partitioned GeoParquet with its footer metadata, and reports read from footers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.geometry import morton, st_bounds
from ..functions.names import partition_slug
from ..functions.wkb import rings_to_wkb
from .scratch import materialize_zstd

GEO_VERSION = "1.1.0"
ROW_GROUP = 100_000
MANIFEST = "_manifest"  # readers of Spark pass over names that begin like this
PIECE = "_file"  # column that tells which rows of a partition share a file; it isn't written
MOST_TASKS = 100_000
READ_ROWS = 10_000  # of a row group of the table that is written first
CURVE_CUTS = 256  # a large state is cut at some of so many places of the curve


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file that Spark listed (its paths aren't escaped)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe="/:@=") if "://" in path else path)


def geo_footer(bbox: tuple[float, float, float, float] | None) -> str:
    """Text of the footer's geo entry: WKB column, EPSG:4326, global bounds and the covering by the bbox column."""
    column = {
        "encoding": "WKB", "geometry_types": ["Polygon", "MultiPolygon"],
        "crs": {"id": {"authority": "EPSG", "code": 4326}},
        "covering": {"bbox": {side: ["bbox", side] for side in ("xmin", "ymin", "xmax", "ymax")}},
    }
    if bbox is not None:
        column["bbox"] = list(bbox)
    return json.dumps({"version": GEO_VERSION, "primary_column": "geometry", "columns": {"geometry": column}})


class Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files  # below the dataset's path


class GeoParquetWriter(DataSourceArrowWriter):
    """Each task writes one file per partition directory and piece, row group by row group. What counts is the manifest.

    The manifest lists the files of the table. Commit writes a new one beside it and moves it
    to its name last, so readers that follow it (`scan_partitioned`, `files`) see the old table
    or the new one, whenever the driver dies. Files that it doesn't list are deleted then; those
    that a dead driver leaves go with the next commit.
    """

    def __init__(self, path: str, partition: str, footer: str, overwrite: bool, row_group: int = ROW_GROUP):
        self.path, self.partition, self.footer, self.overwrite, self.row_group = path, partition, footer, overwrite, row_group
        self.run = uuid.uuid4().hex  # in the names of this write's files

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = located(self.path)
        files: list[str] = []
        writer, current, held, rows = None, None, [], 0

        def flush(last: bool = True) -> None:
            """Write what is held as whole row groups; the rest stays, unless it is the file's last."""
            nonlocal held, rows
            if held:
                whole = pa.Table.from_batches(held)
                n = rows if last else rows - rows % self.row_group
                writer.write_table(whole.slice(0, n), row_group_size=self.row_group)
                held, rows = whole.slice(n).to_batches(), rows - n

        for batch in iterator:
            at = batch.schema.get_field_index(self.partition)
            values = list(zip(batch.column(at).to_pylist(), batch.column(PIECE).to_pylist(), strict=True))
            body = batch.select([n for i, n in enumerate(batch.schema.names) if i != at and n != PIECE])
            cuts = [0, *[i for i in range(1, len(values)) if values[i] != values[i - 1]], len(values)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if values[a] != current:
                    flush()
                    if writer:
                        writer.close()
                    current = values[a]
                    folder = f"{self.partition}={current[0]}"
                    store.create_dir(f"{root}/{folder}", recursive=True)
                    files.append(f"{folder}/part-{self.run}-{uuid.uuid4().hex}.parquet")
                    schema = body.schema.with_metadata({"geo": self.footer})
                    writer = pq.ParquetWriter(store.open_output_stream(f"{root}/{files[-1]}"), schema, compression="zstd")
                held.append(body.slice(a, b - a))
                rows += b - a
                if rows >= self.row_group:
                    flush(last=False)
        flush()
        if writer:
            writer.close()
        return Written(files)

    def present(self) -> list[str]:
        """Data files below the path, listed or not."""
        store, root = located(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        return [x.path for x in found if x.is_file and x.path.endswith(".parquet")]

    def commit(self, messages: list[Written | None]) -> None:
        store, root = located(self.path)
        new = [f for m in messages if m for f in m.files]
        kept = [] if self.overwrite else manifest(self.path) or []
        store.create_dir(root, recursive=True)
        staged = f"{root}/_{self.run}.tmp"
        with store.open_output_stream(staged) as f:
            f.write("".join(f"{x}\n" for x in [*kept, *new]).encode())
        store.move(staged, f"{root}/{MANIFEST}")
        self.drop({*kept, *new})

    def drop(self, listed: set[str]) -> None:
        """Delete the data files that aren't listed."""
        store, root = located(self.path)
        for path in self.present():
            if path.removeprefix(f"{root}/") not in listed:
                store.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = located(self.path)
        for path in self.present():
            if self.run in path:
                store.delete_file(path)


def manifest(path: str) -> list[str] | None:
    """The table's files, below its path; None where there is no manifest."""
    store, root = located(path)
    if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(f"{root}/{MANIFEST}") as f:
        return f.read().decode().splitlines()


class GeoParquet(DataSource):
    """Sink `geoparquet`: save(path) with options partition, footer and row_group."""

    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(self.options["path"], self.options["partition"], self.options["footer"], overwrite, int(self.options.get("row_group", ROW_GROUP)))


def write_geoparquet(df: DataFrame, path: str, state: str = "state", rows_a_file: int = 1_000_000, row_group: int = ROW_GROUP) -> None:
    """Partition by the state's slug (null: unknown), with a bbox column, WKB geometry and the geo footer.

    The state's own spelling stays in column <state>_name. df is evaluated once, into a written
    table that also tells its bounds. Rows of a state lie along a Z-order curve through the
    centres of their boxes, so that row groups and files cover little ground each. A state of
    more than about rows_a_file rows is cut along the curve into several files, each a task
    of its own; places on the curve with very many rows are cut by a hash. Files of an
    earlier run are replaced.
    """
    spark = df.sparkSession
    side = lambda f, name: f(F.col(f"bbox.{name}")).alias(name)
    seen = Observation()
    rows = df.withColumn("bbox", st_bounds(F.col("rings"))).withColumn(f"{state}_name", F.col(state)).withColumn(state, partition_slug(F.col(state)))
    # row groups of a few thousand rows, so that all cores read them whatever the input's number of files
    rows = materialize_zstd(rows.observe(seen, side(F.min, "xmin"), side(F.min, "ymin"), side(F.max, "xmax"), side(F.max, "ymax")), row_group_rows=READ_ROWS)
    bounds = seen.get
    bbox = None if bounds["xmin"] is None else tuple(bounds[c] for c in ("xmin", "ymin", "xmax", "ymax"))
    x0, y0, x1, y1 = bbox or (0.0, 0.0, 1.0, 1.0)
    middle = lambda a, low, high: ((F.col(f"bbox.{a}min") + F.col(f"bbox.{a}max")) / 2 - low) / ((high - low) or 1.0)
    curve = F.coalesce(morton(middle("x", x0, x1), middle("y", y0, y1)), F.lit(0).cast("long"))
    rows = rows.withColumn("_curve", curve)
    large = rows.groupBy(F.col(state).alias("_s")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_a_file).collect()  # a row a large state
    if large:
        n_of = spark.createDataFrame([(r["_s"], r["n"]) for r in large], "_s string, n long")
        at = rows.select(F.col(state).alias("_s"), F.col("_curve").alias("_c")).join(n_of, "_s")
        cuts = at.groupBy("_s").agg(F.first("n").alias("n"), F.percentile_approx("_c", F.array(*[F.lit(i / CURVE_CUTS) for i in range(1, CURVE_CUTS)]), 10_000).alias("_cuts"))
        # every so many of the cuts, so that the pieces hold about rows_a_file rows; a row a large state
        step = F.greatest(F.lit(1), F.floor(F.lit(CURVE_CUTS) * rows_a_file / F.col("n")))
        cuts = cuts.select("_s", F.filter("_cuts", lambda _, i: (i + 1) % step == 0).alias("_cuts"))
        rows = rows.join(cuts, F.col(state) == F.col("_s"), "left").withColumn("_piece", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_curve"))), F.lit(0))).drop("_s", "_cuts")
    else:
        rows = rows.withColumn("_piece", F.lit(0))
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    pieces = rows.groupBy(F.col(state).alias("_s"), F.col("_piece").alias("_p")).agg(F.ceil(F.count(F.lit(1)) / (2 * rows_a_file)).alias("_files"))
    n = pieces.agg(F.sum("_files")).first()[0] or 1  # stated, so that pieces aren't put together into few tasks
    salt = F.when(F.col("_files") > 1, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), "_files")).otherwise(0)
    rows = rows.join(pieces, (F.col(state) == F.col("_s")) & (F.col("_piece") == F.col("_p"))).withColumn(PIECE, F.concat_ws("-", "_piece", salt)).drop("_s", "_p", "_files", "_piece")
    spark.dataSource.register(GeoParquet)
    dealt = rings_to_wkb(rows).repartition(min(n, MOST_TASKS), state, PIECE).sortWithinPartitions(state, PIECE, "_curve").drop("_curve")
    dealt.write.format("geoparquet").option("partition", state).option("footer", geo_footer(bbox)).option("row_group", row_group).mode("overwrite").save(path)


def scan_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """The dataset with its partition column: the files of its manifest, or all of the folder where it has none."""
    listed = manifest(path)
    return spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in listed]) if listed else spark.read.parquet(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the dataset's Parquet files, without reading their content."""
    listed, reader = manifest(path), spark.read.format("binaryFile")
    if listed:
        return reader.load([f"{path}/{f}" for f in listed]).select("path", "length")
    found = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    return found if listed is None else found.limit(0)


def empty_file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, empty) of every file."""
    return files(spark, path).withColumn("empty", F.col("length") == 0)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, rows, row_groups, geo) from the footer of every non-empty file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, local = located(p)
                with store.open_input_file(local) as f:
                    m = pq.read_metadata(f)
                out.append({"path": p, "length": n, "rows": m.num_rows, "row_groups": m.num_row_groups, "geo": ((m.metadata or {}).get(b"geo") or b"").decode() or None})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("path", pa.string()), ("length", pa.int64()), ("rows", pa.int64()), ("row_groups", pa.int64()), ("geo", pa.string())]))

    return files(spark, path).where("length > 0").mapInArrow(read, "path string, length long, rows long, row_groups long, geo string")


def dataset_file_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row: files, bytes, MB a file, rows, row groups, rows a group, bytes a row."""
    return footers(spark, path).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), (F.avg("length") / 1e6).alias("mb_per_file"), F.sum("rows").alias("rows"),
        F.sum("row_groups").alias("row_groups"), (F.sum("rows") / F.nullif(F.sum("row_groups"), F.lit(0))).alias("rows_per_group"), (F.sum("length") / F.nullif(F.sum("rows"), F.lit(0))).alias("bytes_per_row"),
    )


def geo_footer_report(spark: SparkSession, path: str) -> DataFrame:
    """Per file: spec version, primary column, CRS, bounds, and whether a covering is declared."""
    at = lambda p: F.get_json_object("geo", p)
    return footers(spark, path).select(
        "path", at("$.version").alias("version"), at("$.primary_column").alias("primary_column"), at("$.columns.geometry.crs.id.authority").alias("authority"),
        at("$.columns.geometry.crs.id.code").cast("int").alias("code"), at("$.columns.geometry.bbox").alias("bbox"), at("$.columns.geometry.covering.bbox").isNotNull().alias("covering"),
    )


def row_groups_met(spark: SparkSession, path: str, region: tuple[float, float, float, float]) -> DataFrame:
    """One row: the dataset's row groups, and those whose bounds of bbox let a shape inside the region (xmin, ymin, xmax, ymax) be there, so that a scan reads them."""
    sides = ("xmin", "ymin", "xmax", "ymax")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = met = 0
            for p in batch.column(0).to_pylist():
                store, local = located(p)
                with store.open_input_file(local) as f:
                    m = pq.read_metadata(f)
                for g in range(m.num_row_groups):
                    columns = {m.row_group(g).column(i).path_in_schema: m.row_group(g).column(i).statistics for i in range(m.num_columns)}
                    stats = [columns.get(f"bbox.{s}") for s in sides]
                    total += 1
                    known = all(s is not None and s.has_min_max for s in stats)
                    met += not known or bool(stats[0].max >= region[0] and stats[1].max >= region[1] and stats[2].min <= region[2] and stats[3].min <= region[3])
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([met])], names=["row_groups", "met"])

    return files(spark, path).where("length > 0").select("path").mapInArrow(read, "row_groups long, met long").agg(F.sum("row_groups").alias("row_groups"), F.sum("met").alias("met"))
