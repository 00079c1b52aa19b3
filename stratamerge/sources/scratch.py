"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of ours in local mode (tests), an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="stratamerge-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        base = "file://" + _own[0]
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/stratamerge-{uuid.uuid4().hex}/{name}"


def materialize_zstd(df: DataFrame, path: str | None = None, row_group_rows: int | None = None) -> DataFrame:
    """Write as ZSTD Parquet and scan that instead: cuts a wide plan and its lineage."""
    path = path or scratch(df.sparkSession, "table")
    writer = df.write.option("compression", "zstd")
    if row_group_rows:
        writer = writer.option("parquet.block.row.count.limit", row_group_rows)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialize_zstd that nothing reads any more: all that came from them is written itself.

    Shuffle files of the jobs that wrote them go too, as Spark drops them once their plans are garbage.
    """
    for table in tables:
        session, path = table.sparkSession, table.written_to
        target = session._jvm.org.apache.hadoop.fs.Path(path).getParent()
        target.getFileSystem(session._jsc.hadoopConfiguration()).delete(target, True)
    if tables:
        sweep(tables[0].sparkSession)


def sweep(spark: SparkSession, wait: float = 0) -> None:
    """Lets Spark drop the shuffle files of finished jobs. Those of a job that has just ended may need a moment until nothing names its plan: wait, in seconds."""
    gc.collect()
    time.sleep(wait)
    spark._jvm.System.gc()
