"""Session helpers: configuration for local runs and the shared folder used for written state."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app_name: str = "tradeloom", cores: int | str = 8) -> SparkSession:
    """Session for tests and the benchmark.  On a cluster the caller brings its own session."""
    cpus = str(cores)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TRADELOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder, because there the driver and
    the executors are the same process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    folder = tempfile.mkdtemp(prefix="tradeloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a statement go when it ends, not when the driver collects garbage.

    For writes: nothing reads their shuffles again, and a job of many writes holds one shuffle at a time.
    """
    before = spark.conf.get(_TIDY, "false")
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(_TIDY, before)


#: How whole tables are packed: delta-encoded keys and numbers, and a level that costs no more time here.
PACKED: dict[str, str] = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "9",
    "parquet.writer.version": "PARQUET_2_0",
}


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For reduced results that a job reads several times.  The plan before it runs once instead of
    once per use, it survives lost executors, and the reader knows the size, so small results are
    broadcast and large ones are not.
    """
    path = fresh_path(df.sparkSession, label)
    with tidy(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
