"""Where intermediate tables of these operators go, how they are written and read again, and when their files go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallyspark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside delete their shuffle files when they end.

    Otherwise the files stay until the driver happens to collect its garbage, which follows the number of
    plans and tasks, not the bytes shuffled. Spark before 4.1 ignores the setting.
    """
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read from there: its lineage ends at files."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    with shuffles_released(spark):
        frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out._stored_at = path
    return out


def drop(*frames: DataFrame) -> None:
    """Deletes stored frames; nothing that is still to run may read them."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
