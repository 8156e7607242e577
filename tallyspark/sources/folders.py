"""Shared folders, cut lineage, and files that are created once."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session may do without the setting."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyspark-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(rows: DataFrame) -> DataFrame:
    """The rows from files in the shared folder: computed now, once, and safe from lost executors.

    For steps of iterative jobs. Spark removes the files with the frame if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = rows.sparkSession.sparkContext
    folder = shared_folder(rows.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return rows.checkpoint()


def put_if_absent(spark: SparkSession, path: str, content: dict) -> bool:
    """Create a small JSON file; False if it is there already, whoever was first.

    The content is written under a name that readers ignore and then linked or renamed, so a file is
    never seen half written. Two writers cannot both succeed: a link fails on an existing name, and so
    does a rename where the file system does not replace files (HDFS).
    """
    text = json.dumps(content)
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        final = unquote(parts.path) if parts.scheme else path
        folder, name = os.path.split(final)
        os.makedirs(folder, exist_ok=True)
        draft = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(draft, final)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    final = hadoop(path)
    system = final.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = hadoop(final.getParent(), f".{final.getName()}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    created = not system.exists(final) and system.rename(draft, final)
    if not created:
        system.delete(draft, False)
    return created
