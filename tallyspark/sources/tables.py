"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Read the given columns of ``folder/name.parquet``.

    How finely files are split is the session's affair (``spark.sql.files.minPartitionNum`` and
    ``maxPartitionBytes``); nothing is shuffled to read a table.
    """
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)
