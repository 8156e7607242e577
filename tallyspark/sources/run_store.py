"""Run records and baseline pointers as partitioned Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas
from tallyspark.operators.promotion import current_baselines
from tallyspark.operators.records import CHUNK_ROWS, example_chunks, run_record_nested
from tallyspark.sources.pointer_log import PointerLog

TABLES = {
    "runs": schemas.RUNS,
    "predictions": schemas.PREDICTIONS,
    "cells": schemas.CELLS,
    "class_metrics": schemas.CLASS_METRICS,
    "slice_metrics": schemas.SLICE_METRICS,
}
#: Run ids start with their day, so a day's runs share a folder.
_DAY = 8
_PARTITIONS = ("run_day", "run_id")
# The characters that Spark escapes in the names of partition folders.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def _folder(name: str, value: str) -> str:
    """Name of one partition's folder."""
    escaped = "".join(
        f"%{ord(char):02X}" if char in _ESCAPED or char < " " else char for char in value
    )
    return f"{name}={escaped}"


def _raise_unless_absent(error: AnalysisException) -> None:
    if error.getCondition() != "PATH_NOT_FOUND":
        raise error


class RunStore:
    """One folder per table, partitioned by day and run.

    Saving a run replaces only that run's partitions, so a repeated save (or a job that is run
    again after a failure) leaves one record per run.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.pointer_log = PointerLog(spark, f"{self.root}/baseline_pointer")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def save(self, table: str, rows: DataFrame) -> None:
        """Write rows of one or many runs."""
        names = TABLES[table].names
        data = rows.select(*names, F.substring("run_id", 1, _DAY).alias("run_day"))
        # Gathers a run's rows into few files and splits a run that is too big for one.
        data = data.hint("rebalance", "run_id")
        (
            data.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*_PARTITIONS)
            .parquet(self.path(table))
        )

    def read(self, table: str) -> DataFrame:
        """The whole table; empty when nothing was ever saved."""
        try:
            rows = self._reader(table).parquet(self.path(table))
        except AnalysisException as error:
            _raise_unless_absent(error)
            rows = self.spark.createDataFrame([], TABLES[table])
        return rows.select(*TABLES[table].names)

    def read_runs(self, table: str, *run_ids: str) -> DataFrame:
        """The rows of some runs. Other runs' folders are not even listed."""
        root = self.path(table)
        day_and_run = [
            "/".join(map(_folder, _PARTITIONS, (run_id[:_DAY], run_id))) for run_id in run_ids
        ]
        reader = self._reader(table).option("basePath", root)
        try:
            rows = reader.parquet(*[f"{root}/{folder}" for folder in day_and_run])
        except AnalysisException as error:
            _raise_unless_absent(error)
            # A run without rows has no folder: search by partition values instead.
            rows = self.read(table).where(F.col("run_id").isin(list(run_ids)))
        return rows.select(*TABLES[table].names)

    def _reader(self, table: str):
        # Naming the partition columns keeps them text, whatever their values look like.
        day = T.StructField("run_day", T.StringType())
        return self.spark.read.schema(T.StructType([*TABLES[table].fields, day]))

    def records(self, *run_ids: str) -> DataFrame:
        """Stored runs as one nested row each: identity, metrics and totals."""
        runs = self.read_runs("runs", *run_ids)
        spent = ("latency_ms", "prompt_tokens", "completion_tokens", "est_cost_usd")
        identity = runs.drop(*spent, "n_predictions")
        per_class = self.read_runs("class_metrics", *run_ids)
        per_slice = self.read_runs("slice_metrics", *run_ids)
        return run_record_nested(identity, per_class, per_slice, runs.select("run_id", *spent))

    def example_chunks(self, *run_ids: str, rows: int = CHUNK_ROWS) -> DataFrame:
        """The per-example part of stored records, in numbered chunks of about ``rows`` examples."""
        return example_chunks(self.read_runs("predictions", *run_ids), rows)

    def has_run(self, run_id: str) -> bool:
        return not self.read_runs("runs", run_id).isEmpty()

    def pointers(self) -> DataFrame:
        """All pointer moves so far with their version; empty when nothing was ever set."""
        return self.pointer_log.moves()

    def move_baselines(self, moves: DataFrame, seen: int | None = None) -> int:
        """Commit pointer moves; returns the version of the pointers that they make.

        With ``seen``, the version that the moves were decided on, it raises ``PointerConflict`` if
        one of their chains was moved since.
        """
        return self.pointer_log.commit(moves, seen)

    def baseline(self, chain: str) -> tuple[str, str] | None:
        """``(prompt_version, run_id)`` of a chain's current baseline, or None if unset."""
        now = self.pointer(chain)
        return None if now is None else (now["prompt_version"], now["run_id"])

    def pointer(self, chain: str) -> Row | None:
        """The chain's newest pointer with the time of its decision."""
        return current_baselines(self.pointers().where(F.col("chain") == chain)).first()

    def baseline_run(self, chain: str) -> DataFrame:
        """The run row of a chain's baseline; empty if no baseline was ever set."""
        now = self.pointer(chain)
        return self.read("runs").limit(0) if now is None else self.read_runs("runs", now["run_id"])
