"""Baseline pointers as a log of numbered commits that concurrent writers cannot overwrite."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas
from tallyspark.sources.folders import put_if_absent

_COMMIT = "version long, commit string"


class PointerConflict(RuntimeError):
    """Another writer has moved one of the same chains since it was read."""


def _read(frame, empty: DataFrame) -> DataFrame:
    """The frame, or an empty one if nothing was ever written there."""
    try:
        return frame()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return empty


class PointerLog:
    """Moves are rows of Parquet files; a commit file with the next number makes them count.

    The number is the version of all pointers. A commit creates its file only if it is absent, so of
    two writers who saw the same version one wins; the other looks at what was committed meanwhile. If
    that touched none of its chains it takes the next number, else it fails and has to judge again.
    Files without a commit (of a lost job or a loser) are never read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _commits(self) -> DataFrame:
        empty = self.spark.createDataFrame([], _COMMIT)
        return _read(lambda: self.spark.read.schema(_COMMIT).json(f"{self.root}/log"), empty)

    def version(self) -> int:
        """Number of the newest commit, 0 before the first."""
        return self._commits().agg(F.max("version")).first()[0] or 0

    def moves(self, after: int = 0) -> DataFrame:
        """``chain, run_id, prompt_version, decided_at, version`` of the commits after a version."""
        schema = T.StructType([*schemas.BASELINE_POINTER.fields, T.StructField("commit", T.StringType())])
        data = _read(
            lambda: self.spark.read.schema(schema).parquet(f"{self.root}/data"),
            self.spark.createDataFrame([], schema),
        )
        counted = self._commits().where(F.col("version") > after)
        return data.join(counted, "commit").select(*schemas.BASELINE_POINTER.names, "version")

    def commit(self, moves: DataFrame, seen: int | None = None) -> int:
        """Make the moves count; returns their version.

        ``seen`` is the version that the decision was based on. Without it nothing was read, so
        nothing can conflict.
        """
        name = uuid.uuid4().hex
        path = f"{self.root}/data/commit={name}"
        moves.select(*schemas.BASELINE_POINTER.names).write.parquet(path)
        own = self.spark.read.schema(schemas.BASELINE_POINTER).parquet(path).select("chain").distinct()
        newest = self.version() if seen is None else seen
        while True:
            if put_if_absent(self.spark, f"{self.root}/log/{newest + 1:020d}.json", {"version": newest + 1, "commit": name}):
                return newest + 1
            # Somebody was first. Judge by what they moved, then try the number after theirs.
            before, newest = newest, self.version()
            if seen is not None and not self.moves(before).join(own, "chain", "left_semi").isEmpty():
                raise PointerConflict(f"a chain was moved after version {before}")
