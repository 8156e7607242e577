"""Counts that describe a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.task import TaskSpec


def class_distribution(examples: DataFrame) -> DataFrame:
    """Examples per label, labels in order; labels without examples do not appear."""
    return examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label")


def dataset_summary(examples: DataFrame, task: TaskSpec) -> DataFrame:
    """One row: the number of examples and the split over the task's slices."""
    return examples.agg(
        F.count(F.lit(1)).alias("n_examples"),
        *[F.count_if(F.col("difficulty") == name).alias(f"n_{name}") for name in task.slices],
    )
