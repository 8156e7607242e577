"""Time the heavy operators on generated rows: python bench_scale.py [million rows] [cores]."""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.session import local_session
from tallyspark.functions.parsing import parse_predictions
from tallyspark.operators.fingerprint import dataset_fingerprint
from tallyspark.operators.metrics import count_cells
from tallyspark.task import TaskSpec

TASK = TaskSpec(("a", "b", "c", "d"))


def outputs(spark: SparkSession, rows: int) -> DataFrame:
    """76 % plain answers, 20 % in prose, 2 % other JSON, 2 % junk; one run has a third of the rows."""
    label = F.element_at(F.array(*map(F.lit, TASK.classes)), (F.col("id") % 4 + 1).cast("int"))
    plain = F.concat(F.lit('{"category": "'), label, F.lit('"}'))
    kind = F.col("id") % 50
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 40)).alias("run_id"),
        "id",
        F.lit(1).alias("repeat"),
        label.alias("expected"),
        F.when(F.col("id") % 2 == 0, "easy").otherwise("hard").alias("difficulty"),
        F.when(kind == 0, "no answer")
        .when(kind == 1, F.concat(F.lit('{"x": [1, 2], "category": "'), label, F.lit('"}')))
        .when(kind < 12, F.concat(F.lit("Sure: "), plain, F.lit(" as asked")))
        .otherwise(plain)
        .alias("raw_output"),
        F.lit(40).cast("long").alias("prompt_tokens"),
        F.lit(8).cast("long").alias("completion_tokens"),
        F.lit(120.0).alias("latency_ms"),
    )


def examples(spark: SparkSession, rows: int) -> DataFrame:
    text = F.concat(F.lit("some short text number "), F.col("id").cast("string"))
    return spark.range(rows).select(
        F.col("id").cast("string").alias("id"),
        text.alias("text"),
        F.lit("a").alias("label"),
        F.lit("easy").alias("difficulty"),
        F.lit(None).cast("string").alias("note"),
    )


def main(millions: float = 20, cores: str = "8") -> None:
    rows = int(millions * 1_000_000)
    spark = local_session(cores)
    parsed = parse_predictions(outputs(spark, rows), TASK)
    jobs = {
        "parse_predictions": parsed,
        "parse_predictions + count_cells": count_cells(parsed, TASK),
        "dataset_fingerprint": dataset_fingerprint(examples(spark, rows)),
    }
    count_cells(parse_predictions(outputs(spark, 100_000), TASK), TASK).collect()  # warm-up
    for name, job in jobs.items():
        start = time.perf_counter()
        job.write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        print(f"{name:36s}{rows:>12,d} rows{seconds:8.1f} s{rows / seconds / 1e6:8.2f} M rows/s")


if __name__ == "__main__":
    main(float(sys.argv[1]) if sys.argv[1:] else 20, sys.argv[2] if sys.argv[2:] else "8")
