"""Labelled examples from JSONL files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.fingerprint import IDENTITY_FIELDS
from tallyspark.operators.sharing import local_copy
from tallyspark.operators.validate import (
    decode_lines,
    raise_first_violation,
    validate_examples,
)
from tallyspark.task import TaskSpec


def _read_text(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the offset of its split, and a row number within the read."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value").alias("raw"),
    )


def _number_lines(lines: DataFrame) -> DataFrame:
    """Turn ``_start`` and ``_row`` into physical 1-based ``line_no`` per file.

    Files are read in splits. Each split's line count gives, by a running sum over the splits of
    its file, the number of the split's first line. Only these counts (one row per split, about
    one per 128 MB) are shuffled; the lines stay where they are. Both reads belong to one query
    over one listing, so they are split alike.
    """
    per_split = lines.groupBy("file", "_start").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_lines")
    )
    small = local_copy(per_split)
    offsets = (per_split if small is None else small).selectExpr(
        "file",
        "_start",
        "_first",
        "coalesce(sum(_lines) OVER (PARTITION BY file ORDER BY _start"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before",
    )
    if small is not None:
        offsets = F.broadcast(offsets)
    line_no = F.col("_before") + F.col("_row") - F.col("_first") + 1
    others = [name for name in lines.columns if name not in ("file", "_start", "_row")]
    return lines.join(offsets, ["file", "_start"]).select(
        "file", line_no.alias("line_no"), *others
    )


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, raw`` of every line, blank ones included."""
    return _number_lines(_read_text(spark, path))


def scan_examples(spark: SparkSession, path: str) -> DataFrame:
    """Decoded, numbered, not yet judged lines. Counting the lines parses nothing."""
    return decode_lines(scan_lines(spark, path))


def load_examples(spark: SparkSession, path: str, task: TaskSpec) -> DataFrame:
    """The validated examples; raises on the first bad line, like any strict loader."""
    decoded = scan_examples(spark, path)
    raise_first_violation(validate_examples(decoded, task))
    return decoded.select("file", "line_no", *IDENTITY_FIELDS)
