"""Nested run records, as stored and read by users of single runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nested_metrics(per_class: DataFrame, per_slice: DataFrame) -> DataFrame:
    """``run_id`` and a map slice -> metrics, each with a map label -> metrics.

    Groups are bounded by the number of labels and slices.
    """
    by_label = per_class.groupBy("run_id", "slice").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.struct("label", F.struct("precision", "recall", "f1", "support").alias("m"))
                )
            )
        ).alias("per_class")
    )
    entry = F.struct(
        "accuracy", "macro_f1", "micro_f1", "parse_failure_rate", "support", "per_class"
    )
    return (
        per_slice.join(by_label, ["run_id", "slice"])
        .groupBy("run_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.col("slice"), entry.alias("m")))
            ).alias("metrics")
        )
    )


#: Examples in one chunk of a record, about.
CHUNK_ROWS = 1_000
#: What a record keeps of each example.
EXAMPLE_FIELDS = (
    "id", "repeat", "expected", "difficulty", "raw_output", "predicted",
    "latency_ms", "prompt_tokens", "completion_tokens",
)


def example_chunks(predictions: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """``run_id, chunk, n_chunks, examples``: a run's examples as arrays that fit a row.

    A run gets as many chunks as its size needs, and a hash of the example deals them out, so a chunk
    holds about ``rows`` examples however large the run is, and a large run is spread like many small
    ones. Within a chunk the examples are ordered by id and repeat; all chunks together are the run.
    """
    sizes = predictions.groupBy("run_id").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("run_id", F.ceil(F.col("_n") / F.lit(float(rows))).cast("int").alias("n_chunks"))
    dealt = predictions.join(sizes, "run_id").withColumn(
        "chunk", F.pmod(F.xxhash64("id", "repeat"), F.col("n_chunks").cast("long")).cast("int")
    )
    return dealt.groupBy("run_id", "n_chunks", "chunk").agg(
        F.array_sort(F.collect_list(F.struct(*EXAMPLE_FIELDS))).alias("examples")
    ).select("run_id", "chunk", "n_chunks", "examples")


def from_chunks(chunks: DataFrame) -> DataFrame:
    """The predictions that chunks were made of."""
    return chunks.select("run_id", F.explode("examples").alias("e")).select("run_id", "e.*")


def run_record_nested(
    runs: DataFrame, per_class: DataFrame, per_slice: DataFrame, costs: DataFrame
) -> DataFrame:
    """One row per run: identity, nested metrics and totals.

    A run's examples may not fit one row: ``example_chunks`` has them.
    """
    totals = costs.select(
        "run_id",
        F.struct("latency_ms", "prompt_tokens", "completion_tokens", "est_cost_usd").alias(
            "totals"
        ),
    )
    return runs.join(nested_metrics(per_class, per_slice), "run_id").join(totals, "run_id")
