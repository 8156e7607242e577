"""Tokens, latency and cost per run."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.metrics import MEASURES
from tallyspark.task import DEFAULT_PRICES


def run_totals(cells: DataFrame) -> DataFrame:
    """Sums over all predictions of a run, repeats included; reads ``count_cells``."""
    return cells.groupBy("run_id").agg(
        F.sum("n").alias("n_predictions"), *[F.sum(name).alias(name) for name in MEASURES]
    )


def run_cost(
    totals: DataFrame, prices: Mapping[str, tuple[float, float]] = DEFAULT_PRICES
) -> DataFrame:
    """Estimated USD; needs a ``model`` column. A model without a price costs nothing.

    A price list is a parameter of a few entries, so it becomes a map literal, not a join.
    """

    def price(position: int):
        pairs = chain.from_iterable(
            (F.lit(model), F.lit(float(pair[position]))) for model, pair in prices.items()
        )
        if not prices:
            return F.lit(0.0)
        return F.coalesce(F.create_map(*pairs)[F.col("model")], F.lit(0.0))

    cost = F.col("prompt_tokens") * price(0) + F.col("completion_tokens") * price(1)
    return totals.withColumn("est_cost_usd", cost / F.lit(1_000_000.0))
