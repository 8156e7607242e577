"""Chains of runs, each gated against the baseline of its moment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.operators.gate import (
    INCOMPARABLE,
    PROMOTE,
    REVERT,
    GateConfig,
    cause,
    column_growth,
    facts,
    passes,
    rule_limits,
    rule_passes,
    rule_values,
)
from tallyspark.sources.folders import cut
from tallyspark.task import TaskSpec

BOOTSTRAP = "BOOTSTRAP"


def _next_promotions(candidates: DataFrame, bases: DataFrame, task: TaskSpec, cfg: GateConfig) -> DataFrame:
    """``chain, at, b``: per chain the first candidate after its baseline that the gate promotes."""
    met = candidates.join(bases, "chain").where(F.col("place") > F.col("at")).where(passes(task, cfg))
    first = met.groupBy("chain").agg(F.min_by(F.struct("place", "c"), F.col("place")).alias("next"))
    return first.select("chain", F.col("next.place").alias("at"), F.col("next.c").alias("b"))


def promotion_chain(
    scores: DataFrame, task: TaskSpec, cfg: GateConfig = GateConfig()
) -> DataFrame:
    """Judge each chain's runs in time order: ``chain, run_id, baseline_run_id, verdict,
    next_baseline_run_id``.

    The first run of a chain becomes its baseline, later ones only by promotion. All baselines of
    a chain share data, model and labels with its first run, so comparability is settled by that
    run. A run that fails the parse rate can never be promoted; with a positive minimum gain the
    baseline's macro F1 only rises, so neither can one that is not above the first run's by it.

    Chains advance together, in rounds: all runs that are left are compared with their chain's
    current baseline, and the earliest one that passes is the next. A chain without one is done. The
    comparison combines on the map side, so a chain that holds a third of all runs is as parallel as
    the others, and there are at most ``1 / gain`` rounds (as many as the longest chain has
    promotions). The scores, one row per run, and each round's baselines are written to the shared
    folder, so they are computed once. The promotions travel as one array per chain and give every
    run its baseline where it stands. ``scores`` needs ``chain`` and ``ts``.
    """
    place = F.struct("ts", "run_id")
    runs = cut(scores.select("chain", "ts", "run_id", facts().alias("c")))
    first = runs.groupBy("chain").agg(F.min_by(F.struct("ts", "run_id", "c"), place).alias("boot"))
    runs = (
        runs.join(first, "chain")
        .withColumn("b", F.col("boot.c"))
        .withColumn("is_first", F.col("run_id") == F.col("boot.run_id"))
        .withColumn("cause", cause(task))
    )
    values = rule_values(F.col("c"), F.col("b"), F.lit(0.0), column_growth)
    limits = rule_limits(cfg)
    settled = ["parse_rate", *(["macro_f1_gain"] if cfg.min_macro_f1_gain > 0 else [])]
    possible = F.col("cause").isNull() & ~F.col("is_first")
    for name in settled:
        possible &= rule_passes(name, values[name], F.lit(limits[name]))
    candidates = cut(runs.where(possible).select("chain", place.alias("place"), "c"))
    bases = first.select("chain", F.struct("boot.ts", "boot.run_id").alias("at"), F.col("boot.c").alias("b"))
    steps = [cut(_next_promotions(candidates, bases, task, cfg))]
    while not steps[-1].isEmpty():
        steps.append(cut(_next_promotions(candidates, steps[-1], task, cfg)))
    promoted = reduce(DataFrame.unionAll, steps).select("chain", "at")

    moves = promoted.groupBy("chain").agg(F.collect_list("at").alias("moves"))
    marked = (
        runs.select("chain", "ts", "run_id", "is_first", "cause", "boot")
        .join(moves, "chain", "left")
        .withColumn("moves", F.coalesce("moves", F.array().cast(moves.schema["moves"].dataType)))
        .withColumn("at", place)
        .withColumn("latest", F.array_max(F.filter("moves", lambda move: move < F.col("at"))))
    )
    before = F.when(~F.col("is_first"), F.coalesce("latest.run_id", "boot.run_id"))
    verdict = (
        F.when(F.col("is_first"), BOOTSTRAP)
        .when(F.col("cause").isNotNull(), INCOMPARABLE)
        .when(F.array_contains("moves", F.col("at")), PROMOTE)
        .otherwise(REVERT)
    )
    moved = F.col("verdict").isin(BOOTSTRAP, PROMOTE)
    return (
        marked.withColumn("baseline_run_id", before)
        .withColumn("verdict", verdict)
        .withColumn("next_baseline_run_id", F.when(moved, F.col("run_id")).otherwise(F.col("baseline_run_id")))
        .select(*schemas.PROMOTION.names)
    )


def baselines(decisions: DataFrame, runs: DataFrame) -> DataFrame:
    """The pointer history a set of chain decisions produces: every bootstrap and promotion."""
    moved = decisions.where(F.col("verdict").isin(BOOTSTRAP, PROMOTE)).select("chain", "run_id")
    return moved.join(
        runs.select("run_id", "prompt_version", F.col("ts").alias("decided_at")), "run_id"
    ).select(*schemas.BASELINE_POINTER.names)


def current_baselines(pointers: DataFrame) -> DataFrame:
    """The newest pointer of each chain: by time of decision, then by the commit's version if it has one."""
    order = [name for name in ("decided_at", "version", "run_id") if name in pointers.columns]
    newest = F.max_by(F.struct("run_id", "prompt_version", "decided_at"), F.struct(*order))
    return pointers.groupBy("chain").agg(newest.alias("p")).select("chain", "p.*")


def baseline_lookup(pointers: DataFrame, scores: DataFrame) -> DataFrame:
    """Current baseline of each chain with its macro F1."""
    now = current_baselines(pointers)
    return now.join(scores.select("run_id", "macro_f1"), "run_id").select(
        "chain", "prompt_version", "run_id", "macro_f1"
    )
