"""Evaluate prompts against examples: score, parse, measure."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.parsing import parse_predictions
from tallyspark.functions.run_ids import run_id, utc_stamp
from tallyspark.operators.fingerprint import dataset_fingerprint
from tallyspark.operators.gate import run_scores
from tallyspark.operators.metrics import class_metrics, count_cells, slice_metrics
from tallyspark.operators.records import run_record_nested
from tallyspark.operators.scoring import (
    Client,
    attach_examples,
    render_prompts,
    replay_strictly,
    with_defaults,
)
from tallyspark.operators.sharing import local_copy
from tallyspark.operators.totals import run_cost, run_totals
from tallyspark.sources.answers import score_and_store
from tallyspark.sources.folders import shared_folder
from tallyspark.sources.run_store import RunStore
from tallyspark.task import DEFAULT_PRICES, TaskSpec


@dataclass(frozen=True)
class EvalResult:
    """The tables of one evaluation, each over all of its runs."""

    runs: DataFrame
    predictions: DataFrame
    cells: DataFrame
    class_metrics: DataFrame
    slice_metrics: DataFrame
    totals: DataFrame
    #: Whether the cells are read from the run store already.
    cells_are_stored: bool = False

    def scores(self) -> DataFrame:
        """What the gate compares, one row per run."""
        return run_scores(self.runs, self.slice_metrics, self.totals)

    def records(self) -> DataFrame:
        """One nested row per run."""
        return run_record_nested(
            self.runs, self.class_metrics, self.slice_metrics, self.totals
        )


def run_summary(
    runs: DataFrame,
    predictions: DataFrame,
    task: TaskSpec,
    prices: Mapping[str, tuple[float, float]] = DEFAULT_PRICES,
    stored_cells: DataFrame | None = None,
) -> EvalResult:
    """Measure given predictions (or their cell counts, if those are stored).

    A query over the result reads the predictions once: everything is derived from their cell
    counts, which all parts of a plan share. ``runs`` has ``run_id`` and ``model``;
    a run without predictions is reported with zeros.
    """
    cells = count_cells(predictions, task) if stored_cells is None else stored_cells
    per_class = class_metrics(cells, task, runs)
    per_slice = slice_metrics(per_class, task)
    zero = F.lit(0).cast("long")
    sums = runs.select("run_id", "model").join(run_totals(cells), "run_id", "left")
    totals = run_cost(
        sums.select(
            "run_id",
            "model",
            F.coalesce("n_predictions", zero).alias("n_predictions"),
            F.coalesce("latency_ms", F.lit(0.0)).alias("latency_ms"),
            F.coalesce("prompt_tokens", zero).alias("prompt_tokens"),
            F.coalesce("completion_tokens", zero).alias("completion_tokens"),
        ),
        prices,
    )
    return EvalResult(runs, predictions, cells, per_class, per_slice, totals, stored_cells is not None)


def evaluate(
    examples: DataFrame,
    prompts: DataFrame,
    task: TaskSpec,
    model: str,
    *,
    client_factory: Callable[[], Client] | None = None,
    completions: DataFrame | None = None,
    n_repeats: int = 1,
    temperature: float = 0.0,
    max_tokens: int = 20,
    max_workers: int | None = None,
    prices: Mapping[str, tuple[float, float]] = DEFAULT_PRICES,
    now: datetime | None = None,
    store: RunStore | None = None,
    answers_folder: str | None = None,
    run_key: str | None = None,
) -> EvalResult:
    """Run every prompt over every example and measure the outputs; one run per prompt.

    Outputs come from a client or from recorded ``completions`` (whose ``run_id`` is the prompt
    version; every planned input must have exactly one, and nothing else may be recorded for these versions).
    Answers of a client are paid for: each task's are committed when it ends, below ``answers_folder``
    (by default in the store, else in the shared folder), under a key of examples, prompts, model,
    settings and ``run_key``, by default the start ``now``. A call that repeats all of these, after
    a failure for example, asks only for what is missing; any other start is a new run.
    With a ``store`` the predictions and their cell counts are saved there and measured from there.
    """
    if (client_factory is None) == (completions is None):
        raise ValueError("give either client_factory or completions")
    spark = examples.sparkSession
    now = now or datetime.now(timezone.utc)
    started = F.lit(now)
    few = local_copy(prompts)  # read from their files once
    prompts = prompts if few is None else few
    data_fp = dataset_fingerprint(examples).first()["fingerprint"]

    runs = prompts.select(
        run_id(started, F.col("version")).alias("run_id"),
        utc_stamp(started).alias("timestamp"),
        started.alias("ts"),
        F.col("version").alias("prompt_version"),
        F.col("fingerprint").alias("prompt_fp"),
        F.lit(data_fp).alias("dataset_fp"),
        F.lit(model).alias("model"),
        F.create_map(
            F.lit("temperature"), F.lit(str(float(temperature))),
            F.lit("max_tokens"), F.lit(str(max_tokens)),
            F.lit("n_repeats"), F.lit(str(n_repeats)),
        ).alias("params"),
    )
    rows_per_id = None
    if completions is None:
        root = answers_folder or (f"{store.root}/answers" if store else f"{shared_folder(spark)}/answers")
        prompts_fp = dataset_fingerprint(prompts, fields=("version", "fingerprint")).first()["fingerprint"]
        start = run_key or now.astimezone(timezone.utc).isoformat()
        settings = json.dumps([start, data_fp, prompts_fp, model, float(temperature), max_tokens])
        answers = score_and_store(
            render_prompts(examples, prompts, n_repeats),
            client_factory,
            model,
            f"{root.rstrip('/')}/{hashlib.sha256(settings.encode()).hexdigest()[:16]}",
            temperature=temperature,
            max_tokens=max_tokens,
            max_workers=max_workers,
        )
        outputs = with_defaults(answers).withColumn("run_id", run_id(started, F.col("run_id")))
    else:
        rendered = render_prompts(examples, prompts, n_repeats)
        # Recordings of other versions are not this evaluation's concern.
        own = completions.join(prompts.select(F.col("version").alias("run_id")), "run_id", "left_semi")
        # Every key that passes is there once, so an id has an output per prompt and repeat.
        rows_per_id = prompts.count() * n_repeats
        replayed = replay_strictly(rendered, own, rows_per_id)
        outputs = replayed.withColumn("run_id", run_id(started, F.col("run_id")))
    predictions = parse_predictions(attach_examples(outputs, examples, rows_per_id=rows_per_id), task)
    if store is not None:
        store.save("predictions", predictions)
        run_ids = [row["run_id"] for row in runs.select("run_id").collect()]
        predictions = store.read_runs("predictions", *run_ids)
        store.save("cells", count_cells(predictions, task))
        return run_summary(runs, predictions, task, prices, store.read_runs("cells", *run_ids))
    return run_summary(runs, predictions, task, prices)
