"""The whole cycle: evaluate one prompt, gate it, move or keep the baseline."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.gate import GateConfig, PROMOTE, evaluate_gate, run_scores
from tallyspark.operators.promotion import BOOTSTRAP
from tallyspark.plans.evaluate import EvalResult, evaluate
from tallyspark.sources.pointer_log import PointerConflict
from tallyspark.sources.run_store import RunStore
from tallyspark.task import TaskSpec


@dataclass(frozen=True)
class Outcome:
    run_id: str
    verdict: str
    reasons: list[str]


def save_result(store: RunStore, result: EvalResult) -> None:
    """Store what was measured from stored predictions; run rows last, as the sign of completion."""
    if not result.cells_are_stored:
        store.save("cells", result.cells)
    store.save("class_metrics", result.class_metrics)
    store.save("slice_metrics", result.slice_metrics)
    store.save("runs", result.runs.join(result.totals.drop("model"), "run_id"))


def stored_scores(store: RunStore, *run_ids: str) -> DataFrame:
    """Gate inputs of stored runs; reads only those runs' partitions."""

    runs = store.read_runs("runs", *run_ids)
    identity = runs.drop("latency_ms", "est_cost_usd")
    return run_scores(identity, store.read_runs("slice_metrics", *run_ids), runs)


def run_and_gate(
    store: RunStore,
    examples: DataFrame,
    prompt: DataFrame,
    task: TaskSpec,
    model: str,
    *,
    chain: str = "default",
    cfg: GateConfig = GateConfig(),
    **options,
) -> Outcome:
    """Evaluate ``prompt`` (one row), store the run, then compare it with the chain's baseline.

    The run is stored before it is judged, so a run that cannot be compared is kept as well; the
    pointer moves on the first run and on promotion only. If another writer moves the chain between
    the judgement and the move, the run is judged again, against the new baseline.
    """
    result = evaluate(examples, prompt, task, model, store=store, **options)
    save_result(store, result)
    run = result.runs.select("run_id", "prompt_version").first()
    while True:
        seen = store.pointer_log.version()
        pointer = store.pointer(chain)
        verdict, reasons = BOOTSTRAP, []
        if pointer is not None:
            scores = stored_scores(store, run["run_id"], pointer["run_id"])
            verdict, reasons = evaluate_gate(scores, run["run_id"], pointer["run_id"], task, cfg)
        if verdict not in (BOOTSTRAP, PROMOTE):
            return Outcome(run["run_id"], verdict, reasons)
        # Stamped with the time of the decision, and later than the pointer it replaces.
        stamp = datetime.now(timezone.utc)
        if pointer is not None:
            stamp = max(stamp, pointer["decided_at"].astimezone(timezone.utc) + timedelta(microseconds=1))
        moves = result.runs.select(
            F.lit(chain).alias("chain"), "run_id", "prompt_version", F.lit(stamp).alias("decided_at")
        )
        try:
            store.move_baselines(moves, seen)
        except PointerConflict:
            continue
        return Outcome(run["run_id"], verdict, reasons)
