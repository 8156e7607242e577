"""Evaluation analytics for label-producing models, as Spark jobs over tables."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from tallyspark.operators.gate import GateConfig
from tallyspark.plans.evaluate import EvalResult, evaluate, run_summary
from tallyspark.plans.promote import Outcome, run_and_gate
from tallyspark.sources.run_store import RunStore
from tallyspark.task import FEEDBACK_TASK, PARSE_FAILURE, TaskSpec

__all__ = [
    "EvalResult",
    "FEEDBACK_TASK",
    "GateConfig",
    "Outcome",
    "PARSE_FAILURE",
    "RunStore",
    "TaskSpec",
    "evaluate",
    "run_and_gate",
    "run_summary",
]

# Python steps travel with their code, so executors need not have this package on their path.
register_pickle_by_value(sys.modules[__name__])
