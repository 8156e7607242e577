"""Paid answers, stored as they come in, so that no key is asked twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.operators.scoring import SCORER_INPUT, Client, score

KEYS = ("run_id", "id", "repeat")
#: Answers that one task collects before they are committed.
KEYS_PER_COMMIT = 1_000


def stored_answers(spark, folder: str) -> DataFrame:
    """What was committed so far; empty if nothing was."""
    try:
        return spark.read.schema(schemas.COMPLETIONS).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.COMPLETIONS)


def score_and_store(
    rendered: DataFrame,
    client_factory: Callable[[], Client],
    model: str,
    folder: str,
    *,
    temperature: float = 0.0,
    max_tokens: int = 20,
    max_workers: int | None = None,
    keys_per_commit: int = KEYS_PER_COMMIT,
) -> DataFrame:
    """Ask only for the keys of which ``folder`` has no answer yet, and return all their answers.

    A task's answers become part of the folder when the task ends, not when the job ends (version 2
    of Spark's file committer): a job that is killed, or loses executors, keeps what its finished
    tasks have paid for, and the same call again asks for the rest. Tasks are small for that reason:
    ``keys_per_commit`` keys, or with ``max_workers`` as many as that number of tasks needs.
    The folder must stand for one set of prompts, examples, model and settings.
    """
    spark = rendered.sparkSession
    keys = list(KEYS)
    pending = rendered.select(*SCORER_INPUT).join(stored_answers(spark, folder).select(*keys), keys, "left_anti")
    count = pending.count()
    if count:
        tasks = max_workers or -(-count // keys_per_commit)
        answers = score(
            pending, client_factory, model, temperature=temperature, max_tokens=max_tokens, max_workers=tasks
        )
        committed = answers.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        committed.parquet(folder)
    wanted = rendered.select(*keys)
    return stored_answers(spark, folder).join(wanted, keys, "left_semi").select(*schemas.COMPLETIONS.names)


def unanswered(rendered: DataFrame, folder: str) -> int:
    """How many keys a call would still ask for."""
    done = stored_answers(rendered.sparkSession, folder).select(*KEYS)
    return rendered.select(*KEYS).join(done, list(KEYS), "left_anti").agg(F.count(F.lit(1))).first()[0]
