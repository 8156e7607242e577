"""From examples and prompts to scored outputs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions.templates import render
from tallyspark.operators.joins import BROADCAST_BYTES, HOT_ROWS, lookup

#: Exactly these columns reach a scorer. Labels and notes never do.
SCORER_INPUT = ("run_id", "id", "repeat", "system", "user")


# Names and defaults of the client's call and of ``score``.
class Client(Protocol):
    """Anything that answers one prompt. Retries and rate limits are the client's concern."""

    def complete(
        self, *, system: str, user: str, model: str, temperature: float, max_tokens: int
    ) -> Any:
        """Return an object with ``content``, ``prompt_tokens``, ``completion_tokens``."""


def repeat_expand(examples: DataFrame, n_repeats: int = 1) -> DataFrame:
    """Each example ``n_repeats`` times, numbered from 1."""
    if n_repeats < 1:
        raise ValueError("n_repeats must be at least 1")
    return examples.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(n_repeats))))


def plan_runs(
    examples: DataFrame, prompts: DataFrame, chunk_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every example once per prompt version, with that prompt's columns.

    The examples stay where they are. The prompts, whose texts are measured first, are broadcast
    in chunks of about ``chunk_bytes``, and each example is planned for each version of a chunk. A
    version that stands for several prompts is an error.
    """
    width = sum((F.octet_length(F.to_json(F.struct(F.col(c)))) for c in prompts.columns), F.lit(0))
    rows, versions, size = prompts.agg(
        F.count(F.lit(1)), F.countDistinct("version"), F.sum(width.cast("long"))
    ).first()
    if rows != versions:
        raise ValueError("prompt versions must be unique and not null")
    chunks = max(1, -(-(size or 0) // chunk_bytes))
    chunk = F.pmod(F.xxhash64("version"), F.lit(chunks))

    def planned(k: int) -> DataFrame:
        part = prompts.where(chunk == k)
        versions = sorted(row["version"] for row in part.select("version").collect())
        plan = examples.withColumn(
            "version", F.explode(F.lit(versions) if versions else F.array().cast("array<string>"))
        )
        return plan.join(F.broadcast(part), "version")

    return reduce(DataFrame.unionByName, map(planned, range(chunks)))


def render_prompts(
    examples: DataFrame, prompts: DataFrame, n_repeats: int = 1, run_id=None
) -> DataFrame:
    """Scorer input: ``run_id, id, repeat, system, user``.

    ``run_id`` is a column over the planned rows; it defaults to the prompt version.
    """
    texts = repeat_expand(examples.select("id", "text"), n_repeats)
    planned = plan_runs(texts, prompts.select("version", "system", "parts"))
    name = F.col("version") if run_id is None else run_id
    return planned.select(
        name.alias("run_id"),
        "id",
        "repeat",
        "system",
        render(F.col("parts"), F.col("text")).alias("user"),
    )


def score(
    rendered: DataFrame,
    client_factory: Callable[[], Client],
    model: str,
    *,
    temperature: float = 0.0,
    max_tokens: int = 20,
    max_workers: int | None = None,
) -> DataFrame:
    """Ask a client for each rendered prompt; partitions are the unit of concurrency.

    ``client_factory`` is called once per task, on the executor. ``max_workers`` limits how many
    tasks call the service at once. The result must be stored before it is used twice:
    re-evaluating it would ask the service again.
    """
    inputs = rendered.select(*SCORER_INPUT)
    if max_workers is not None:
        inputs = inputs.repartition(max_workers, "run_id", "id", "repeat")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for batch in batches:
            answers = []
            for system, user in zip(batch["system"], batch["user"]):
                start = time.perf_counter()
                reply = client.complete(
                    system=system,
                    user=user,
                    model=model,
                    temperature=temperature,
                    max_tokens=max_tokens,
                )
                elapsed = (time.perf_counter() - start) * 1000
                answers.append(
                    (reply.content, reply.prompt_tokens, reply.completion_tokens, elapsed)
                )
            scored = pd.DataFrame(
                answers,
                columns=["content", "prompt_tokens", "completion_tokens", "latency_ms"],
                index=batch.index,
            )
            yield pd.concat([batch[["run_id", "id", "repeat"]], scored], axis=1)

    return inputs.mapInPandas(answer, schemas.COMPLETIONS)


def with_defaults(completions: DataFrame) -> DataFrame:
    """Absent content is an empty answer; absent usage counts as nothing."""
    return completions.select(
        "run_id",
        "id",
        "repeat",
        F.coalesce("content", F.lit("")).alias("raw_output"),
        F.coalesce("prompt_tokens", F.lit(0).cast("long")).alias("prompt_tokens"),
        F.coalesce("completion_tokens", F.lit(0).cast("long")).alias("completion_tokens"),
        F.coalesce("latency_ms", F.lit(0.0)).alias("latency_ms"),
    )


def score_replay(rendered: DataFrame, completions: DataFrame) -> DataFrame:
    """Recorded completions of the planned rows: one output per input.

    An input without a recording stays, with an empty output and ``is_recorded`` false.
    ``replay_strictly`` fails instead.
    """
    keys = ["run_id", "id", "repeat"]
    answers = with_defaults(completions).withColumn("is_recorded", F.lit(True))
    found = rendered.select(*keys).join(answers, keys, "left")
    zero = F.lit(0).cast("long")
    return found.select(
        *keys,
        F.coalesce("raw_output", F.lit("")).alias("raw_output"),
        F.coalesce("prompt_tokens", zero).alias("prompt_tokens"),
        F.coalesce("completion_tokens", zero).alias("completion_tokens"),
        F.coalesce("latency_ms", F.lit(0.0)).alias("latency_ms"),
        F.coalesce("is_recorded", F.lit(False)).alias("is_recorded"),
    )


def replay_strictly(
    rendered: DataFrame,
    completions: DataFrame,
    rows_per_id: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``score_replay`` that fails on a key without exactly one input and one recording.

    Inputs and recordings meet in one shuffle, which pairs and counts them at once. Nothing is combined
    before it: a sound key has two rows, and each side would be sorted once more for nothing. Where
    ``rows_per_id``, the number of keys that share an id, is known and below ``hot_rows``, the rows are
    dealt and sorted by id, so that a lookup by id finds them as it needs them.
    """
    keys = ["run_id", "id", "repeat"]
    by_id = rows_per_id is not None and rows_per_id < hot_rows
    answer = F.struct("raw_output", "prompt_tokens", "completion_tokens", "latency_ms")
    right = with_defaults(completions).select(
        *keys, F.lit(0).alias("_in"), F.lit(1).alias("_out"), answer.alias("_answer")
    )
    none = F.lit(None).cast(right.schema["_answer"].dataType)
    left = rendered.select(*keys, F.lit(1).alias("_in"), F.lit(0).alias("_out"), none.alias("_answer"))
    dealt = left.unionByName(right).repartition(*(["id"] if by_id else keys))
    met = dealt.groupBy("id", "run_id", "repeat").agg(
        F.sum("_in").alias("_in"), F.sum("_out").alias("_out"), F.max("_answer").alias("_answer")
    )
    message = F.concat(
        F.lit("not exactly one recorded completion for "),
        F.to_json(F.struct(*keys, F.col("_in").alias("n_inputs"), F.col("_out").alias("n_outputs"))),
    )
    paired = (F.col("_in") == 1) & (F.col("_out") == 1)
    sound = met.where(F.when(paired, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return sound.select(*keys, "_answer.*")


def attach_examples(
    outputs: DataFrame,
    examples: DataFrame,
    hot_rows: int = HOT_ROWS,
    rows_per_id: int | None = None,
) -> DataFrame:
    """Expected label and slice of each output, looked up by example id.

    ``rows_per_id`` is the most outputs that an id can have, if that is known.
    """
    truth = examples.select("id", F.col("label").alias("expected"), "difficulty")
    found = lookup(outputs, truth, "id", ("run_id", "repeat"), hot_rows=hot_rows, rows_per_key=rows_per_id)
    return found.where(F.col("expected").isNotNull())


def unpaired_predictions(expected: DataFrame, outputs: DataFrame) -> DataFrame:
    """Keys that do not have exactly one input and one output.

    Counting both sides per key needs no join, and copies of a key combine on the map side.
    """
    keys = ["run_id", "id", "repeat"]
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    left = expected.select(*keys, one.alias("_in"), none.alias("_out"))
    right = outputs.select(*keys, none.alias("_in"), one.alias("_out"))
    return (
        left.unionByName(right)
        .groupBy(*keys)
        .agg(F.sum("_in").alias("n_inputs"), F.sum("_out").alias("n_outputs"))
        .where((F.col("n_inputs") != 1) | (F.col("n_outputs") != 1))
    )
