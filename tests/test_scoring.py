import re
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.operators import joins
from tallyspark.operators.fingerprint import prompt_registry
from tallyspark.operators.scoring import (
    SCORER_INPUT,
    attach_examples,
    plan_runs,
    render_prompts,
    repeat_expand,
    score,
    replay_strictly,
    score_replay,
    unpaired_predictions,
)
from tallyspark.operators.validate import PROMPT_FIELDS


@dataclass
class Reply:
    content: str
    prompt_tokens: int
    completion_tokens: int


class Echo:
    def complete(self, *, system, user, model, temperature, max_tokens):
        return Reply(f"{model}|{system}|{user}", len(user), max_tokens)


@pytest.fixture(scope="module")
def examples(spark):
    rows = [(f"e{i}", f"text {{{i}}}", "secret-label", "easy", "secret-note") for i in range(20)]
    return spark.createDataFrame(rows, schemas.EXAMPLES)


@pytest.fixture(scope="module")
def prompts(spark):
    rows = [
        ("p1", None, list(PROMPT_FIELDS), "p1", None, "c", "sys1", "Q: {text}"),
        ("p2", None, list(PROMPT_FIELDS), "p2", "p1", "c", "sys2", "{{x}} {text}{text}"),
    ]
    return prompt_registry(spark.createDataFrame(rows, schemas.PROMPT_SOURCE))


def test_repeats_are_numbered_and_consecutive(examples):
    out = repeat_expand(examples.select("id"), 3).orderBy("id", "repeat").limit(4).collect()
    assert [tuple(r) for r in out] == [("e0", 1), ("e0", 2), ("e0", 3), ("e1", 1)]
    with pytest.raises(ValueError):
        repeat_expand(examples, 0)


def test_rendering_and_the_scorer_see_nothing_but_prompt_and_text(examples, prompts):
    rendered = render_prompts(examples, prompts, 2)
    assert tuple(rendered.columns) == SCORER_INPUT
    rows = rendered.collect()
    assert len(rows) == 80
    for row in rows:
        text = f"text {{{row['id'][1:]}}}"
        want = f"Q: {text}" if row["run_id"] == "p1" else f"{{x}} {text}{text}"
        assert row["user"] == want
        assert "secret" not in row["system"] + row["user"]


def test_large_registries_are_planned_alike(examples, prompts, rows):
    texts = repeat_expand(examples.select("id", "text"), 2)
    dims = prompts.select("version", "system")
    small = plan_runs(texts, dims).select("id", "repeat", "version", "system")
    large = plan_runs(texts, dims, chunk_bytes=1).select("id", "repeat", "version", "system")
    assert rows(small) == rows(large)


def test_versions_are_unique(examples, prompts):
    texts = repeat_expand(examples.select("id", "text"))
    for size in (1, 1 << 20):
        with pytest.raises(ValueError, match="unique"):
            plan_runs(texts, prompts.unionByName(prompts), chunk_bytes=size)


def test_no_prompts_no_plan(examples, prompts):
    texts = repeat_expand(examples.select("id", "text"))
    assert plan_runs(texts, prompts.select("version", "system").limit(0)).count() == 0


@pytest.mark.parametrize("workers", [None, 2])
def test_client_answers_every_input_once(examples, prompts, workers):
    rendered = render_prompts(examples, prompts)
    answers = score(rendered, Echo, "m", max_tokens=7, max_workers=workers)
    if workers:
        assert answers.rdd.getNumPartitions() == workers
    both = answers.join(rendered, ["run_id", "id", "repeat"]).collect()
    assert len(both) == 40
    for row in both:
        assert row["content"] == f"m|{row['system']}|{row['user']}"
        assert (row["prompt_tokens"], row["completion_tokens"]) == (len(row["user"]), 7)
        assert row["latency_ms"] >= 0


def test_replay_fills_defaults(spark, examples, prompts):
    rendered = render_prompts(examples.where("id = 'e1'"), prompts.where("version = 'p1'"))
    recorded = spark.createDataFrame(
        [("p1", "e1", 1, None, None, None, None), ("p1", "other", 1, "x", 1, 1, 1.0)],
        schemas.COMPLETIONS,
    )
    out = score_replay(rendered, recorded).collect()
    assert [tuple(r) for r in out] == [("p1", "e1", 1, "", 0, 0, 0.0, True)]
    left_out = score_replay(rendered, recorded.where("id = 'other'")).collect()
    assert [tuple(r) for r in left_out] == [("p1", "e1", 1, "", 0, 0, 0.0, False)]
    assert replay_strictly(rendered, recorded.where("id = 'e1'")).count() == 1
    for wrong in (recorded, recorded.where("id = 'other'"), recorded.unionByName(recorded)):
        with pytest.raises(Exception, match="not exactly one"):
            replay_strictly(rendered, wrong).collect()
    bad = unpaired_predictions(rendered, recorded).collect()
    assert [tuple(r) for r in bad] == [("p1", "other", 1, 0, 1)]


def test_unpaired_finds_missing_and_double_outputs(spark, rows):
    keys = "run_id string, id string, repeat int"
    left = spark.createDataFrame([("r", "a", 1), ("r", "b", 1), ("r", "c", 1)], keys)
    right = spark.createDataFrame([("r", "a", 1), ("r", "b", 1), ("r", "b", 1)], keys)
    assert rows(unpaired_predictions(left, right)) == [("r", "b", 1, 1, 2), ("r", "c", 1, 1, 0)]


@pytest.mark.parametrize("hot_rows", [5, 10**9])
def test_lookup_of_a_hot_example(spark, examples, rows, monkeypatch, hot_rows):
    outputs = spark.range(300).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("run_id"),
        F.when(F.col("id") % 3 == 0, "e1")
        .otherwise(F.concat(F.lit("e"), (F.col("id") % 25).cast("string")))
        .alias("id"),
        F.lit(1).alias("repeat"),
    )
    want = rows(attach_examples(outputs, examples))
    assert len(want) == sum(i % 3 == 0 or i % 25 < 20 for i in range(300))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (0, 0))
    assert not joins.fits_broadcast(examples)
    assert rows(attach_examples(outputs, examples, hot_rows=hot_rows)) == want


def test_a_lookup_whose_keys_are_bounded_counts_nothing(spark, examples, rows, monkeypatch):
    """Recordings and examples are dealt by id once each, unless an id may have too many rows."""
    recorded = examples.select(F.lit("p1").alias("run_id"), "id", F.lit(1).alias("repeat"), F.concat(F.lit("raw "), "id").alias("content"),
                               *[F.lit(1).cast(kind).alias(name) for name, kind in (("prompt_tokens", "long"), ("completion_tokens", "long"), ("latency_ms", "double"))])
    rendered = recorded.select("run_id", "id", "repeat", F.lit("s").alias("system"), F.lit("u").alias("user"))

    def attached(bound, hot_rows=5, inputs=rendered):
        replayed = replay_strictly(inputs, recorded, bound, hot_rows)
        return attach_examples(replayed, examples, hot_rows=hot_rows, rows_per_id=bound)

    want = rows(attached(None))
    assert len(want) == 20
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (0, 0))
    for bound, hot_rows in ((None, 5), (1, 5), (5, 5), (1, 1)):
        assert rows(attached(bound, hot_rows)) == want
    frame = attached(1)
    assert rows(frame) == want
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan) == ["id", "id"]
    assert plan.count(" Sort [") <= 2

    # An input without an id is an input: it has no recording, whatever the lookup would make of it.
    nameless = rendered.where("id = 'e1'").withColumn("id", F.lit(None).cast("string"))
    for bound in (None, 1):
        with pytest.raises(Exception, match="not exactly one"):
            attached(bound, inputs=rendered.unionByName(nameless)).collect()
