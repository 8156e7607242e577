import datetime as dt
import random

from pyspark.sql import functions as F

from tallyspark.operators.gate import gate_decisions, pair_runs
from tallyspark.operators.promotion import (
    baseline_lookup,
    baselines,
    current_baselines,
    promotion_chain,
)
from tests.test_gate import SCHEMA, TASK, run

START = dt.datetime(2024, 1, 1)


def chains(spark, data):
    """``data``: (chain, run tuple) in time order."""
    rows = [
        (*r, chain, START + dt.timedelta(minutes=i), f"v{i}") for i, (chain, r) in enumerate(data)
    ]
    schema = SCHEMA + ", chain string, ts timestamp, prompt_version string"
    return spark.createDataFrame(rows, schema)


def test_one_chain(spark):
    data = [
        run("r1", 0.60),
        run("r2", 0.70),
        run("r3", 0.90, failures=0.5),
        run("r4", 0.90, model="other"),
        run("r5", 0.72),
        run("r6", 0.60),
    ]
    scores = chains(spark, [("c", r) for r in data])
    got = promotion_chain(scores, TASK).orderBy("run_id").collect()
    assert [(r["baseline_run_id"], r["verdict"], r["next_baseline_run_id"]) for r in got] == [
        (None, "BOOTSTRAP", "r1"),
        ("r1", "PROMOTE", "r2"),
        ("r2", "REVERT", "r2"),
        ("r2", "INCOMPARABLE", "r2"),
        ("r2", "PROMOTE", "r5"),
        ("r5", "REVERT", "r5"),
    ]
    moves = baselines(promotion_chain(scores, TASK), scores)
    assert sorted(r["run_id"] for r in moves.collect()) == ["r1", "r2", "r5"]
    now = baseline_lookup(moves, scores).collect()
    assert [tuple(r) for r in now] == [("c", "v4", "r5", 0.72)]


def test_chain_verdicts_agree_with_the_gate(spark):
    """Many random chains, one of them with a third of all runs, in small Arrow batches."""
    rng = random.Random(2)
    data = []
    for number in range(900):
        chain = "hot" if number % 3 == 0 else f"c{rng.randrange(40)}"
        f1 = {label: rng.uniform(0.4, 1) for label in TASK.classes}
        data.append(
            (
                chain,
                run(
                    f"{chain}-{number:04d}",
                    sum(f1.values()) / 4,
                    f1=f1,
                    failures=rng.choice([0.0, 0.0, 0.02]),
                    cost=rng.uniform(0.01, 0.017),
                    latency=rng.uniform(900, 1500),
                    model=rng.choice("mmmmmn"),
                ),
            )
        )
    scores = chains(spark, data).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        fold = promotion_chain(scores, TASK).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(fold) == 900
    by_run = {r["run_id"]: r for r in fold}
    now = {}
    for chain, r in data:
        step = by_run[r[0]]
        assert step["baseline_run_id"] == now.get(chain)
        assert (step["verdict"] == "BOOTSTRAP") == (chain not in now)
        if step["verdict"] in ("BOOTSTRAP", "PROMOTE"):
            now[chain] = r[0]
        assert step["next_baseline_run_id"] == now[chain]
    pairs = spark.createDataFrame(
        [(r["run_id"], r["baseline_run_id"]) for r in fold if r["baseline_run_id"]],
        "candidate string, baseline string",
    )
    judged = gate_decisions(pair_runs(pairs, scores), TASK).collect()
    for row in judged:
        assert by_run[row["candidate"]]["verdict"] == row["verdict"]
    compared = [r for r in fold if r["verdict"] in ("PROMOTE", "REVERT")]
    assert len(judged) == len(compared) and any(r["verdict"] == "PROMOTE" for r in compared)


def test_chain_never_promotes_a_run_that_lacks_a_label(spark):
    some = {label: 0.9 for label in ("a", "b", "c")}
    scores = chains(spark, [("c", run("r1", 0.6)), ("c", run("r2", 0.9, f1=some)), ("c", run("r3", 0.9, data=None))])
    got = promotion_chain(scores, TASK).orderBy("run_id").collect()
    assert [r["verdict"] for r in got] == ["BOOTSTRAP", "INCOMPARABLE", "INCOMPARABLE"]


def test_only_possible_promotions_are_folded(spark):
    """One chain of many runs: what cannot be promoted does not reach the sequential step."""
    scores = spark.range(100_000).select(
        F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("run_id"),
        F.lit("d").alias("dataset_fp"),
        F.lit("m").alias("model"),
        F.when(F.col("id") % 20_000 == 1, 0.6 + F.col("id") / 400_000).otherwise(0.6).alias("macro_f1"),
        F.lit(0.0).alias("parse_failure_rate"),
        F.lit(1.0).alias("latency_ms"),
        F.lit(0.01).alias("est_cost_usd"),
        F.lit("hot").alias("chain"),
        F.timestamp_seconds("id").alias("ts"),
    )
    f1 = F.map_from_arrays(F.lit(list(TASK.classes)), F.array_repeat("macro_f1", len(TASK.classes)))
    scores = scores.withColumn("class_f1", f1)
    chain = promotion_chain(scores, TASK)
    counts = {r["verdict"]: r["count"] for r in chain.groupBy("verdict").count().collect()}
    assert counts == {"BOOTSTRAP": 1, "PROMOTE": 4, "REVERT": 99_995}
    last = chain.where("run_id = 'r099999'").first()
    assert last["baseline_run_id"] == last["next_baseline_run_id"] == "r080001"


def test_newest_pointer_wins(spark):
    rows = [("c", "r1", "v1", START), ("c", "r2", "v2", START + dt.timedelta(1)), ("d", "r3", "v3", START)]
    pointers = spark.createDataFrame(
        rows, "chain string, run_id string, prompt_version string, decided_at timestamp"
    )
    got = current_baselines(pointers).orderBy("chain").select("chain", "run_id")
    assert [tuple(r) for r in got.collect()] == [("c", "r2"), ("d", "r3")]
    assert current_baselines(pointers.where(F.lit(False))).count() == 0
