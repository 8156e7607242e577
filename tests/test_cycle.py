"""Evaluate, store, gate, promote: the whole cycle on files."""

import datetime as dt
import json
import re
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from tallyspark import FEEDBACK_TASK, RunStore, evaluate, run_and_gate, schemas
from tallyspark.operators.gate import GateConfig
from tallyspark.plans.promote import stored_scores
from tallyspark.sources.examples import load_examples
from tallyspark.sources.prompts import load_prompt

MODEL = "llama-3.3-70b-versatile"
LABELS = FEEDBACK_TASK.classes


@dataclass
class Reply:
    content: str
    prompt_tokens: int = 40
    completion_tokens: int = 8


class Knowing:
    """Answers with the label named in the text, except for every ``blind``-th text."""

    blind = 4

    def complete(self, *, system, user, model, temperature, max_tokens):
        number, label = user.removeprefix("Feedback: ").strip().split(":")
        if self.blind and int(number) % self.blind == 0:
            return Reply("sorry, I cannot help")
        return Reply(json.dumps({"category": label}))


class Perfect(Knowing):
    blind = 0


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    with open(root / "d.jsonl", "w") as f:
        for i in range(24):
            row = {"id": f"e{i}", "text": f"{i}:{LABELS[i % 6]}", "label": LABELS[i % 6],
                   "difficulty": "hard" if i % 2 else "easy"}
            f.write(json.dumps(row) + "\n")
    for version in ("v1", "v2"):
        (root / f"{version}.yaml").write_text(
            f"version: {version}\nparent: null\nchangelog: c\nsystem: s {version}\n"
            "user_template: 'Feedback: {text}'\n"
        )
    examples = load_examples(spark, str(root / "d.jsonl"), FEEDBACK_TASK)
    return examples, {v: load_prompt(spark, str(root), v) for v in ("v1", "v2")}


def at(minute):
    return dt.datetime(2024, 5, 1, 12, minute, 3, 4567, tzinfo=dt.timezone.utc)


def test_bootstrap_revert_promote(spark, inputs, tmp_path):
    examples, prompts = inputs
    store = RunStore(spark, str(tmp_path / "runs"))
    assert store.baseline("default") is None

    def cycle(version, client, minute):
        return run_and_gate(store, examples, prompts[version], FEEDBACK_TASK, MODEL,
                            client_factory=client, now=at(minute), n_repeats=2,
                            **({"max_workers": 2}))

    first = cycle("v1", Knowing, 1)
    assert (first.run_id, first.verdict) == ("20240501T120103004Z_v1", "BOOTSTRAP")
    second = cycle("v1", Knowing, 2)
    assert second.verdict == "REVERT" and len(second.reasons) == 5
    assert store.baseline("default") == ("v1", first.run_id)

    # Latency of a stub is noise, so this run is judged by the other rules only.
    third = cycle("v2", Perfect, 3)
    failed = [r for r in third.reasons if r.startswith("[FAIL]")]
    assert all("latency" in reason for reason in failed)
    promoted = third.verdict == "PROMOTE"
    assert store.baseline("default") == (("v2", third.run_id) if promoted else ("v1", first.run_id))

    runs = store.read("runs").orderBy("run_id").collect()
    assert [r["run_id"] for r in runs] == [first.run_id, second.run_id, third.run_id]
    assert len({r["dataset_fp"] for r in runs}) == 1
    assert runs[0]["params"] == {"temperature": "0.0", "max_tokens": "20", "n_repeats": "2"}
    assert (runs[0]["prompt_tokens"], runs[0]["completion_tokens"]) == (48 * 40, 48 * 8)
    assert runs[0]["est_cost_usd"] == pytest.approx((48 * 40 * 0.59 + 48 * 8 * 0.79) / 1e6)

    predictions = store.read_runs("predictions", first.run_id)
    assert predictions.count() == 48
    assert predictions.where("predicted = 'PARSE_FAILURE'").count() == 12
    assert all(first.run_id in name for name in predictions.inputFiles())

    metrics = store.read_runs("slice_metrics", first.run_id).collect()
    assert {r["slice"] for r in metrics} == {"overall", "easy", "hard"}
    overall = next(r for r in metrics if r["slice"] == "overall")
    assert overall["accuracy"] == 0.75 and overall["support"] == 48
    assert set(overall["class_f1"]) == set(LABELS)
    assert store.read_runs("class_metrics", third.run_id).count() == 18
    assert store.has_run(first.run_id) and not store.has_run("20240501T000000000Z_v9")
    assert stored_scores(store, first.run_id, third.run_id).count() == 2


def test_saving_a_run_again_replaces_it(spark, inputs, tmp_path):
    examples, prompts = inputs
    store = RunStore(spark, str(tmp_path / "runs"))
    for minute in (1, 1, 2):
        run_and_gate(store, examples, prompts["v1"], FEEDBACK_TASK, MODEL,
                     client_factory=Perfect, now=at(minute), chain=f"c{minute}")
    assert store.read("runs").count() == 2
    assert store.read("predictions").count() == 48


def test_a_run_on_other_data_is_stored_but_not_compared(spark, inputs, tmp_path):
    examples, prompts = inputs
    store = RunStore(spark, str(tmp_path / "runs"))
    options = {"client_factory": Perfect}
    first = run_and_gate(store, examples, prompts["v1"], FEEDBACK_TASK, MODEL, now=at(1), **options)
    for minute, data, model, word in ((2, examples.where("id != 'e0'"), MODEL, "dataset"),
                                      (3, examples, "another", "model")):
        with pytest.raises(ValueError, match=word):
            run_and_gate(store, data, prompts["v2"], FEEDBACK_TASK, model, now=at(minute), **options)
    assert store.read("runs").count() == 3
    assert store.baseline("default") == ("v1", first.run_id)


def test_an_empty_dataset_gives_a_run_of_zeros(spark, inputs, tmp_path):
    examples, prompts = inputs
    store = RunStore(spark, str(tmp_path))
    outcome = run_and_gate(store, examples.limit(0), prompts["v1"], FEEDBACK_TASK, MODEL,
                           client_factory=Perfect, now=at(1))
    assert outcome.verdict == "BOOTSTRAP"
    metrics = store.read_runs("slice_metrics", outcome.run_id).collect()
    assert [(r["support"], r["macro_f1"], r["parse_failure_rate"]) for r in metrics] == [(0, 0, 0)] * 3
    run = store.read_runs("runs", outcome.run_id).first()
    assert (run["n_predictions"], run["latency_ms"], run["est_cost_usd"]) == (0, 0.0, 0.0)


def test_odd_run_ids_are_found_again(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    names = ["20240101T000000000Z_v:1=a/b%41 c", "20240101T000000000Z_é'[x]{y}", "00000123", "x"]
    rows = [(n, "easy", "a", "a", 1, 1.0, 1, 1) for n in names]
    store.save("cells", spark.createDataFrame(rows, schemas.CELLS))
    for name in names:
        assert [r["run_id"] for r in store.read_runs("cells", name).collect()] == [name]
    assert sorted(r["run_id"] for r in store.read("cells").collect()) == sorted(names)


def test_evaluate_many_prompts_from_recordings(spark, inputs):
    examples, prompts = inputs
    both = prompts["v1"].unionByName(prompts["v2"])
    recorded = examples.select("id", "label").withColumn(
        "run_id", F.explode(F.array(F.lit("v1"), F.lit("v2")))
    ).select(
        "run_id",
        "id",
        F.lit(1).alias("repeat"),
        F.when((F.col("run_id") == "v2") & (F.col("id") == "e3"), "oops")
        .otherwise(F.concat(F.lit('{"category": "'), "label", F.lit('"}')))
        .alias("content"),
        F.lit(1).cast("long").alias("prompt_tokens"),
        F.lit(1).cast("long").alias("completion_tokens"),
        F.lit(1.0).alias("latency_ms"),
    )
    result = evaluate(examples, both, FEEDBACK_TASK, "m", completions=recorded, now=at(5))
    records = {r["prompt_version"]: r for r in result.records().collect()}
    assert records["v1"]["metrics"]["overall"]["accuracy"] == 1.0
    assert records["v2"]["metrics"]["hard"]["accuracy"] == pytest.approx(11 / 12)
    assert records["v2"]["metrics"]["easy"]["per_class"]["bug_report"]["support"] == 0
    assert records["v1"]["totals"]["est_cost_usd"] == 0.0
    assert records["v1"]["run_id"] == "20240501T120503004Z_v1"
    with pytest.raises(ValueError):
        evaluate(examples, both, FEEDBACK_TASK, "m")
    for partial in (recorded.where("id <> 'e3'"), recorded.unionByName(recorded.limit(1))):
        with pytest.raises(Exception, match="exactly one"):
            evaluate(examples, both, FEEDBACK_TASK, "m", completions=partial).cells.collect()


def test_a_promotion_moves_the_pointer_whenever_the_run_began(spark, inputs, tmp_path):
    examples, prompts = inputs
    store = RunStore(spark, str(tmp_path / "runs"))
    late = run_and_gate(store, examples, prompts["v1"], FEEDBACK_TASK, MODEL, client_factory=Knowing, now=at(30))
    cfg = GateConfig(max_latency_multiplier=1e9)
    early = run_and_gate(store, examples, prompts["v2"], FEEDBACK_TASK, MODEL, client_factory=Perfect, now=at(1), cfg=cfg)
    assert (late.verdict, early.verdict) == ("BOOTSTRAP", "PROMOTE")
    assert store.baseline("default") == ("v2", early.run_id)
    assert [r["run_id"] for r in store.baseline_run("default").collect()] == [early.run_id]
    assert store.baseline_run("other").count() == 0
    record = store.records(early.run_id).first()
    assert record["metrics"]["overall"]["accuracy"] == 1.0 and record["totals"]["prompt_tokens"] == 960


def test_the_loser_of_a_chain_gates_again(spark, inputs, tmp_path, monkeypatch):
    """While a better run is judged, another writer promotes one that is better still."""
    examples, prompts = inputs
    store = RunStore(spark, str(tmp_path / "runs"))
    cfg = GateConfig(max_latency_multiplier=1e9)

    def cycle(client, minute):
        return run_and_gate(store, examples, prompts["v1"], FEEDBACK_TASK, MODEL, cfg=cfg, client_factory=client, now=at(minute))

    class Half(Knowing):
        blind = 2

    cycle(Half, 1)
    real, state = store.move_baselines, {"calls": 0}

    def interrupted(moves, seen=None):
        state["calls"] += 1
        if state["calls"] == 1:
            other = evaluate(examples, prompts["v2"], FEEDBACK_TASK, MODEL, client_factory=Perfect, now=at(2), store=store)
            from tallyspark.plans.promote import save_result

            save_result(store, other)
            real(other.runs.select(F.lit("default").alias("chain"), "run_id", "prompt_version", F.lit(dt.datetime.now(dt.timezone.utc)).alias("decided_at")))
        return real(moves, seen)

    monkeypatch.setattr(store, "move_baselines", interrupted)
    late = cycle(Perfect, 4)
    assert late.verdict == "REVERT" and state["calls"] == 1
    assert "macro_f1 gain: +0.0000" in late.reasons[0]
    assert store.baseline("default")[0] == "v2"


def test_an_evaluation_resumes_under_its_key(spark, inputs, tmp_path):
    examples, prompts = inputs
    folder = str(tmp_path / "answers")

    class Down(Knowing):
        def complete(self, **_):
            raise RuntimeError("no service")

    def accuracy(client, **options):
        found = evaluate(examples, prompts["v1"], FEEDBACK_TASK, MODEL, client_factory=client, answers_folder=folder, **options)
        return found.slice_metrics.where("slice = 'overall'").first()["accuracy"]

    assert accuracy(Perfect, run_key="k") == 1.0
    assert accuracy(Down, run_key="k") == 1.0  # everything is there
    assert accuracy(Knowing, run_key="other") == 0.75
    assert accuracy(Perfect, now=at(5)) == accuracy(Down, now=at(5)) == 1.0


def test_records_hold_every_example(spark, rows):
    """Chunks of a large and a small run, put together again."""
    from tallyspark.operators.records import EXAMPLE_FIELDS, example_chunks, from_chunks

    data = [("big" if k < 950 else "small", f"e{k % 700}", k // 700 + 1, "a", "easy", f"raw {k}", None if k % 9 else "b", 1.5, 2, 3) for k in range(1000)]
    frame = spark.createDataFrame(data, "run_id string, " + ", ".join(
        f"{name} {kind}" for name, kind in zip(EXAMPLE_FIELDS, "string,int,string,string,string,string,double,long,long".split(","))))
    chunks = example_chunks(frame, 100)
    sizes = [(r["run_id"], r["n_chunks"], len(r["examples"])) for r in chunks.collect()]
    assert {(run, n) for run, n, _ in sizes} == {("big", 10), ("small", 1)}
    assert max(size for _, _, size in sizes) < 200
    assert rows(from_chunks(chunks)) == rows(frame.select("run_id", *EXAMPLE_FIELDS))
    for row in chunks.collect():
        assert [(e["id"], e["repeat"]) for e in row["examples"]] == sorted((e["id"], e["repeat"]) for e in row["examples"])


def test_recordings_are_replayed_in_one_shuffle(spark, inputs, rows, monkeypatch):
    """Every id has one output, so none is counted. (Spark itself broadcasts the few examples here.)"""
    from tallyspark.operators import joins

    examples, prompts = inputs
    answer = F.concat(F.lit('{"category": "'), "label", F.lit('"}')).alias("content")
    one = F.lit(1).cast("long")
    recorded = examples.select(F.lit("v1").alias("run_id"), "id", F.lit(1).alias("repeat"), answer,
                               one.alias("prompt_tokens"), one.alias("completion_tokens"), F.lit(1.0).alias("latency_ms"))

    def predictions():
        return evaluate(examples, prompts["v1"], FEEDBACK_TASK, "m", completions=recorded, now=at(5)).predictions

    want = rows(predictions())
    assert len(want) == 24
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (0, 0))
    frame = predictions()
    assert rows(frame) == want
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan) == ["id"]
