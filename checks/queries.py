"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from tallyspark.functions.parsing import parse_predictions
from tallyspark.functions.run_ids import run_id, utc_stamp
from tallyspark.operators import fingerprint, gate, inspect, metrics, promotion, scoring, validate
from tallyspark.operators.totals import run_cost, run_totals
from tallyspark.sources.examples import scan_examples as scan_example_files
from tallyspark.operators.records import from_chunks
from tallyspark.plans.promote import run_and_gate
from tallyspark.sources.folders import new_folder
from tallyspark.sources.prompts import scan_prompts
from tallyspark.sources.run_store import RunStore
from tallyspark.sources.tables import read_table

E, L, O = views.EVENT_TASK, views.LANG_TASK, views.ORDER_TASK
#: A baseline that every user's first run is compared with.
HOT_BASELINE = "u1-v1"


def _r(name: str) -> F.Column:
    return F.round(F.col(name), 6).alias(name)


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    """The one pass over the predictions; every metric is derived from its small result."""
    return metrics.count_cells(views.event_predictions(spark, folder), E)


def _slice_columns(per_slice: DataFrame) -> DataFrame:
    return per_slice.select(
        "run_id",
        "slice",
        "support",
        "correct",
        "parse_failures",
        _r("accuracy"),
        _r("macro_f1"),
        _r("micro_f1"),
        _r("parse_failure_rate"),
    )


def _class_columns(per_class: DataFrame) -> DataFrame:
    return per_class.select(
        "run_id",
        "slice",
        "label",
        "tp",
        "predicted",
        "support",
        _r("precision"),
        _r("recall"),
        _r("f1"),
    )


# ---- metrics ------------------------------------------------------------------------------


def slice_metrics(spark: SparkSession, folder: str) -> DataFrame:
    per_class = metrics.class_metrics(_cells(spark, folder), E)
    return _slice_columns(metrics.slice_metrics(per_class, E))


def slice_metrics_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The same numbers, with labels and slices looked up by example id."""
    outputs = views.event_outputs(spark, folder).drop("expected", "difficulty")
    examples = views.event_examples(spark, folder)
    joined = parse_predictions(scoring.attach_examples(outputs, examples), E)
    per_class = metrics.class_metrics(metrics.count_cells(joined, E), E)
    return _slice_columns(metrics.slice_metrics(per_class, E))


def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _class_columns(metrics.class_metrics(_cells(spark, folder), E))


def confusion_long(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_long(_cells(spark, folder), E)


def confusion_wide(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_wide(_cells(spark, folder), E)


def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    result = views.event_result(spark, folder)
    report = metrics.classification_report(result.class_metrics, result.slice_metrics)
    return report.select(
        "run_id",
        "slice",
        "position",
        "item",
        _r("precision"),
        _r("recall"),
        _r("f1"),
        "support",
    )


def report_text(spark: SparkSession, folder: str) -> DataFrame:
    result = views.event_result(spark, folder)
    return metrics.report_text(metrics.classification_report(result.class_metrics, result.slice_metrics))


def retarget_metrics(spark: SparkSession, folder: str) -> DataFrame:
    cells = metrics.count_cells(views.order_predictions(spark, folder), O)
    return _slice_columns(metrics.slice_metrics(metrics.class_metrics(cells, O), O))


def unknown_true_labels(spark: SparkSession, folder: str) -> DataFrame:
    stale = F.when(F.col("id") % 97 == 0, F.concat("expected", F.lit("_old")))
    predictions = views.event_outputs(spark, folder).withColumn(
        "expected", F.coalesce(stale, "expected")
    )
    return metrics.unknown_true_labels(predictions, E)


def unpaired_predictions(spark: SparkSession, folder: str) -> DataFrame:
    keys = views.event_outputs(spark, folder).select("run_id", "id", "repeat")
    copies = (
        F.when(F.col("id") % 101 == 0, F.lit(0)).when(F.col("id") % 103 == 0, F.lit(2)).otherwise(1)
    )
    outputs = keys.select("*", F.explode(F.array_repeat(F.lit(1), copies))).drop("col")
    return scoring.unpaired_predictions(keys, outputs)


# ---- parsing ------------------------------------------------------------------------------


def parse_events(spark: SparkSession, folder: str) -> DataFrame:
    return views.event_predictions(spark, folder).select("run_id", "id", "predicted")


def parse_documents(spark: SparkSession, folder: str) -> DataFrame:
    answers = views.document_answers(spark, folder)
    return parse_predictions(answers, L).select("doc_id", "predicted")


# ---- totals -------------------------------------------------------------------------------


def totals(spark: SparkSession, folder: str) -> DataFrame:
    return run_totals(metrics.count_cells(views.event_predictions(spark, folder), E))


def cost(spark: SparkSession, folder: str) -> DataFrame:
    model = F.expr("CASE run_id WHEN 'v5' THEN 'model-b' WHEN 'v6' THEN 'x' ELSE 'model-a' END")
    sums = run_totals(metrics.count_cells(views.event_predictions(spark, folder), E))
    priced = run_cost(sums.withColumn("model", model), views.PRICES)
    return priced.select("run_id", "model", _r("est_cost_usd"))


def summary(spark: SparkSession, folder: str) -> DataFrame:
    result = views.event_result(spark, folder)
    overall = result.slice_metrics.where("slice = 'overall'")
    return (
        result.runs.select("run_id", "prompt_version", "model")
        .join(overall, "run_id")
        .join(result.totals.drop("model"), "run_id")
        .select(
            "run_id",
            "prompt_version",
            "model",
            "support",
            _r("accuracy"),
            _r("macro_f1"),
            _r("parse_failure_rate"),
            "n_predictions",
            "latency_ms",
            "prompt_tokens",
            "completion_tokens",
            _r("est_cost_usd"),
        )
    )


def record_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Nested records, taken apart again."""
    return (
        views.event_result(spark, folder)
        .records()
        .select("run_id", "totals", F.explode("metrics").alias("slice", "m"))
        .select("run_id", "slice", "totals", "m", F.explode("m.per_class").alias("label", "c"))
        .select(
            "run_id",
            "slice",
            "label",
            F.round("m.macro_f1", 6).alias("macro_f1"),
            F.col("m.support").alias("slice_support"),
            F.round("c.f1", 6).alias("f1"),
            F.col("c.support").alias("support"),
            F.round("totals.est_cost_usd", 6).alias("est_cost_usd"),
        )
    )


def run_ids(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events", "event_id", "ts", "event_type")
    # The table's times have no zone; they are UTC.
    instant = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    return events.select(
        "event_id",
        utc_stamp(instant).alias("timestamp"),
        run_id(instant, F.col("event_type")).alias("run_id"),
    )


# ---- gate ---------------------------------------------------------------------------------


def _paired(spark: SparkSession, folder: str, unknown: bool = False) -> DataFrame:
    """Each user's runs against the run before, and all first runs against one baseline."""
    result = views.user_result(spark, folder, "IF(r = 5, 'model-b', 'model-a')")
    steps = result.runs.where("r > 1").selectExpr(
        "run_id AS candidate", "concat(chain, '-v', r - 1) AS baseline"
    )
    firsts = result.runs.where("r = 1").selectExpr(
        "run_id AS candidate", f"'{HOT_BASELINE}' AS baseline"
    )
    pairs = steps.unionByName(firsts)
    if unknown:
        last = result.runs.where("r = 6")
        pairs = pairs.unionByName(
            last.selectExpr("run_id AS candidate", "concat(chain, '-v7') AS baseline")
        )
    return gate.pair_runs(pairs, result.scores())


def class_f1_delta(spark: SparkSession, folder: str) -> DataFrame:
    deltas = gate.class_f1_delta(_paired(spark, folder), E)
    return deltas.select("candidate", "baseline", "label", _r("f1_drop"), "is_worst")


def gate_decisions(spark: SparkSession, folder: str) -> DataFrame:
    decisions = gate.gate_decisions(_paired(spark, folder), E)
    failed = F.filter("rules", lambda rule: ~rule["passed"])
    return decisions.select(
        "candidate",
        "baseline",
        "verdict",
        F.array_join(F.transform(failed, lambda rule: rule["rule"]), ",").alias("failed_rules"),
    )


def gate_reasons(spark: SparkSession, folder: str) -> DataFrame:
    reasons = gate.gate_reasons(gate.gate_decisions(_paired(spark, folder), E))
    return reasons.select(
        "candidate",
        "baseline",
        "verdict",
        "position",
        "rule",
        "passed",
        _r("value"),
        "limit",
        "reason",
    )


def gate_incomparable(spark: SparkSession, folder: str) -> DataFrame:
    """Also the last runs against a seventh run that does not exist."""
    return gate.gate_incomparable(_paired(spark, folder, unknown=True), E)


def promotion_chain(spark: SparkSession, folder: str) -> DataFrame:
    return promotion.promotion_chain(views.event_result(spark, folder).scores(), E)


def promotion_chain_by_user(spark: SparkSession, folder: str) -> DataFrame:
    return promotion.promotion_chain(views.user_result(spark, folder).scores(), E)


def baseline_lookup(spark: SparkSession, folder: str) -> DataFrame:
    result = views.user_result(spark, folder)
    scores = result.scores()
    moves = promotion.baselines(promotion.promotion_chain(scores, E), result.runs)
    return promotion.baseline_lookup(moves, scores).select(
        "chain", "prompt_version", "run_id", _r("macro_f1")
    )


# ---- datasets -----------------------------------------------------------------------------


def _decoded(spark: SparkSession, folder: str) -> DataFrame:
    return validate.decode_lines(views.document_lines(spark, folder))


def scan_examples(spark: SparkSession, folder: str) -> DataFrame:
    """The lines written to files of a thousand and read back: bad lines with their numbers."""
    path = new_folder(spark, "lines")
    lines = views.document_lines(spark, folder).withColumn("part", F.expr("(line_no - 1) div 1000"))
    # Text readers end lines at any line break, which JSON writes as an escape.
    ordered = lines.repartition("part").sortWithinPartitions("part", "line_no")
    ordered.select("part", F.col("raw").alias("value")).write.partitionBy("part").text(path)
    bad = validate.validate_examples(scan_example_files(spark, path), L)
    part = F.regexp_extract("file", r"/part=(\d+)/", 1).cast("long")
    return bad.select(part.alias("part"), "line_no", "violation", "detail")


def validate_examples(spark: SparkSession, folder: str) -> DataFrame:
    return validate.validate_examples(_decoded(spark, folder), L)


def first_violation(spark: SparkSession, folder: str) -> DataFrame:
    return validate.first_violation(validate.validate_examples(_decoded(spark, folder), L))


def duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    return validate.duplicate_ids(_decoded(spark, folder))


def valid_examples(spark: SparkSession, folder: str) -> DataFrame:
    good = validate.valid_examples(_decoded(spark, folder), L)
    return good.select("line_no", "id", "text", "label", "difficulty", "note")


def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return inspect.class_distribution(views.document_examples(spark, folder))


def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return inspect.dataset_summary(views.document_examples(spark, folder), L)


def dataset_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.dataset_fingerprint(views.document_examples(spark, folder))


# ---- prompts and scoring ------------------------------------------------------------------


def prompt_registry(spark: SparkSession, folder: str) -> DataFrame:
    prompts = fingerprint.prompt_registry(views.conversation_prompts(spark, folder))
    return prompts.select(
        "version", "parent", "changelog", F.element_at("parts", 1).alias("lead")
    ).orderBy("version")


def prompt_violations(spark: SparkSession, folder: str) -> DataFrame:
    return validate.prompt_violations(views.conversation_prompts(spark, folder))


def prompt_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    prompts = fingerprint.prompt_registry(views.conversation_prompts(spark, folder))
    return prompts.select("version", "fingerprint")


def prompt_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation written as a prompt file, some of them faulty, and the folder scanned."""
    path = new_folder(spark, "prompts")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem, LocalFileSystem

        system, root = FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)
        system.create_dir(root)
        for batch in batches:
            for stem, text in zip(batch["stem"], batch["text"]):
                with system.open_output_stream(f"{root}/{stem}.yaml") as file:
                    file.write(text.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    views.conversation_files(spark, folder).mapInPandas(write, "n long").agg(F.sum("n")).collect()
    scanned = scan_prompts(spark, path)
    judged = validate.check_prompts(scanned)
    return judged.select("stem", "violation", "detail", F.length("system").alias("n_chars"))


def render_prompts(spark: SparkSession, folder: str) -> DataFrame:
    examples = views.document_examples(spark, folder)
    return scoring.render_prompts(examples, views.render_prompts_set(spark))


def repeat_expand(spark: SparkSession, folder: str) -> DataFrame:
    examples = views.document_examples(spark, folder).select("doc_id", "id")
    return scoring.repeat_expand(examples, 3).orderBy("doc_id", "repeat")


def score_client(spark: SparkSession, folder: str) -> DataFrame:
    """Every document answered by a client that only measures its prompt."""
    docs = views.document_examples(spark, folder)
    rendered = scoring.render_prompts(docs, views.render_prompts_set(spark))
    answers = scoring.score(rendered, Measuring, "m", max_tokens=9)
    return answers.select("run_id", "id", "repeat", "content", "prompt_tokens", "completion_tokens")


class Measuring:
    """A client whose answers are a pure function of what it is asked."""

    def complete(self, *, system: str, user: str, model: str, temperature: float, max_tokens: int):
        return Answer(f"{model}:{len(system)}:{temperature}", len(user), max_tokens)


class Answer(NamedTuple):
    content: str
    prompt_tokens: int
    completion_tokens: int


def score_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Render, replay recorded completions, look the labels up, parse."""
    examples = views.document_examples(spark, folder)
    rendered = scoring.render_prompts(examples, views.render_prompts_set(spark))
    outputs = scoring.score_replay(rendered, views.document_completions(spark, folder))
    predictions = parse_predictions(scoring.attach_examples(outputs, examples), L)
    return predictions.select(
        "run_id",
        "id",
        "repeat",
        "expected",
        "difficulty",
        "predicted",
        "raw_output",
        "prompt_tokens",
        "completion_tokens",
        "is_recorded",
    )


# ---- stored runs ---------------------------------------------------------------------------


def run_store_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Six runs stored, two of them read back as records."""
    store = RunStore(spark, new_folder(spark, "runs"))
    result = views.event_result(spark, folder)
    stamped = F.expr("concat('20240201T00000000', right(run_id, 1), 'Z_', run_id)").alias("run_id")

    def renamed(rows: DataFrame) -> DataFrame:
        return rows.select(stamped, *[name for name in rows.columns if name != "run_id"])

    store.save("class_metrics", renamed(result.class_metrics))
    store.save("slice_metrics", renamed(result.slice_metrics))
    runs = result.runs.join(result.totals.drop("model"), "run_id").withColumns(
        {"timestamp": F.lit("t"), "prompt_fp": F.lit("p"), "params": F.create_map(F.lit("k"), F.lit("v"))}
    )
    store.save("runs", renamed(runs))
    records = store.records("20240201T000000002Z_v2", "20240201T000000005Z_v5")
    return records.select(
        "run_id",
        "prompt_version",
        "totals.prompt_tokens",
        F.round("totals.est_cost_usd", 6).alias("est_cost_usd"),
        F.explode("metrics").alias("slice", "m"),
    ).select(
        "run_id",
        "prompt_version",
        "prompt_tokens",
        "est_cost_usd",
        "slice",
        F.round("m.macro_f1", 6).alias("macro_f1"),
        F.round(F.element_at("m.per_class", "click")["f1"], 6).alias("click_f1"),
    )


def run_store_examples(spark: SparkSession, folder: str) -> DataFrame:
    """All predictions of six stored runs, loaded as chunks of a record and taken apart again."""
    store = RunStore(spark, new_folder(spark, "runs"))
    typed = {"id": F.col("id").cast("string"), "prompt_tokens": F.col("prompt_tokens").cast("long"), "completion_tokens": F.col("completion_tokens").cast("long")}
    store.save("predictions", views.event_predictions(spark, folder).withColumns(typed))
    chunks = store.example_chunks(*[f"v{k}" for k in range(1, views.N_RUNS + 1)], rows=500)
    return from_chunks(chunks).drop("latency_ms")


def gate_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Three prompts evaluated from recordings, stored, gated and promoted one after the other."""
    store = RunStore(spark, new_folder(spark, "cycle"))
    examples = views.event_examples(spark, folder).withColumn("id", F.col("id").cast("string"))
    outputs = views.event_outputs(spark, folder)
    for version in ("v1", "v2", "v3"):
        answers = outputs.where(F.col("run_id") == version).select(
            "run_id",
            F.col("id").cast("string").alias("id"),
            "repeat",
            F.col("raw_output").alias("content"),
            F.col("prompt_tokens").cast("long").alias("prompt_tokens"),
            F.col("completion_tokens").cast("long").alias("completion_tokens"),
            "latency_ms",
        )
        run_and_gate(
            store, examples, views.one_prompt(spark, version), E, "model-a",
            chain="events", completions=answers, prices=views.PRICES,
        )
    runs = store.read("runs").select("run_id", "prompt_version", "n_predictions")
    moved = store.pointers().select("run_id", F.lit(True).alias("moved"))
    whole = store.read("slice_metrics").where("slice = 'overall'").select("run_id", _r("macro_f1"))
    return runs.join(whole, "run_id").join(moved, "run_id", "left").select(
        "prompt_version", "n_predictions", "macro_f1", F.coalesce("moved", F.lit(False)).alias("became_baseline")
    )


def baseline_pointer(spark: SparkSession, folder: str) -> DataFrame:
    """Every user's promotions appended to a store, and the newest pointers read back."""
    store = RunStore(spark, new_folder(spark, "pointers"))
    result = views.user_result(spark, folder)
    scores = result.scores()
    moves = promotion.baselines(promotion.promotion_chain(scores, E), result.runs)
    store.move_baselines(moves.where("prompt_version <> 'v1'"))
    store.move_baselines(moves.where("prompt_version = 'v1'"))
    return promotion.baseline_lookup(store.pointers(), scores).select(
        "chain", "prompt_version", "run_id", _r("macro_f1")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "slice_metrics": slice_metrics,
    "slice_metrics_joined": slice_metrics_joined,
    "class_metrics": class_metrics,
    "confusion_long": confusion_long,
    "confusion_wide": confusion_wide,
    "classification_report": classification_report,
    "report_text": report_text,
    "retarget_metrics": retarget_metrics,
    "unknown_true_labels": unknown_true_labels,
    "unpaired_predictions": unpaired_predictions,
    "parse_predictions": parse_events,
    "parse_documents": parse_documents,
    "run_totals": totals,
    "run_cost": cost,
    "run_summary": summary,
    "run_record_nested": record_nested,
    "run_ids": run_ids,
    "class_f1_delta": class_f1_delta,
    "gate_decisions": gate_decisions,
    "gate_reasons": gate_reasons,
    "gate_incomparable": gate_incomparable,
    "promotion_chain": promotion_chain,
    "promotion_chain_by_user": promotion_chain_by_user,
    "baseline_lookup": baseline_lookup,
    "validate_examples": validate_examples,
    "first_violation": first_violation,
    "duplicate_ids": duplicate_ids,
    "valid_examples": valid_examples,
    "class_distribution": class_distribution,
    "dataset_summary": dataset_summary,
    "dataset_fingerprint": dataset_fingerprint,
    "prompt_registry": prompt_registry,
    "prompt_violations": prompt_violations,
    "prompt_files": prompt_files,
    "prompt_fingerprints": prompt_fingerprints,
    "render_prompts": render_prompts,
    "repeat_expand": repeat_expand,
    "score_replay": score_replay,
    "score_client": score_client,
    "scan_examples": scan_examples,
    "run_store_roundtrip": run_store_roundtrip,
    "run_store_examples": run_store_examples,
    "baseline_pointer": baseline_pointer,
    "gate_cycle": gate_cycle,
}
