"""Promote-or-revert decisions for pairs of runs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numbers import fixed
from tallyspark.task import OVERALL, TaskSpec

PROMOTE, REVERT, INCOMPARABLE = "PROMOTE", "REVERT", "INCOMPARABLE"


@dataclass(frozen=True)
class GateConfig:
    # The default thresholds.
    min_macro_f1_gain: float = 0.005
    max_per_class_f1_drop: float = 0.05
    min_parse_rate: float = 0.99
    max_cost_multiplier: float = 1.5
    max_latency_multiplier: float = 1.5


def run_scores(runs: DataFrame, per_slice: DataFrame, costs: DataFrame) -> DataFrame:
    """One row per run with everything the gate looks at.

    ``runs`` carries ``run_id, dataset_fp, model`` and any further columns, which are kept. The
    label F1 values travel as one map, so a comparison needs one row per side and no label join.
    """
    overall = per_slice.where(F.col("slice") == OVERALL).select(
        "run_id", "macro_f1", "parse_failure_rate", "class_f1"
    )
    spent = costs.select("run_id", "latency_ms", "est_cost_usd")
    return runs.join(overall, "run_id").join(spent, "run_id")


#: What a comparison reads of a run.
FACTS = ("dataset_fp", "model", "macro_f1", "parse_failure_rate", "class_f1", "latency_ms", "est_cost_usd")


def facts() -> Column:
    return F.struct(*FACTS)


def pair_runs(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """Look up both runs of each ``(candidate, baseline)`` pair as structs ``c`` and ``b``.

    Every pair stays; a run without scores is a null struct. Spark broadcasts the scores where their
    measured size allows it; larger ones meet the pairs in two left joins, whose skewed partitions
    (many candidates may share one baseline) are split.
    """
    packed = scores.select("run_id", facts().alias("run"))
    for key, name in (("candidate", "c"), ("baseline", "b")):
        pairs = pairs.join(packed.withColumnsRenamed({"run_id": key, "run": name}), key, "left")
    return pairs


def cause(task: TaskSpec) -> Column:
    """Why the runs ``c`` and ``b`` must not be compared; null if they may be."""

    def either(test) -> Column:
        return test(F.col("c")) | test(F.col("b"))

    def lacks_label(run: Column) -> Column:
        have = F.coalesce(F.map_keys(run["class_f1"]), F.array().cast("array<string>"))
        return F.size(F.array_except(_labels(task), have)) > 0

    return (
        F.when(either(lambda run: run.isNull()), "unknown run")
        .when(either(lambda run: run["dataset_fp"].isNull()), "unknown dataset")
        .when(either(lambda run: run["model"].isNull()), "unknown model")
        .when(F.col("c.dataset_fp") != F.col("b.dataset_fp"), "different dataset")
        .when(F.col("c.model") != F.col("b.model"), "different model")
        .when(either(lacks_label), "different labels")
    )


def is_comparable(task: TaskSpec) -> Column:
    """Known runs on the same data, with the same model and labels; else there is no verdict."""
    return cause(task).isNull()


def _labels(task: TaskSpec) -> Column:
    return F.lit(list(task.classes))


def _drops(task: TaskSpec) -> Column:
    """F1 lost per label, from baseline to candidate."""
    return F.transform(
        _labels(task),
        lambda label: F.struct(
            (F.col("b.class_f1")[label] - F.col("c.class_f1")[label]).alias("drop"),
            label.alias("label"),
        ),
    )


def class_f1_delta(paired: DataFrame, task: TaskSpec) -> DataFrame:
    """Per pair and label the F1 drop; ``is_worst`` marks the largest (ties: last label)."""
    return (
        paired.where(is_comparable(task))
        .withColumn("_drops", _drops(task))
        .withColumn("_worst", F.array_max("_drops"))
        .select("candidate", "baseline", F.explode("_drops").alias("d"), "_worst")
        .select(
            "candidate",
            "baseline",
            F.col("d.label").alias("label"),
            F.col("d.drop").alias("f1_drop"),
            (F.col("d") == F.col("_worst")).alias("is_worst"),
        )
    )


def _reason(passed: Column, text: Column) -> Column:
    return F.concat(F.when(passed, "[PASS] ").otherwise("[FAIL] "), text)


def rule_values(new, old, drop, growth) -> dict:
    """The number that each rule looks at.

    The one definition of the rules, for columns (``new`` and ``old`` are structs) and for arrays
    (dictionaries): ``growth(new, old)`` is their quotient, or what passes any limit if the
    baseline is 0, which cannot be exceeded.
    """
    return {
        "macro_f1_gain": new["macro_f1"] - old["macro_f1"],
        "class_f1_drop": drop,
        "parse_rate": 1.0 - new["parse_failure_rate"],
        "cost": growth(new["est_cost_usd"], old["est_cost_usd"]),
        "latency": growth(new["latency_ms"], old["latency_ms"]),
    }


def rule_limits(cfg: GateConfig) -> dict[str, float]:
    return {
        "macro_f1_gain": float(cfg.min_macro_f1_gain),
        "class_f1_drop": float(cfg.max_per_class_f1_drop),
        "parse_rate": float(cfg.min_parse_rate),
        "cost": float(cfg.max_cost_multiplier),
        "latency": float(cfg.max_latency_multiplier),
    }


def rule_passes(name: str, value, limit: float):
    """Gain and parse rate must reach their limits; the others must not exceed theirs."""
    return value >= limit if name in ("macro_f1_gain", "parse_rate") else value <= limit


def passes(task: TaskSpec, cfg: GateConfig) -> Column:
    """Whether run ``c`` passes all rules against run ``b``, which it may be compared with."""
    values = rule_values(F.col("c"), F.col("b"), F.array_max(_drops(task))["drop"], column_growth)
    limits = rule_limits(cfg)
    # Only a growth over nothing is null, and that passes.
    each = [F.coalesce(rule_passes(k, v, F.lit(limits[k])), v.isNull()) for k, v in values.items()]
    return reduce(Column.__and__, each)


def column_growth(new: Column, old: Column) -> Column:
    return F.when(old > 0, new / old)


def rules(worst: Column, cfg: GateConfig) -> Column:
    """The five rule results of a pair, each with the numbers behind it."""
    new, old = F.col("c"), F.col("b")
    values = rule_values(new, old, worst["drop"], column_growth)
    limits = rule_limits(cfg)
    lit = {name: F.lit(limit) for name, limit in limits.items()}

    def words(*parts) -> Column:
        return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])

    texts = {
        "macro_f1_gain": words(
            "macro_f1 gain: ", fixed(values["macro_f1_gain"], 4, sign=True),
            ", from ", fixed(old["macro_f1"], 4), " to ", fixed(new["macro_f1"], 4),
            " (min ", fixed(lit["macro_f1_gain"], 4, sign=True), ")",
        ),
        "class_f1_drop": words(
            "per-class f1 drop: ", fixed(worst["drop"], 4, sign=True),
            " for '", worst["label"], "' (max ", fixed(lit["class_f1_drop"], 4), ")",
        ),
        "parse_rate": words(
            "parse rate: ", fixed(values["parse_rate"], 4), " (min ", fixed(lit["parse_rate"], 4), ")"
        ),
    }
    spent = {"cost": ("est_cost_usd", "$", 6, ""), "latency": ("latency_ms", "", 0, "ms")}
    for name, (field, head, digits, unit) in spent.items():
        title = f"{name} multiplier: "
        texts[name] = F.when(
            old[field] > 0, words(title, fixed(values[name], 2), "x (max ", fixed(lit[name], 2), "x)")
        ).otherwise(words(title, f"skipped, baseline is 0 (candidate {head}", fixed(new[field], digits), f"{unit})"))

    def result(name: str) -> Column:
        passed = F.coalesce(rule_passes(name, values[name], lit[name]), values[name].isNull())
        return F.struct(
            F.lit(name).alias("rule"),
            passed.alias("passed"),
            values[name].alias("value"),
            lit[name].alias("limit"),
            _reason(passed, texts[name]).alias("reason"),
        )

    return F.array(*map(result, values))


def judge(paired: DataFrame, task: TaskSpec, cfg: GateConfig) -> DataFrame:
    """Verdict of every pair: with its rule results, or with the cause why it has none."""
    return (
        paired.withColumn("cause", cause(task))
        .withColumn("_worst", F.array_max(_drops(task)))
        .withColumn("rules", F.when(F.col("cause").isNull(), rules(F.col("_worst"), cfg)))
        .select(
            "candidate",
            "baseline",
            F.when(F.col("cause").isNotNull(), INCOMPARABLE)
            .when(F.forall("rules", lambda rule: rule["passed"]), PROMOTE)
            .otherwise(REVERT)
            .alias("verdict"),
            "rules",
            "cause",
        )
    )


def gate_decisions(
    paired: DataFrame, task: TaskSpec, cfg: GateConfig = GateConfig()
) -> DataFrame:
    """Verdict and rule results of every comparable pair."""
    return judge(paired.where(is_comparable(task)), task, cfg).drop("cause")


def gate_reasons(decisions: DataFrame) -> DataFrame:
    """One row per pair and rule, passed or not."""
    return decisions.select(
        "candidate", "baseline", "verdict", F.posexplode("rules").alias("position", "r")
    ).select("candidate", "baseline", "verdict", "position", "r.*")


def gate_incomparable(paired: DataFrame, task: TaskSpec) -> DataFrame:
    """Pairs that must not be compared, and why."""
    return (
        paired.withColumn("reason", cause(task))
        .where(F.col("reason").isNotNull())
        .select("candidate", "baseline", F.lit(INCOMPARABLE).alias("verdict"), "reason")
    )


def evaluate_gate(
    scores: DataFrame,
    candidate: str,
    baseline: str,
    task: TaskSpec,
    cfg: GateConfig = GateConfig(),
) -> tuple[str, list[str]]:
    """Fail-fast form for one pair: the verdict and its reason lines."""
    both = scores.where(F.col("run_id").isin(candidate, baseline))
    pair = both.sparkSession.createDataFrame(
        [(candidate, baseline)], "candidate string, baseline string"
    )
    paired = pair_runs(pair, both)
    decision = judge(paired, task, cfg).first()
    if decision["verdict"] == INCOMPARABLE:
        raise ValueError(f"cannot compare {candidate} with {baseline}: {decision['cause']}")
    return decision["verdict"], [rule["reason"] for rule in decision["rules"]]
