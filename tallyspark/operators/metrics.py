"""Confusion counts and the metrics derived from them, for many runs in one pass.

All metrics come from one aggregate of the predictions, keyed by (run, slice value, true label,
predicted label). It combines on the map side, so what is shuffled depends on the number of runs
and labels and not on the number of predictions, and no run or label can skew it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.numbers import fixed
from tallyspark.operators.sharing import one_pass
from tallyspark.task import OVERALL, PARSE_FAILURE, TaskSpec


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, or 0.0 when there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def outcome(predicted: Column, task: TaskSpec) -> Column:
    """A prediction outside the label set counts as a parse failure."""
    return F.when(predicted.isin(list(task.classes)), predicted).otherwise(PARSE_FAILURE)


def unknown_true_labels(predictions: DataFrame, task: TaskSpec) -> DataFrame:
    """True labels outside the label set, with their number of rows per run."""
    known = F.coalesce(F.col("expected").isin(list(task.classes)), F.lit(False))
    return (
        predictions.where(~known)
        .groupBy("run_id", F.col("expected").alias("y_true"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


#: Run totals that ride along with the cell counts if the predictions have them.
MEASURES = ("latency_ms", "prompt_tokens", "completion_tokens")


def count_cells(predictions: DataFrame, task: TaskSpec) -> DataFrame:
    """``run_id, difficulty, y_true, y_pred, n`` and summed measures: the only pass over the
    predictions, and all that any metric, total or gate needs.

    A true label outside the label set is a caller error and fails the query.
    """
    cells = predictions.groupBy(
        "run_id",
        "difficulty",
        F.col("expected").alias("y_true"),
        outcome(F.col("predicted"), task).alias("y_pred"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(name).alias(name) for name in MEASURES if name in predictions.columns],
    )
    message = F.concat(
        F.lit("true label outside the label set: "), F.coalesce("y_true", F.lit("null"))
    )
    known = F.col("y_true").isin(list(task.classes))
    # A filter, so that the check stays whichever columns are read afterwards.
    return one_pass(cells.where(F.when(known, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))))


def _slices_of(difficulty: Column, task: TaskSpec) -> Column:
    """The report slices a cell belongs to. Cheaper than expanding the predictions."""
    own = difficulty.isin(list(task.slices))
    both = F.array(F.lit(OVERALL), difficulty)
    return F.when(own, both).otherwise(F.array(F.lit(OVERALL)))


def _literals(values: tuple[str, ...]) -> Column:
    return F.lit(list(values))


def confusion_long(
    cells: DataFrame, task: TaskSpec, runs: DataFrame | None = None
) -> DataFrame:
    """Dense matrix ``run_id, slice, y_true, y_pred, n`` with a zero for every absent pair.

    ``runs`` (``run_id``) lists the runs to report; by default those with cells.
    """
    if runs is None:
        runs = cells.select("run_id").distinct()
    grid = (
        runs.select("run_id")
        .withColumn("slice", F.explode(_literals(task.report_slices)))
        .withColumn("y_true", F.explode(_literals(task.classes)))
        .withColumn("y_pred", F.explode(_literals(task.outcomes)))
        .withColumn("n", F.lit(0).cast("long"))
    )
    sliced = cells.withColumn("slice", F.explode(_slices_of(F.col("difficulty"), task)))
    keys = ["run_id", "slice", "y_true", "y_pred"]
    return (
        sliced.select(*keys, "n")
        .unionByName(grid)
        .groupBy(*keys)
        .agg(F.sum("n").alias("n"))
    )


def confusion_wide(
    cells: DataFrame, task: TaskSpec, runs: DataFrame | None = None
) -> DataFrame:
    """One row per run, slice and true label; one column per label plus the parse failures."""
    long = confusion_long(cells, task, runs)
    return (
        long.groupBy("run_id", "slice", "y_true")
        .pivot("y_pred", list(task.outcomes))
        .agg(F.sum("n"))
    )


def label_counts(cells: DataFrame, task: TaskSpec) -> DataFrame:
    """``run_id, slice, label, tp, predicted, support`` for the labels that occur.

    Each cell counts as support of its true label and, unless the parse failed, as a prediction
    of its predicted label.
    """
    n, zero = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("y_true") == F.col("y_pred"), n).otherwise(zero)
    as_true = F.struct(
        F.col("y_true").alias("label"),
        hit.alias("tp"),
        zero.alias("predicted"),
        n.alias("support"),
    )
    as_pred = F.struct(
        F.col("y_pred").alias("label"),
        zero.alias("tp"),
        n.alias("predicted"),
        zero.alias("support"),
    )
    shares = F.when(F.col("y_pred") == PARSE_FAILURE, F.array(as_true)).otherwise(
        F.array(as_true, as_pred)
    )
    return (
        cells.withColumn("slice", F.explode(_slices_of(F.col("difficulty"), task)))
        .select("run_id", "slice", F.explode(shares).alias("c"))
        .groupBy("run_id", "slice", F.col("c.label").alias("label"))
        .agg(
            F.sum("c.tp").alias("tp"),
            F.sum("c.predicted").alias("predicted"),
            F.sum("c.support").alias("support"),
        )
    )


def _with_prf(counts: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return (
        counts.withColumn("precision", ratio(F.col("tp"), F.col("predicted")))
        .withColumn("recall", ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", ratio(2 * p * r, p + r))
    )


def class_metrics(
    cells: DataFrame, task: TaskSpec, runs: DataFrame | None = None
) -> DataFrame:
    """Precision, recall, F1 and support of every label in every slice of every run.

    Labels and slices without predictions appear with zeros.
    """
    found = label_counts(cells, task)
    if runs is None:
        runs = cells.select("run_id").distinct()
    zero = F.lit(0).cast("long")
    grid = (
        runs.select("run_id")
        .withColumn("slice", F.explode(_literals(task.report_slices)))
        .withColumn("label", F.explode(_literals(task.classes)))
        .select(
            "run_id",
            "slice",
            "label",
            zero.alias("tp"),
            zero.alias("predicted"),
            zero.alias("support"),
        )
    )
    dense = (
        found.unionByName(grid)
        .groupBy("run_id", "slice", "label")
        .agg(
            F.sum("tp").alias("tp"),
            F.sum("predicted").alias("predicted"),
            F.sum("support").alias("support"),
        )
    )
    return _with_prf(dense)


def slice_metrics(per_class: DataFrame, task: TaskSpec) -> DataFrame:
    """Accuracy, macro and micro F1 and parse-failure rate per run and slice.

    Reads ``class_metrics``. A parse failure is a miss of its true label and a hit on nothing,
    so failures are the support that no label received as a prediction.
    """
    sums = per_class.groupBy("run_id", "slice").agg(
        F.sum("support").alias("support"),
        F.sum("tp").alias("correct"),
        F.sum("predicted").alias("_predicted"),
        # A handful of labels per group, in label order, so that sums do not depend on it.
        F.array_sort(F.collect_list(F.struct("label", "f1"))).alias("_f1"),
    )
    n, tp, predicted = F.col("support"), F.col("correct"), F.col("_predicted")
    failures = n - predicted
    f1_sum = F.aggregate("_f1", F.lit(0.0), lambda total, entry: total + entry["f1"])
    return sums.select(
        "run_id",
        "slice",
        "support",
        "correct",
        failures.alias("parse_failures"),
        ratio(tp, n).alias("accuracy"),
        (f1_sum / F.lit(len(task.classes))).alias("macro_f1"),
        # 2*tp + false positives (predicted - tp) + false negatives (support - tp)
        ratio(2 * tp, predicted + n).alias("micro_f1"),
        ratio(failures, n).alias("parse_failure_rate"),
        F.map_from_entries("_f1").alias("class_f1"),
    )


# The column widths and the first two lines of the report.
_NAME, _NUMBER = 20, 10
REPORT_HEAD = "class".ljust(_NAME) + "".join(x.rjust(_NUMBER) for x in ("precision", "recall", "f1", "support"))
REPORT_RULE = "-" * len(REPORT_HEAD)


def _padded(text: Column, width: int, left: bool = False) -> Column:
    """Text in a column of a width; longer text is not cut."""
    blanks = F.repeat(F.lit(" "), F.greatest(F.lit(width) - F.length(text), F.lit(0)))
    return F.concat(blanks, text) if left else F.concat(text, blanks)


def report_text(report: DataFrame) -> DataFrame:
    """``run_id, slice, text``: the printable report, one text per run and slice.

    Reads the rows of ``classification_report``, a handful per text.
    """
    ordered = F.array_sort(F.collect_list(F.struct("position", "item", "line")))
    lines = report.groupBy("run_id", "slice").agg(ordered.alias("rows"))

    def part(test) -> Column:
        return F.transform(F.filter("rows", test), lambda row: row["line"])

    labels, totals = part(lambda row: row["position"] == 0), part(lambda row: row["position"] > 0)
    head = F.array(F.lit(REPORT_HEAD), F.lit(REPORT_RULE))
    whole = F.concat(head, labels, F.array(F.lit("")), totals)
    return lines.select("run_id", "slice", F.array_join(whole, "\n").alias("text"))


def classification_report(per_class: DataFrame, per_slice: DataFrame) -> DataFrame:
    """The text report as rows: one per label, then the four summary lines.

    ``position`` orders the rows of a slice; ``line`` is the printable form.
    """
    labels = per_class.select(
        "run_id",
        "slice",
        F.lit(0).alias("position"),
        F.col("label").alias("item"),
        "precision",
        "recall",
        "f1",
        "support",
        F.concat(
            _padded(F.col("label"), _NAME),
            *[_padded(fixed(F.col(x), 3), _NUMBER, left=True) for x in ("precision", "recall", "f1")],
            _padded(F.col("support").cast("string"), _NUMBER, left=True),
        ).alias("line"),
    )
    summary = ("accuracy", "macro_f1", "micro_f1", "parse_failure_rate")
    counts = F.format_string(" (%d/%d)", "parse_failures", "support")
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(name).alias("item"),
                F.col(name).alias("value"),
                F.concat(
                    _padded(F.lit(f"{name}:"), _NAME),
                    F.lit(" "),
                    fixed(F.col(name), 3),
                    counts if name == "parse_failure_rate" else F.lit(""),
                ).alias("line"),
            )
            for i, name in enumerate(summary)
        ]
    )
    none = F.lit(None).cast("double")
    totals = per_slice.select(
        "run_id", "slice", "support", F.explode(entries).alias("e")
    ).select(
        "run_id",
        "slice",
        F.col("e.position").alias("position"),
        F.col("e.item").alias("item"),
        none.alias("precision"),
        none.alias("recall"),
        F.col("e.value").alias("f1"),
        "support",
        F.col("e.line").alias("line"),
    )
    return labels.unionByName(totals).orderBy("run_id", "slice", "position", "item")
