"""Explicit schemas of the tables the engine reads and writes."""

from pyspark.sql import types as T


def _s(name: str, nullable: bool = False) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable)


def _l(name: str) -> T.StructField:
    return T.StructField(name, T.LongType(), False)


def _d(name: str) -> T.StructField:
    return T.StructField(name, T.DoubleType(), False)


LINES = T.StructType([_s("file"), _l("line_no"), _s("raw")])

EXAMPLES = T.StructType(
    [_s("id"), _s("text"), _s("label"), _s("difficulty"), _s("note", True)]
)

PROMPT_SOURCE = T.StructType(
    [
        _s("stem"),
        T.StructField("decode_error", T.StringType(), True),
        T.StructField("fields", T.ArrayType(T.StringType(), False), False),
        _s("version", True),
        _s("parent", True),
        _s("changelog", True),
        _s("system", True),
        _s("user_template", True),
    ]
)

COMPLETIONS = T.StructType(
    [
        _s("run_id"),
        _s("id"),
        T.StructField("repeat", T.IntegerType(), False),
        _s("content", True),
        T.StructField("prompt_tokens", T.LongType(), True),
        T.StructField("completion_tokens", T.LongType(), True),
        T.StructField("latency_ms", T.DoubleType(), True),
    ]
)

RUNS = T.StructType(
    [
        _s("run_id"),
        _s("timestamp"),
        T.StructField("ts", T.TimestampType(), False),
        _s("prompt_version"),
        _s("prompt_fp"),
        _s("dataset_fp"),
        _s("model"),
        T.StructField("params", T.MapType(T.StringType(), T.StringType()), False),
        _l("n_predictions"),
        _d("latency_ms"),
        _l("prompt_tokens"),
        _l("completion_tokens"),
        _d("est_cost_usd"),
    ]
)

PREDICTIONS = T.StructType(
    [
        _s("run_id"),
        _s("id"),
        T.StructField("repeat", T.IntegerType(), False),
        _s("expected"),
        _s("difficulty"),
        _s("raw_output"),
        _s("predicted"),
        _d("latency_ms"),
        _l("prompt_tokens"),
        _l("completion_tokens"),
    ]
)

CELLS = T.StructType(
    [
        _s("run_id"),
        _s("difficulty"),
        _s("y_true"),
        _s("y_pred"),
        _l("n"),
        _d("latency_ms"),
        _l("prompt_tokens"),
        _l("completion_tokens"),
    ]
)

CLASS_METRICS = T.StructType(
    [
        _s("run_id"),
        _s("slice"),
        _s("label"),
        _l("tp"),
        _l("predicted"),
        _l("support"),
        _d("precision"),
        _d("recall"),
        _d("f1"),
    ]
)

SLICE_METRICS = T.StructType(
    [
        _s("run_id"),
        _s("slice"),
        _l("support"),
        _l("correct"),
        _l("parse_failures"),
        _d("accuracy"),
        _d("macro_f1"),
        _d("micro_f1"),
        _d("parse_failure_rate"),
        T.StructField("class_f1", T.MapType(T.StringType(), T.DoubleType()), False),
    ]
)

BASELINE_POINTER = T.StructType(
    [
        _s("chain"),
        _s("run_id"),
        _s("prompt_version"),
        T.StructField("decided_at", T.TimestampType(), False),
    ]
)

PROMOTION = T.StructType(
    [
        _s("chain"),
        _s("run_id"),
        _s("baseline_run_id", True),
        _s("verdict"),
        _s("next_baseline_run_id"),
    ]
)
