"""Raw model output -> label, or the parse-failure sentinel."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.json_text import STRICT_OPTIONS, deep_string, is_strict_json, may_be_deep
from tallyspark.task import PARSE_FAILURE, TaskSpec

_WS = r"[ \t\n\r]*"


def first_object(raw: Column) -> Column:
    """The first ``{...}`` block, shortest match, across line breaks; '' if there is none."""
    return F.regexp_extract(raw, r"(?s)(\{.*?\})", 1)


def _plain_label(raw: Column, key: str) -> Column:
    """Value of an output that is just ``{"key": "value"}`` without escapes; '' otherwise."""
    quoted = re.escape(json.dumps(key, ensure_ascii=False))
    pattern = rf'\A{_WS}\{{{_WS}{quoted}{_WS}:{_WS}"([^"\\\x00-\x1f]*)"{_WS}\}}{_WS}\z'
    return F.regexp_extract(raw, pattern, 1)


def _may_be_json(raw: Column) -> Column:
    """Starts and ends like a JSON value; spares prose a parse that must fail."""
    starts = raw.rlike(rf'\A{_WS}[\[{{"0-9\-tfnNI]')
    return starts & raw.rlike(rf'[\]}}"0-9elNy]{_WS}\z')


def parse_predictions(outputs: DataFrame, task: TaskSpec, raw: str = "raw_output") -> DataFrame:
    """Add ``predicted`` to every row; failed parses are kept, never dropped.

    The whole output is tried as strict JSON first, then its first ``{...}`` block. The value
    must be an object whose response field is a *string* in the label set. Regular expressions
    settle the plain answers, bare or inside prose; only the others pay for JSON parsing. Each
    step is a column of its own, so that it runs once, and only for rows still open.
    """
    text = F.coalesce(F.col(raw), F.lit(""))
    answer = T.StructType([T.StructField(task.response_key, T.VariantType())])

    def known(label: Column) -> Column:
        return F.when(label.isin(list(task.classes)), label)

    def is_open(label: str) -> Column:
        return known(F.col(label)).isNull()

    block = F.col("_block")
    not_null = ~F.trim(text, F.lit(" \t\n\r")).isin("", "null")
    whole = _may_be_json(text) & is_strict_json(text) & not_null
    source = F.when(whole, text).when(is_strict_json(block), block)
    steps = (
        outputs.withColumn("_plain", _plain_label(text, task.response_key))
        .withColumn("_block", F.when(is_open("_plain"), first_object(text)))
        .withColumn(
            "_inner",
            F.when(block.isNotNull() & ~_may_be_json(text), _plain_label(block, task.response_key)),
        )
        .withColumn("_source", F.when(is_open("_plain") & is_open("_inner"), source))
        .withColumn(
            "_value", F.from_json(F.col("_source"), answer, STRICT_OPTIONS).getField(task.response_key)
        )
        .withColumn(
            "_label",
            F.when(
                F.schema_of_variant("_value") == "STRING",
                F.variant_get(F.col("_value"), "$", "string"),
            ).when(may_be_deep(F.col("_source")), deep_string(F.col("_source"), task.response_key)),
        )
    )
    labels = [known(F.col(name)) for name in ("_plain", "_inner", "_label")]
    predicted = F.coalesce(*labels, F.lit(PARSE_FAILURE))
    return steps.select(*[F.col(f"`{c}`") for c in outputs.columns], predicted.alias("predicted"))
