from tallyspark.functions.json_text import (
    canonical_json,
    is_blank,
    is_strict_json,
    json_string,
    strip_space,
)
from tallyspark.functions.parsing import first_object, parse_predictions
from tallyspark.functions.run_ids import run_id, utc_stamp
from tallyspark.functions.templates import render, template_is_supported, template_parts

__all__ = [
    "canonical_json",
    "first_object",
    "is_blank",
    "is_strict_json",
    "json_string",
    "parse_predictions",
    "render",
    "run_id",
    "strip_space",
    "template_is_supported",
    "template_parts",
    "utc_stamp",
]
