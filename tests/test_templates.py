import random

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.templates import render, template_is_supported, template_parts




def test_rendering_equals_format(spark):
    rng = random.Random(3)
    pieces = ["{text}", "{{", "}}", "a", " ", "\n", "é", "text", "'"]
    templates = {"".join(rng.choice(pieces) for _ in range(rng.randint(1, 8))) for _ in range(400)}
    value = "in {text} {{x}} $1 \\1 {"
    frame = spark.createDataFrame([(t,) for t in templates], "t string")
    out = frame.select(
        "t",
        template_is_supported(F.col("t")).alias("ok"),
        render(template_parts(F.col("t")), F.lit(value)).alias("user"),
    )
    for row in out.collect():
        assert row["ok"], row
        assert row["user"] == row["t"].format(text=value), row


@pytest.mark.parametrize(
    "template", ["{", "}", "{}", "{name}", "{text!r}", "{text:>9}", "{{text}", "{ text }", "{text"]
)
def test_other_placeholders_are_not_supported(spark, template):
    frame = spark.createDataFrame([(template,)], "t string")
    assert not frame.select(template_is_supported(F.col("t"))).first()[0]


def test_template_without_placeholder_is_constant(spark):
    frame = spark.createDataFrame([("just this",), ("",)], "t string")
    out = frame.select(render(template_parts(F.col("t")), F.lit("x"))).collect()
    assert [row[0] for row in out] == ["just this", ""]
