import json
import random

from pyspark.sql import functions as F

from tallyspark.functions.json_text import (
    canonical_json,
    is_blank,
    is_strict_json,
    json_string,
    strip_space,
)


def test_json_string_equals_ascii_json(spark):
    rng = random.Random(7)
    alphabet = '"\\/\b\f\n\r\t\x00\x01\x1f\x7f\x80 ~aZé ퟿￿\U0001f600\U0010ffff'
    texts = ["", "plain", alphabet] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(500)
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", json_string(F.col("t")).alias("j")).collect():
        assert row["j"] == json.dumps(row["t"])


def test_canonical_json_sorts_keys_and_keeps_nulls(spark):
    frame = spark.createDataFrame([("x", None)], "b string, a string")
    text = frame.select(canonical_json({"b": F.col("b"), "a": F.col("a")})).first()[0]
    assert text == json.dumps({"b": "x", "a": None}, sort_keys=True)


def test_space_is_unicode_space(spark):
    points = [p for p in range(1, 0x3100) if not 0xD800 <= p < 0xE000]
    frame = spark.createDataFrame([(p, chr(p)) for p in points], "p int, c string")
    padded = F.concat("c", F.lit("x \n x"), "c", "c")
    out = frame.select(
        "p", is_blank(F.col("c")).alias("blank"), strip_space(padded).alias("stripped")
    )
    for row in out.collect():
        char = chr(row["p"])
        assert row["blank"] == char.isspace(), row
        assert row["stripped"] == (char + "x \n x" + char * 2).strip(), row


def test_strict_json_is_one_whole_value(spark):
    texts = ["{}", "[1]", "1", '"a"', "null", " 1 ", "1,2", "1],[2", '1},{"r":2', '1,"x":2', "",
             " ", "{}]", "[]}", "{},{}", "'a'", "nul", "[1,]", '{"a":1}x']
    frame = spark.createDataFrame([(t,) for t in texts], "t string")

    def valid(text):
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    for row in frame.select("t", is_strict_json(F.col("t")).alias("ok")).collect():
        assert row["ok"] == valid(row["t"]), row
