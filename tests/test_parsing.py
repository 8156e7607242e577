"""The parser against a plain statement of its contract."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.parsing import parse_predictions
from tallyspark.task import PARSE_FAILURE, TaskSpec

TASK = TaskSpec(["bug", "praise", "5", "a b", "é"], response_key="category")

CASES = [
    ('{"category": "bug"}', "bug"),
    (' \t\r\n{ "category" :\n"bug" } ', "bug"),
    ('Sure:\n{"category": "praise"}\nbye', "praise"),
    ("not json at all", PARSE_FAILURE),
    ('{"category": "other"}', PARSE_FAILURE),
    ('["bug"]', PARSE_FAILURE),
    ('"bug"', PARSE_FAILURE),
    ('{"label": "bug"}', PARSE_FAILURE),
    ('{"Category": "bug"}', PARSE_FAILURE),
    ('{"category": 5}', PARSE_FAILURE),
    ('{"category": "5"}', "5"),
    ('{"category": ["bug"]}', PARSE_FAILURE),
    ('{"category": null}', PARSE_FAILURE),
    ('{"category": "x", "category": "bug"}', "bug"),
    ('{"category": "bug", "category": 1}', PARSE_FAILURE),
    ('{"a": {"b": 1}, "category": "bug"}', "bug"),
    ('{"a": {"b": 1}, "category": "bug"} tail', PARSE_FAILURE),
    ('{"a": {"k": 1, "k": 2}, "category": "bug"}', "bug"),
    ("{'category': 'bug'}", PARSE_FAILURE),
    ('{"n": NaN, "category": "bug"}', "bug"),
    ('{"n": -Infinity, "category": "bug"}', "bug"),
    ('{"n": -INF, "category": "bug"}', PARSE_FAILURE),
    ('{"n": +Infinity, "category": "bug"}', PARSE_FAILURE),
    ('{"n": "-INF", "category": "bug"}', "bug"),
    ('{"n": "\\"-INF", "category": "bug"}', "bug"),
    ('{"n": 01, "category": "bug"}', PARSE_FAILURE),
    ('{"category": "bug",}', PARSE_FAILURE),
    ('{"category": "b\\u0075g"}', "bug"),
    ('{"category": "\\u00e9"}', "é"),
    ('{"c\\u0061tegory": "bug"}', "bug"),
    ('{"category": "a b"}', "a b"),
    ('{"category": "bug\n"}', PARSE_FAILURE),
    ('{"x": "\n", "category": "bug"}', PARSE_FAILURE),
    ('﻿{"category": "bug"}', "bug"),
    ('```json\n{"category": "bug"}\n```', "bug"),
    ('{"category": "bug"}{"category": "praise"}', "bug"),
    ('{"category": "bug"}]', "bug"),
    ('["{\\"category\\": 1}", {"category": "bug"}]', PARSE_FAILURE),
    ("null", PARSE_FAILURE),
    (" null ", PARSE_FAILURE),
    ("true", PARSE_FAILURE),
    ("{}", PARSE_FAILURE),
    ("", PARSE_FAILURE),
    ("}{", PARSE_FAILURE),
    ('1 {"category": "bug"}', "bug"),
    ('null {"category": "bug"}', "bug"),
    ('{"category": "bug"} ', "bug"),
    ('{"category": "bug"} ', "bug"),
]


def contract(raw, task=TASK):
    """Whole text as JSON; failing that (or on null) the first block; then a known string."""

    def load(text):
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return None

    value = load(raw)
    if value is None:
        block = re.search(r"\{.*?\}", raw, re.S)
        value = load(block[0]) if block else None
    label = value.get(task.response_key) if isinstance(value, dict) else None
    return label if isinstance(label, str) and label in task.classes else PARSE_FAILURE


def parsed(spark, texts, task=TASK):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw_output string")
    out = parse_predictions(frame, task).orderBy("i").collect()
    return [row["predicted"] for row in out]


def test_known_cases(spark):
    texts = [text for text, _ in CASES]
    want = [label for _, label in CASES]
    assert [contract(text) for text in texts] == want
    assert parsed(spark, texts) == want


def test_null_output_is_a_failure(spark):
    assert parsed(spark, [None, ""]) == [PARSE_FAILURE] * 2


def _random_text(rng):
    pieces = [
        '{"category": "bug"}', '{"category":"praise"}', "{", "}", "[", "]", '"', "'", ":", ",",
        '"category"', '"bug"', '"praise"', "null", "true", "NaN", "Infinity", "-Infinity", "-INF",
        "+INF", "1", "-0", "1e5", "01", ".5", "\\", "\\n", "\n", "\t", " ", " ", "﻿",
        "text", "é", "\U0001f600", '{"a":', '"x":1', '"category":5', '{"r":', "\\u0041",
        "\\ud83d", "/*c*/", "//", "#", "\x01", "\x7f", "0x1", "1.", "None",
    ]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(1, 9)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts_match_the_contract(spark, seed):
    rng = random.Random(seed)
    texts = sorted({_random_text(rng) for _ in range(8000)})
    got = parsed(spark, texts)
    wrong = [(t, g, contract(t)) for t, g in zip(texts, got) if g != contract(t)]
    assert wrong == []


def test_random_mutations_of_good_answers(spark):
    rng = random.Random(4)
    texts = set()
    for _ in range(8000):
        text = list(rng.choice(CASES)[0] or "{}")
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(text) + 1)
            if text and rng.random() < 0.5:
                text.pop(min(at, len(text) - 1))
            else:
                text.insert(at, rng.choice('{}[]":,\\ \n\'0-eNI'))
        texts.add("".join(text))
    texts = sorted(texts)
    got = parsed(spark, texts)
    wrong = [(t, g, contract(t)) for t, g in zip(texts, got) if g != contract(t)]
    assert wrong == []


@pytest.mark.parametrize("key", ["label", "the key", 'quo"te', "back\\slash", "é", "a.b", "`x`"])
def test_response_key_is_a_parameter(spark, key):
    task = TaskSpec(["bug"], response_key=key)
    texts = [json.dumps({key: "bug"}), "So: " + json.dumps({key: "bug"}, ensure_ascii=False)]
    texts.append(json.dumps({"o": 1, key: "bug"}))
    assert parsed(spark, texts, task) == ["bug"] * 3


def test_long_texts_are_read_to_the_end(spark):
    filler = "lorem \\\" ipsum " * 50_000
    texts = [
        "prose " * 200_000 + '{"category": "bug"}',
        '{"why": "' + filler + '", "category": "bug"}',
        '{"why": "-INF ' + filler + '", "category": "bug"}',
    ]
    assert parsed(spark, texts) == ["bug"] * 3


def test_every_class_round_trips(spark):
    frame = spark.createDataFrame([(c,) for c in TASK.classes], "c string")
    raw = frame.withColumn("raw_output", F.to_json(F.struct(F.col("c").alias("category"))))
    out = parse_predictions(raw, TASK)
    assert out.columns == ["c", "raw_output", "predicted"]
    assert out.where("predicted <> c").count() == 0


@pytest.mark.parametrize("depth", [900, 1200, 100_000])
def test_any_depth_of_nesting(spark, depth):
    """Deep values beside the answer, before or after it, in the whole output or in an array."""
    deep = '{"a":' * depth + "1" + "}" * depth
    cases = {
        '{"category": "a", "x": ' + deep + "}": "a",
        '{"x": ' + deep + ', "category": "b"}': "b",
        '{"category": "b", "x": ' + deep + ', "category": "a"}': "a",
        '{"category": ' + deep + "}": PARSE_FAILURE,
        '{"x": ' + deep + ', "category": 5}': PARSE_FAILURE,
        '{"x": ' + deep + ', "category": ["a"]}': PARSE_FAILURE,
        '{"x": ' + deep + ', "category": null}': PARSE_FAILURE,
        '{"x": ' + deep + ', "category": true}': PARSE_FAILURE,
        '{"category": "a", "x": ' + deep: PARSE_FAILURE,
        "[" * depth + '{"category": "a"}' + "]" * depth: PARSE_FAILURE,  # one valid value, not an object
        "[" * depth + '{"category": "a"}' + "]" * (depth - 1): "a",  # not valid, so the block counts
        '{"category": "a", "x": ' + deep + "} tail": PARSE_FAILURE,
    }
    task = TaskSpec(("5", "a", "b", "true"))
    frame = spark.createDataFrame([(k, raw) for k, raw in enumerate(cases)], "k int, raw_output string")
    got = {r["k"]: r["predicted"] for r in parse_predictions(frame, task).select("k", "predicted").collect()}
    assert [got[k] for k in range(len(cases))] == list(cases.values())
