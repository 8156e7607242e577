import hashlib
import json
import re

from tallyspark import schemas
from tallyspark.operators.fingerprint import dataset_fingerprint, prompt_registry
from tallyspark.operators.inspect import class_distribution, dataset_summary
from tallyspark.operators.validate import PROMPT_FIELDS
from tallyspark.task import TaskSpec

BASE = [
    ("a", "text one", "bug", "easy", None),
    ("b", "text two", "idea", "hard", "why"),
    ("c", "é", "bug", "easy", ""),
]


def fp(spark, rows):
    row = dataset_fingerprint(spark.createDataFrame(rows, schemas.EXAMPLES)).first()
    return row["fingerprint"]


def test_shape_and_independence_of_order_and_partitions(spark):
    first = fp(spark, BASE)
    assert re.fullmatch("[0-9a-f]{12}", first)
    assert fp(spark, BASE[::-1]) == first
    many = spark.createDataFrame(BASE, schemas.EXAMPLES).repartition(11)
    assert dataset_fingerprint(many).first()["fingerprint"] == first


def test_every_change_changes_it(spark):
    seen = {fp(spark, BASE)}
    changed = [
        [("a", "text one", "idea", "easy", None)] + BASE[1:],
        [("a", "text one", "bug", "easy", "")] + BASE[1:],
        BASE[:1] + [("b", "text two", "idea", "hard", "other")] + BASE[2:],
        [("at", "ext one", "bug", "easy", None)] + BASE[1:],
        BASE[:2],
        BASE + BASE[:1],
        BASE + BASE[:1] * 2,
        [],
    ]
    for rows in changed:
        seen.add(fp(spark, rows))
    assert len(seen) == len(changed) + 1


def test_groups_have_their_own(spark):
    frame = spark.createDataFrame([(g, *row) for g in ("x", "y") for row in BASE],
                                  "g string, id string, text string, label string,"
                                  "difficulty string, note string")
    got = {r["g"]: r["fingerprint"] for r in dataset_fingerprint(frame, by=["g"]).collect()}
    assert got == {"x": fp(spark, BASE), "y": fp(spark, BASE)}


def test_prompt_fingerprint_is_the_hash_of_canonical_json(spark):
    prompt = {
        "version": "v1",
        "parent": None,
        "changelog": 'é "quoted"',
        "system": "line\nline\t\U0001f600\x7f",
        "user_template": "F: {text}",
    }
    row = ("v1", None, list(PROMPT_FIELDS), *[prompt[name] for name in PROMPT_FIELDS])
    got = prompt_registry(spark.createDataFrame([row], schemas.PROMPT_SOURCE)).first()
    text = json.dumps(prompt, sort_keys=True)
    assert got["fingerprint"] == hashlib.sha256(text.encode()).hexdigest()[:12]


def test_distribution_and_summary(spark, rows):
    frame = spark.createDataFrame(BASE, schemas.EXAMPLES)
    assert [tuple(r) for r in class_distribution(frame).collect()] == [("bug", 2), ("idea", 1)]
    task = TaskSpec(["bug", "idea"])
    assert rows(dataset_summary(frame, task)) == [(3, 2, 1)]
    assert rows(dataset_summary(frame.limit(0), task)) == [(0, 0, 0)]
