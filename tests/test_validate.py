import json
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.validate import (
    duplicate_ids,
    first_violation,
    valid_examples,
    validate_examples,
)
from tallyspark.sources.examples import load_examples, scan_examples, scan_lines
from tallyspark.task import TaskSpec

TASK = TaskSpec(["bug", "idea"])


def good(number, **changes):
    row = {"id": f"e{number}", "text": "It broke.", "label": "bug", "difficulty": "easy"}
    row.update(changes)
    return {key: value for key, value in row.items() if value is not ...}


def write(path, lines):
    text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    path.write_text("\n".join(text) + "\n", encoding="utf-8")
    return str(path)


def test_good_lines_become_examples(spark, tmp_path):
    lines = [good(1), good(2, note="why", extra=1), "", good(3, label="idea", difficulty="hard")]
    frame = load_examples(spark, write(tmp_path / "d.jsonl", lines), TASK).orderBy("line_no")
    got = [(r["line_no"], r["id"], r["label"], r["difficulty"], r["note"]) for r in frame.collect()]
    assert got == [
        (1, "e1", "bug", "easy", None),
        (2, "e2", "bug", "easy", "why"),
        (4, "e3", "idea", "hard", None),
    ]


BAD = [
    (lambda k: good(k + "1"), "duplicate id", "e{}1"),
    (lambda k: good(k + "9", label="other"), "unknown label", "other"),
    (lambda k: good(k + "9", label=None), "unknown label", None),
    (lambda k: good(k + "9", text=""), "empty text", None),
    (lambda k: good(k + "9", text="  \t　"), "empty text", None),
    (lambda k: good(k + "9", text=None), "empty text", None),
    (lambda k: good(k + "9", difficulty="medium"), "invalid difficulty", "medium"),
    (lambda k: good(k + "9", label=...), "missing field", "label"),
    (lambda k: good(k + "9", id=..., difficulty=...), "missing field", "id, difficulty"),
    (lambda k: good(k + "9", text=5), "wrong type", "text"),
    (lambda k: good(k + "9", id=None), "wrong type", "id"),
    (lambda k: good(k + "9", label=["b"], difficulty={}), "wrong type", "label, difficulty"),
    (lambda k: "{not json", "invalid JSON", None),
    (lambda k: "{'id': 'x'}", "invalid JSON", None),
    (lambda k: json.dumps(good(k + "9")) + " tail", "invalid JSON", None),
    (lambda k: json.dumps(good(k + "9")) + "," + json.dumps(good(k + "8")), "invalid JSON", None),
    (lambda k: '{"n": -INF, ' + json.dumps(good(k + "9"))[1:], "invalid JSON", None),
    (lambda k: "[1]", "not a JSON object", None),
    (lambda k: "null", "not a JSON object", None),
]


def test_first_bad_line_of_each_file_is_named(spark, tmp_path):
    for number, (bad, _, _) in enumerate(BAD):
        k = f"k{number}-"
        lines = [good(k + "1"), "   ", good(k + "2"), bad(k), "{later error"]
        write(tmp_path / f"{number:02d}.jsonl", lines)
    decoded = scan_examples(spark, str(tmp_path))
    got = first_violation(validate_examples(decoded, TASK)).orderBy("file").collect()
    assert len(got) == len(BAD)
    for number, (row, (_, violation, detail)) in enumerate(zip(got, BAD)):
        detail = detail and detail.format(f"k{number}-")
        assert (row["line_no"], row["violation"], row["detail"]) == (4, violation, detail)


def test_loading_fails_at_the_first_bad_line(spark, tmp_path):
    path = write(tmp_path / "d.jsonl", [good(1), "", good(1), "{"])
    with pytest.raises(ValueError, match=r"line 3: duplicate id \(e1\)"):
        load_examples(spark, path, TASK)


def test_precedence_within_a_line(spark, tmp_path):
    lines = [good(1), good(1, label="x", text="", difficulty="y"), good(2, label="x", text=""),
             good(3, text="", difficulty="y")]
    decoded = scan_examples(spark, write(tmp_path / "d.jsonl", lines))
    got = validate_examples(decoded, TASK).orderBy("line_no").collect()
    assert [r["violation"] for r in got] == ["duplicate id", "unknown label", "empty text"]


def test_surrounding_unicode_space_is_ignored(spark, tmp_path):
    path = write(tmp_path / "d.jsonl", [" " + json.dumps(good(1)) + "　 "])
    assert load_examples(spark, path, TASK).count() == 1


def test_last_of_repeated_keys_wins(spark, tmp_path):
    line = json.dumps(good(1))[:-1] + ', "label": "idea"}'
    assert load_examples(spark, write(tmp_path / "d.jsonl", [line]), TASK).first()["label"] == "idea"


def test_line_numbers_across_splits_and_files(spark, tmp_path):
    rng = random.Random(5)
    want = {}
    for name in ("a.jsonl", "b.jsonl"):
        lines = ["" if rng.random() < 0.1 else "x" * rng.randint(1, 60) for _ in range(3000)]
        lines = [f"{n}:{line}" if line else "" for n, line in enumerate(lines, 1)]
        write(tmp_path / name, lines)
        want[name] = lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        frame = scan_lines(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() > 10
        got = frame.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 6000
    for row in got:
        name = row["file"].rsplit("/", 1)[1]
        assert want[name][row["line_no"] - 1] == row["raw"]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_duplicates_with_one_hot_id(spark, threshold):
    ids = [None] * 50 + ["hot"] * 200 + [f"n{i}" for i in range(100)] + ["twice", "twice"]
    random.Random(1).shuffle(ids)
    frame = spark.createDataFrame(
        [("f", n, i) for n, i in enumerate(ids, 1)], "file string, line_no long, id string"
    ).repartition(7)
    seen, want = set(), []
    for number, name in enumerate(ids, 1):
        if name is not None and name in seen:
            want.append((number, name))
        seen.add(name)
    # Broadcast to the rows where the repeated ids are few, or met by a shuffle.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = duplicate_ids(frame).orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r["line_no"], r["id"]) for r in got] == want


def test_bulk_mode_reports_everything(spark, tmp_path):
    lines = [good(1), good(1), good(1), "{", good(2, label="x"), good(3)]
    decoded = scan_examples(spark, write(tmp_path / "d.jsonl", lines))
    bad = validate_examples(decoded, TASK).orderBy("line_no").collect()
    assert [r["line_no"] for r in bad] == [2, 3, 4, 5]
    assert sorted(r["id"] for r in valid_examples(decoded, TASK).collect()) == ["e1", "e3"]


def test_text_is_kept_whole(spark, tmp_path):
    text = "long é\n\t" * 50_000
    path = write(tmp_path / "d.jsonl", [good(1, text=text)])
    assert load_examples(spark, path, TASK).select(F.col("text")).first()[0] == text
