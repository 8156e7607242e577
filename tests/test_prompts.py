import hashlib
import json

import pytest

from tallyspark.operators.validate import prompt_violations
from tallyspark.sources.prompts import (
    list_versions,
    load_prompt,
    load_prompts,
    scan_prompts,
)

GOOD = """\
version: v1
parent: null
changelog: "first é"
system: |
  Answer with {"category": "<label>"}.
user_template: |
  Feedback: {text}
"""


def test_a_good_prompt(spark, tmp_path):
    (tmp_path / "v1.yaml").write_text(GOOD, encoding="utf-8")
    row = load_prompt(spark, str(tmp_path), "v1").first()
    content = {
        "version": "v1",
        "parent": None,
        "changelog": "first é",
        "system": 'Answer with {"category": "<label>"}.\n',
        "user_template": "Feedback: {text}\n",
    }
    assert {name: row[name] for name in content} == content
    assert row["parts"] == ["Feedback: ", "\n"]
    text = json.dumps(content, sort_keys=True)
    assert row["fingerprint"] == hashlib.sha256(text.encode()).hexdigest()[:12]


def test_key_order_does_not_matter_and_content_does(spark, tmp_path):
    lines = GOOD.splitlines(keepends=True)
    for name, text in {
        "a": GOOD,
        "b": "".join(lines[3:] + lines[:3]),
        "c": GOOD.replace("Feedback", "Customer"),
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "v1.yaml").write_text(text, encoding="utf-8")
    a, b, c = (load_prompts(spark, str(tmp_path / n)).first()["fingerprint"] for n in "abc")
    assert a == b != c


def test_violations(spark, tmp_path):
    bad = {
        "broken": "version: v1\n  parent: [unbalanced\n",
        "list": "- not\n- a mapping\n",
        "scalar": "text",
        "few": "version: few\nparent: null\nchangelog: x\n",
        "blank": GOOD.replace("v1", "blank").replace("Feedback: {text}", "   "),
        "nulls": "version: nulls\nparent: null\nchangelog:\nsystem: s\nuser_template: t\n",
        "parent": GOOD.replace("v1", "parent").replace("null", "' '"),
        "stem": GOOD,
        "place": GOOD.replace("v1", "place").replace("{text}", "{name}"),
    }
    for name, text in bad.items():
        (tmp_path / f"{name}.yaml").write_text(text, encoding="utf-8")
    (tmp_path / "v1.yaml").write_text(GOOD, encoding="utf-8")
    (tmp_path / "README.md").write_text("not a prompt", encoding="utf-8")
    frame = scan_prompts(spark, str(tmp_path))
    got = {r["stem"]: (r["violation"], r["detail"]) for r in prompt_violations(frame).collect()}
    assert got == {
        "broken": ("invalid YAML", None),
        "list": ("not a YAML mapping", None),
        "scalar": ("not a YAML mapping", None),
        "few": ("missing field", "system, user_template"),
        "blank": ("empty field", "user_template"),
        "nulls": ("empty field", "changelog"),
        "parent": ("empty field", "parent"),
        "stem": ("version does not match file name", "v1"),
        "place": ("unsupported placeholder", None),
    }
    assert [r["version"] for r in load_prompts(spark, str(tmp_path)).collect()] == ["v1"]
    with pytest.raises(ValueError, match="stem.yaml: version does not match"):
        load_prompt(spark, str(tmp_path), "stem")
    with pytest.raises(FileNotFoundError, match="nope"):
        load_prompt(spark, str(tmp_path), "nope")


def test_listing_is_sorted_and_survives_absence(spark, tmp_path):
    for name in ("v3", "v1", "v 2", "a+b", "p%41"):
        (tmp_path / f"{name}.yaml").write_text(GOOD, encoding="utf-8")
    (tmp_path / "v9.txt").write_text("no", encoding="utf-8")
    got = [r["version"] for r in list_versions(spark, str(tmp_path)).collect()]
    assert got == ["a+b", "p%41", "v 2", "v1", "v3"]
    assert list_versions(spark, str(tmp_path / "absent")).count() == 0
    (tmp_path / "none").mkdir()
    assert list_versions(spark, str(tmp_path / "none")).count() == 0
