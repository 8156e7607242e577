"""Answers that are paid for are asked once, whatever happens to the job."""

import os
from typing import NamedTuple

import pytest

from tallyspark import schemas
from tallyspark.sources.answers import score_and_store, stored_answers, unanswered


class Reply(NamedTuple):
    content: str
    prompt_tokens: int
    completion_tokens: int


class Logging:
    """Notes every question in a file; fails at one text as long as a marker file exists."""

    def __init__(self, folder, fatal=None):
        self.folder, self.fatal = folder, fatal

    def complete(self, *, system, user, model, temperature, max_tokens):
        if user == self.fatal and os.path.exists(f"{self.folder}/broken"):
            raise RuntimeError("the service is down")
        descriptor = os.open(f"{self.folder}/asked", os.O_APPEND | os.O_CREAT | os.O_WRONLY)
        os.write(descriptor, f"{user}\n".encode())
        os.close(descriptor)
        return Reply(f"re {user}", len(user), 2)


def rendered(spark, n, first=0):
    rows = [(f"v{k % 2}", f"e{k}", 1, "s", f"text {k}") for k in range(first, n)]
    return spark.createDataFrame(rows, "run_id string, id string, repeat int, system string, user string").repartition(3)


def asked(folder):
    with open(f"{folder}/asked", encoding="utf-8") as file:
        return sorted(file.read().split("\n")[:-1])


@pytest.mark.parametrize("options", [{"keys_per_commit": 2}, {"max_workers": 4}])
def test_a_killed_job_asks_each_key_once(spark, tmp_path, options):
    folder, calls = str(tmp_path / "answers"), str(tmp_path)
    (tmp_path / "broken").write_text("")
    inputs = rendered(spark, 40)
    with pytest.raises(Exception, match="the service is down"):
        score_and_store(inputs, lambda: Logging(calls, "text 17"), "m", folder, **options)
    (tmp_path / "broken").unlink()
    kept = {r["content"] for r in stored_answers(spark, folder).collect()}
    # Finished tasks are committed although the job failed; four large ones may all have been running.
    assert (0 if "max_workers" in options else 1) <= len(kept) < 40
    before = asked(calls)
    assert unanswered(inputs, folder) == 40 - len(kept)

    found = score_and_store(inputs, lambda: Logging(calls), "m", folder, **options)
    assert sorted((r["run_id"], r["id"], r["content"]) for r in found.collect()) == sorted(
        (f"v{k % 2}", f"e{k}", f"re text {k}") for k in range(40)
    )
    # Committed keys were not asked again; only the failed task's own questions are lost.
    again = asked(calls)[:]
    for question in before:
        again.remove(question)
    assert not {f"re {q}" for q in again} & kept
    assert len(again) == 40 - len(kept) and unanswered(inputs, folder) == 0

    score_and_store(inputs, lambda: Logging(calls, "never"), "m", folder, **options)
    assert len(asked(calls)) == len(before) + len(again)


def test_more_inputs_ask_only_for_themselves(spark, tmp_path):
    folder, calls = str(tmp_path / "answers"), str(tmp_path)
    score_and_store(rendered(spark, 6), lambda: Logging(calls), "m", folder)
    found = score_and_store(rendered(spark, 9, 4), lambda: Logging(calls), "m", folder)
    assert sorted(r["id"] for r in found.collect()) == ["e4", "e5", "e6", "e7", "e8"]
    assert asked(calls) == sorted(f"text {k}" for k in range(9))
    assert found.columns == schemas.COMPLETIONS.names


def test_nothing_to_ask(spark, tmp_path):
    found = score_and_store(rendered(spark, 0), lambda: Logging(str(tmp_path)), "m", str(tmp_path / "a"))
    assert found.isEmpty() and not os.path.exists(tmp_path / "asked")
