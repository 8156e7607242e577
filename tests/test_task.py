import pytest

from tallyspark.task import FEEDBACK_TASK, TaskSpec


def test_classes_are_a_sorted_set():
    assert TaskSpec(["b", "a", "b"]).classes == ("a", "b")
    assert TaskSpec(["a"]).outcomes == ("a", "PARSE_FAILURE")


@pytest.mark.parametrize("classes", [[], ["a", "PARSE_FAILURE"], ["a", ""]])
def test_bad_class_sets_are_rejected(classes):
    with pytest.raises(ValueError):
        TaskSpec(classes)


def test_overall_is_not_a_slice_of_its_own():
    with pytest.raises(ValueError):
        TaskSpec(["a"], slices=["overall"])


def test_default_task():
    assert len(FEEDBACK_TASK.classes) == 6
    assert FEEDBACK_TASK.response_key == "category"
    assert FEEDBACK_TASK.report_slices == ("overall", "easy", "hard")
