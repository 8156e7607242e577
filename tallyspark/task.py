"""What is being evaluated: the label set, the response field and the slices."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

# Fixed value.
#: Column that collects every prediction outside the label set.
PARSE_FAILURE = "PARSE_FAILURE"
#: Name of the slice that holds all predictions of a run.
OVERALL = "overall"


@dataclass(frozen=True)
class TaskSpec:
    """A single-label classification task.

    Retargeting the engine means passing another ``TaskSpec``; no operator knows any label.
    """

    classes: tuple[str, ...]
    # The default response field and slices.
    response_key: str = "category"
    slices: tuple[str, ...] = ("easy", "hard")

    def __init__(
        self,
        classes: Iterable[str],
        response_key: str = "category",
        slices: Iterable[str] = ("easy", "hard"),
    ):
        labels = tuple(sorted(set(classes)))
        if not labels:
            raise ValueError("classes must not be empty")
        if PARSE_FAILURE in labels:
            raise ValueError(f"{PARSE_FAILURE!r} is reserved for unparseable outputs")
        if any(not label for label in labels):
            raise ValueError("class names must not be empty")
        slices = tuple(dict.fromkeys(slices))
        if OVERALL in slices:
            raise ValueError(f"{OVERALL!r} is always reported and must not be listed")
        object.__setattr__(self, "classes", labels)
        object.__setattr__(self, "response_key", response_key)
        object.__setattr__(self, "slices", slices)

    @property
    def outcomes(self) -> tuple[str, ...]:
        """Everything a prediction can be: the labels and the parse-failure column."""
        return self.classes + (PARSE_FAILURE,)

    @property
    def report_slices(self) -> tuple[str, ...]:
        return (OVERALL,) + self.slices


# The default task's labels and response field.
FEEDBACK_TASK = TaskSpec(
    classes=(
        "bug_report",
        "feature_request",
        "billing_issue",
        "ux_complaint",
        "performance_issue",
        "praise",
    ),
    response_key="category",
)

# USD per million tokens, model -> (input price, output price).
DEFAULT_PRICES = {"llama-3.3-70b-versatile": (0.59, 0.79)}
