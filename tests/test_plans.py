"""Shapes of physical plans that must not change by accident."""

import contextlib
import io
import os
import re

import pytest

from checks import queries, views
from tallyspark.operators import joins, metrics, scoring
from tallyspark.operators.gate import pair_runs
from tallyspark.sources.tables import read_table
from tests.test_gate import SCHEMA, run

FOLDER = "/root/testdata/sf0.001"
PYTHON_QUERIES = {"score_client", "prompt_files"}


def plan(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cross_joins_and_no_row_wise_python(spark, name):
    text = plan(queries.QUERIES[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in text
    assert ("MapInPandas" in text) == (name in PYTHON_QUERIES)


def test_scans_read_only_what_they_need(spark):
    summary = plan(queries.dataset_summary(spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", summary)
    assert sorted(schemas) == ["doc_id:bigint", "doc_id:bigint,quality:int,toxic:int"]
    log = plan(metrics.count_cells(views.event_predictions(spark, FOLDER), views.EVENT_TASK))
    assert re.findall(r"ReadSchema: struct<(.*?)>", log) == ["event_id:bigint,event_type:string"]


def test_predictions_are_counted_before_they_are_shuffled(spark):
    predictions = views.event_predictions(spark, FOLDER)
    text = plan(metrics.count_cells(predictions, views.EVENT_TASK))
    tree = text.split("\n\n")[0]
    assert tree.count("HashAggregate") == 4  # two count, and two more keep the result in one piece
    assert tree.count("Exchange") == 1  # for the counts; nothing is shuffled to read the table
    assert "Sort" not in tree


def test_a_large_lookup_shuffles_by_key_and_bucket(spark, monkeypatch):
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (0, 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        outputs = views.event_outputs(spark, FOLDER).drop("expected", "difficulty")
        text = plan(scoring.attach_examples(outputs, views.event_examples(spark, FOLDER)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"hashpartitioning\(id#\d+L, _bucket#\d+L", text)
    assert "SortMergeJoin" in text


@pytest.mark.parametrize("name", ["events", "documents"])
def test_reading_a_table_shuffles_nothing(spark, name):
    assert "Exchange" not in plan(read_table(spark, FOLDER, name))


def test_a_pair_needs_two_joins(spark):
    """Broadcast by the size measured when the query runs, not by a count before."""
    runs = spark.createDataFrame([run("a"), run("b")], SCHEMA)
    pairs = spark.createDataFrame([("a", "b")], "candidate string, baseline string")
    paired = pair_runs(pairs, runs)
    paired.collect()
    tree = paired._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert tree.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in tree


@pytest.mark.parametrize("name", ["slice_metrics", "run_summary", "gate_decisions", "validate_examples", "valid_examples"])
def test_no_files_are_written(spark, name):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    queries.QUERIES[name](spark, FOLDER).collect()
    assert set(os.listdir(folder)) == before
