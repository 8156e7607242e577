"""Results that several readers share are computed once, and nothing stays behind."""

import re

import pytest

from checks import queries
from tallyspark.operators.sharing import local_copy, one_pass

FOLDER = "/root/testdata/sf0.001"
#: Query, and the number of tables it reads (documents and labels, events, or events and its fingerprint).
SHARED = {
    "slice_metrics": 1,
    "class_metrics": 1,
    "run_summary": 2,
    "gate_decisions": 2,
    "duplicate_ids": 2,
    "validate_examples": 2,
}


def final_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(SHARED))
def test_a_query_reads_its_source_once(spark, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    frame.collect()
    plan = final_plan(frame)
    assert len(re.findall(r"FileScan parquet", plan)) == SHARED[name]
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_nothing_stays_persisted(spark, name):
    queries.QUERIES[name](spark, FOLDER).collect()
    assert spark._jsc.getPersistentRDDs().size() == 0


def test_one_pass_keeps_the_rows(spark, rows):
    frame = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "a int, b string")
    assert rows(one_pass(frame)) == rows(frame)


def test_local_copy_is_bounded(spark, rows):
    frame = spark.createDataFrame([(k, [k], {"k": float(k)}) for k in range(5)], "a int, b array<int>, c map<string,double>")
    assert rows(local_copy(frame, 5)) == rows(frame)
    assert local_copy(frame, 4) is None
    assert local_copy(frame.where("a < 0"), 4).isEmpty()
