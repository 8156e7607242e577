"""Pointer commits by several writers."""

import datetime as dt
import threading

import pytest

from tallyspark import schemas
from tallyspark.sources.folders import put_if_absent
from tallyspark.sources.pointer_log import PointerConflict, PointerLog
from tallyspark.sources.run_store import RunStore

START = dt.datetime(2024, 1, 1)


def moves(spark, *chains, run="r"):
    rows = [(chain, f"{run}-{chain}", "v1", START + dt.timedelta(minutes=k)) for k, chain in enumerate(chains)]
    return spark.createDataFrame(rows, schemas.BASELINE_POINTER)


@pytest.fixture(params=["", "file://"])
def log(request, spark, tmp_path):
    return PointerLog(spark, f"{request.param}{tmp_path}/with space/pointers")


def test_an_empty_log(log):
    assert log.version() == 0 and log.moves().isEmpty()


def test_of_two_writers_of_a_chain_one_wins(spark, log):
    seen = log.version()
    assert log.commit(moves(spark, "a", run="x"), seen) == 1
    with pytest.raises(PointerConflict):
        log.commit(moves(spark, "a", "b", run="y"), seen)
    # What the loser has written is not read, and after looking again it may move the chain.
    assert [r["run_id"] for r in log.moves().collect()] == ["x-a"]
    assert log.commit(moves(spark, "a", "b", run="y"), log.version()) == 2
    assert sorted(tuple(r)[::4] for r in log.moves().collect()) == [("a", 1), ("a", 2), ("b", 2)]


def test_other_chains_do_not_conflict(spark, log):
    seen = log.version()
    assert log.commit(moves(spark, "a"), seen) == 1
    assert log.commit(moves(spark, "b", "c"), seen) == 2
    assert log.commit(moves(spark, "a")) == 3  # nothing was read, nothing can conflict
    assert {r["chain"] for r in log.moves(after=1).collect()} == {"a", "b", "c"}


def test_many_writers_at_once(spark, log):
    versions = []
    threads = [threading.Thread(target=lambda k=k: versions.append(log.commit(moves(spark, f"c{k}"), 0))) for k in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(versions) == [1, 2, 3, 4, 5, 6] and log.version() == 6
    assert sorted(r["chain"] for r in log.moves().collect()) == [f"c{k}" for k in range(6)]


def test_one_writer_creates_a_file(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    done = []
    threads = [threading.Thread(target=lambda k=k: done.append(put_if_absent(spark, path, {"k": k}))) for k in range(20)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(done) == [False] * 19 + [True]
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == ["1.json"]


def test_the_store_keeps_the_newest(spark, tmp_path):
    store = RunStore(spark, str(tmp_path))
    assert store.pointer("a") is None
    store.move_baselines(moves(spark, "x", "a", run="first"))
    later = moves(spark, "y", "z", "a", run="second")
    store.move_baselines(later, store.pointer_log.version())
    assert store.baseline("a") == ("v1", "second-a")
    # Imported out of order, the time of the decision counts.
    store.move_baselines(moves(spark, "a", run="old"))
    assert store.baseline("a") == ("v1", "second-a")
