"""What the operators leave on disk while they run, and what moves whole rows."""

import os
import random
import time

from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import ngram_join
from tallyspark.llm.shared import drop, shared_folder, stored
from tests.llm.conftest import SCHEMA, invented


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def left(spark, before: set[str]) -> set[str]:
    """Shuffle files that are new; they are deleted in the background."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def tables(spark) -> set[str]:
    folder = shared_folder(spark).removeprefix("file:")
    return {name for name in os.listdir(folder) if not name.startswith(".")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    frame = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = stored(frame, "kept")
    assert left(spark, before) == set()
    assert sorted(r.k for r in kept.collect()) == list(range(7))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    names = tables(spark)
    drop(kept)
    assert len(names - tables(spark)) == 1


def test_only_what_the_groups_read_stays(spark):
    rng = random.Random(21)
    text = invented(rng, 80)
    rows = [(k, text + f" {k // 2}" if k < 6 else invented(rng, 60), *[None] * 7) for k in range(12)]
    docs = spark.createDataFrame([(*r[:4], 0, *r[5:]) for r in rows], SCHEMA)
    files, names = shuffle_files(spark), tables(spark)
    found = ngram_join.similar_groups(docs)
    assert left(spark, files) == set()
    assert {n.rpartition("-")[0] for n in tables(spark) - names} <= {"facts", "members", "classes", "links"}
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(k, 0 if k < 6 else k) for k in range(12)]


def test_near_duplicates_leave_no_shuffle_files_behind_their_steps(spark, tmp_path):
    rng = random.Random(24)
    text = invented(rng, 700)
    rows = [(k, text if k < 3 else invented(rng, 650) + text[:300], "en", "s", 0) for k in range(9)] + [(None, text, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    files, names = shuffle_files(spark), tables(spark)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert left(spark, files) == set()
    assert {n.rpartition("-")[0] for n in tables(spark) - names} <= {"facts", "members", "classes", "links"}
    kept.write.parquet(str(tmp_path / "kept"))
    found = spark.read.parquet(str(tmp_path / "kept"))
    assert found.columns == docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in found.collect()) == [(False, 0), (True, 0), *((True, k) for k in range(3, 9))]


def test_long_rows_that_share_a_passage_are_not_compared_whole(spark):
    rng = random.Random(22)
    base, passage = invented(rng, 3_000).split(), invented(rng, 400).split()
    near = [f"new{k}" if k % 100 == 0 else w for k, w in enumerate(base)]
    grown = [*base, *invented(rng, 60).split()]  # across a power of two in size, or not, the halves fold
    texts = [base, near, grown, *([*invented(rng, 2_600 + 300 * k).split(), *passage] for k in range(3))]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    fields = ", ".join(f"{c} long" for c in ["doc_id", "n", "k1", "k2", *ngram_join._SKETCH])
    nodes = docs.mapInArrow(ngram_join._facts(5), f"{fields}, wide array<long>").withColumnRenamed("doc_id", "id")
    ids = spark.range(len(texts))
    pairs = ids.select(F.col("id").alias("a")).crossJoin(ids.select(F.col("id").alias("b"))).where("a < b")
    found = {(r.a, r.b) for r in ngram_join._within_parities(pairs, nodes, 80).collect()}
    assert found == {(0, 1), (0, 2), (1, 2)}


def test_parities_never_lose_a_link(spark):
    rng = random.Random(23)
    rows, sets = [], {}
    for k in range(24):
        size = rng.choice([600, 1_000, 1_030, 2_000, 2_100])
        rows.append((k, " ".join(f"w{(k // 8) * 500 + i + rng.randint(0, 1) * (rng.random() < 0.02)}" for i in range(size))))
        words = rows[-1][1].split()
        sets[k] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fields = ", ".join(f"{c} long" for c in ["doc_id", "n", "k1", "k2", *ngram_join._SKETCH])
    nodes = docs.mapInArrow(ngram_join._facts(5), f"{fields}, wide array<long>").withColumnRenamed("doc_id", "id")
    ids = spark.range(len(rows))
    pairs = ids.select(F.col("id").alias("a")).crossJoin(ids.select(F.col("id").alias("b"))).where("a < b")
    found = {(r.a, r.b) for r in ngram_join._within_parities(pairs, nodes, 80).collect()}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked and linked <= found
