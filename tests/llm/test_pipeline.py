"""The pipeline against plain versions of its stages, each on its own input."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyspark.llm import pii
from tests.llm.test_groups import norm, plain_groups
from tests.llm.test_rows import plain_base, plain_quality, plain_targets

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Input rows of every stage, and the last stage's result."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns(results):
    for frame in results[1:-1]:
        assert frame.columns == results[0].columns
        assert frame.where("n_chars <> length(text)").isEmpty()


def test_quality_stage(results):
    before, after = texts(results[0]), texts(results[1])
    assert set(after) == {d for d, t in before.items() if plain_quality(t)[-1]}
    for d, text in after.items():
        lost = plain_quality(before[d])[5]
        assert len(text.split()) == len(before[d].split()) - lost


def test_near_duplicate_stage(results):
    before, after = texts(results[1]), texts(results[2])
    groups = plain_groups(list(before.items()))
    assert set(after) == {d for d, (_, root) in groups.items() if d == root}
    assert after == {d: before[d] for d in after}


def test_decontamination_stage(spark, results):
    items = [norm(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + min(13, len(w))]) for w in items for i in range(max(len(w) - 12, 1)) if w}
    before, after = texts(results[2]), texts(results[3])
    bad = set()
    for d, text in before.items():
        w, hit = norm(text), set()
        for k in {len(g) for g in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
        if hit and 20 * len(hit) >= len(w):
            bad.add(d)
    assert after == {d: t for d, t in before.items() if d not in bad}


def test_personal_data_stage(results):
    before, after = texts(results[3]), texts(results[4])
    assert set(before) == set(after)
    for d, text in before.items():
        for kind, start, end in plain_base(text):
            assert text[start:end] not in after[d] and pii.MASKS[kind] in after[d]
        if not any(c.isdigit() or c == "@" for c in text):
            assert after[d] == text


def test_mixing_stage(results):
    mixed = results[5].collect()
    sizes = {}
    sources = {r.doc_id: (r.source, len(r.text.split())) for r in results[4].collect()}
    assert sorted(r.doc_id for r in mixed) == sorted(sources)
    for source, size in sources.values():
        sizes[source] = sizes.get(source, 0) + size
    want, taken = plain_targets(sizes), dict.fromkeys(sizes, 0)
    for r in mixed:
        assert (r.source, r.size) == sources[r.doc_id]
        assert r.target == pytest.approx(want[r.source]) and r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    largest = max(size for _, size in sources.values())
    assert all(abs(taken[s] - want[s]) <= largest for s in sizes)


def test_run_equals_its_stages(spark, results):
    rows = entry.queries()["pipeline"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, results[-1].collect()))


def test_stages_of_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{docs.count()}")
            stage(spark, docs, FOLDER).write.parquet(path)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert spark.read.parquet(path).columns == odd_docs.columns
