import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(docs, items, top=10):
    """Every document scored by the stated formula."""
    words = [(i, terms(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, total = len(words), sum(len(w) for _, w in words)
    out = []
    for item, text in items:
        scored = []
        for i, w in words:
            m = 25 + (75 * len(w) * n_docs) // total
            score = 0
            for term in terms(text):
                tf = w.count(term)
                if tf:
                    df = sum(term in x for _, x in words)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


ITEMS = [
    (1, "the and of to a in"),
    (1, "the and of to a in"),  # a repeated row
    (1, "another text of the same id: for with MORE"),
    (2, None),
    (3, "  !? "),
    (4, "Ünï wörd the the the"),
    (None, "ab on an was"),
    (5, "nowhereatall"),
    (6, "changed end more one two three four"),
]
ITEM_SCHEMA = "item_id long, text string, doc_id string, n string, score string, rank string"


def items_frame(spark, items):
    return spark.createDataFrame([(*row, "d", "n", "s", "r") for row in items], ITEM_SCHEMA)


@pytest.mark.parametrize("block_bytes", [ls.BLOCK_BYTES, 40])
def test_search_equals_plain(spark, odd_rows, odd_docs, monkeypatch, block_bytes):
    monkeypatch.setattr(ls, "BLOCK_BYTES", block_bytes)
    assert found(ls.search(odd_docs, items_frame(spark, ITEMS), 4)) == plain([(r[0], r[1]) for r in odd_rows], ITEMS, 4)


def test_batches_and_pieces_change_nothing(spark, odd_rows, odd_docs, monkeypatch):
    monkeypatch.setattr(ls, "PIECE", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found(ls.search(odd_docs, items_frame(spark, ITEMS), 3)) == plain([(r[0], r[1]) for r in odd_rows], ITEMS, 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nothing_to_search(spark, odd_docs, no_docs):
    assert found(ls.search(no_docs, items_frame(spark, ITEMS))) == []
    assert found(ls.search(odd_docs, items_frame(spark, []))) == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert found(ls.search(blank, items_frame(spark, ITEMS))) == []


def batch_of(rng, size, words):
    rows = [sorted(rng.sample(range(words), rng.randint(0, words))) for _ in range(size)]
    # Low numbers are rare.
    rows = [[t for t in row if rng.random() < (t + 1) / words] for row in rows]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(size), pa.int64()),
            pa.array([5 + len(r) for r in rows], pa.int64()),
            pa.array(rows, pa.list_(pa.int32())),
            pa.array([[rng.randint(1, 3) for _ in r] for r in rows], pa.list_(pa.int64())),
        ],
        ["doc_id", "n", "terms", "counts"],
    ), rows


def test_limited_accumulators_keep_the_best_exactly():
    rng = random.Random(5)
    limited = 0
    for _ in range(200):
        batch, rows = batch_of(rng, 60, 12)
        postings = ls.Postings(batch, 60, 600)
        query = ls.Query(list(range(12)), [max(1, 5000 >> k) for k in range(12)])
        score = np.zeros(60, np.int64)
        for weight, term in zip(query.weights, query.terms, strict=True):
            at = postings.find([term])[0]
            if at >= 0:
                cut = slice(postings.starts[at], postings.ends[at])
                score[postings.rows[cut]] += postings.impacts[cut] * weight
        top = rng.choice([1, 3, 10])
        got, scores, made = ls.best_rows(postings, query, top)
        want = sorted(((-s, r) for r, s in enumerate(score) if s > 0))[:top]
        assert sorted((-s, r) for r, s in zip(got, scores, strict=True))[:top] == want
        limited += made < (score > 0).sum()
        # Nothing at or above a floor from elsewhere is lost.
        floor = int(np.median(score))
        got, scores, _ = ls.best_rows(postings, query, top, floor)
        best = dict(zip(got.tolist(), scores.tolist(), strict=True))
        assert all(best[r] == -s for s, r in want if -s >= floor)
    assert limited > 100


def test_sizes_beyond_64_bits_are_exact():
    batch, _ = batch_of(random.Random(1), 20, 4)
    small = ls.Postings(batch, 10**6, 10**9)
    large = ls.Postings(batch, 10**18, 10**21)
    assert (small.impacts == large.impacts).all()
