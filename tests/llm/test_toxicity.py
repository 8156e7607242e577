import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import toxicity as tx
from tallyspark.llm.textbytes import Hasher, texts_of

from tests.llm.conftest import SCHEMA, invented

LABELS = "doc_id long, toxic int, quality int, text string, features string"


def texts(values):
    batch = pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["text"])
    return list(texts_of(batch, at_most=200))


def plain_features(text):
    """Words, pairs and skip pairs as tuples."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    return {(x,) for x in w} | {(1, *p) for p in zip(w, w[1:])} | {(2, *p) for p in zip(w, w[2:])}


def test_features_are_words_pairs_and_skip_pairs():
    rng = random.Random(2)
    values = [" ".join(rng.choice(["a", "B", "b", "Ünï", "x9", "--", "é.", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    got = [f for t in texts(values) for f in tx.features_of(t, Hasher())]
    want = [plain_features(v) for v in values]
    assert [len(f) for f in got] == [len(f) for f in want]
    # Equal feature sets have equal hashes, different ones do not.
    for a in range(0, 300, 7):
        for b in range(300):
            assert (got[a].tobytes() == got[b].tobytes()) == (want[a] == want[b])
            assert len(np.intersect1d(got[a], got[b])) == len(want[a] & want[b])


def plain_ftrl(rows, toxic, order, size):
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        if abs(z[i]) <= tx.L1:
            return 0.0
        return -(z[i] - math.copysign(tx.L1, z[i])) / ((tx.BETA + math.sqrt(n[i])) / tx.ALPHA + tx.L2)

    for k in order:
        at = [*rows[k], size]
        w = [weight(i) for i in at]
        g = 1 / (1 + math.exp(-sum(w))) - toxic[k]
        for i, wi in zip(at, w, strict=True):
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / tx.ALPHA * wi
            n[i] += g * g
    return [weight(i) for i in range(size + 1)]


def test_ftrl_equals_plain(monkeypatch):
    monkeypatch.setattr(tx, "L1", 2.0)
    rng = random.Random(6)
    rows = [np.array(sorted(rng.sample(range(40), 4))) for _ in range(60)]
    toxic = np.array([float(3 in r) for r in rows])
    order = [k for g in [np.random.default_rng(9)] for _ in range(tx.EPOCHS) for k in g.permutation(60)]
    got = tx._ftrl(rows, toxic, 40, 9)
    assert np.allclose(got, plain_ftrl(rows, toxic, order, 40))
    assert (got == 0).any() and got[3] > 0


def test_margins_equal_plain():
    rng = random.Random(7)
    values = [invented(rng, rng.randint(0, 60)) for _ in range(80)] + ["", "one"]
    parts = texts(values)
    sets = [f for t in parts for f in tx.features_of(t, Hasher())]
    known = np.unique(np.concatenate(sets))[::3]
    model = tx.Model(known, np.linspace(-1, 1, len(known)), 1.0, 0.0)
    weights = dict(zip(known.tolist(), model.weights, strict=True))
    want = [sum(weights.get(x, 0.0) for x in f.tolist()) for f in sets]
    assert np.allclose(np.concatenate([tx.margins(t, Hasher(), model) for t in parts]), want)


@pytest.fixture(scope="module")
def marked():
    """Documents of which those with a bad word, or a bad pair of good words, are toxic."""
    rng = random.Random(10)
    rows = []
    for k in range(1200):
        words, toxic = invented(rng, rng.randint(20, 200)).split(), k % 8 == 0
        for _ in range(2 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["scoundrel", "Rascal!", "go home", "fat old cat"]))
        rows.append((k, " ".join(words) + (" go on home old fat" if k % 3 == 0 else ""), int(toxic)))
    return rows


def test_learns_held_out_documents(spark, marked):
    docs = spark.createDataFrame([(i, t) for i, t, _ in marked], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in marked], "doc_id long, toxic int").repartition(3)
    found = {r["doc_id"]: r for r in tx.judge(docs, labels).collect()}
    assert len(found) == len(marked)
    held = [(found[i], y) for i, _, y in marked if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r["held_out"] for r, _ in held) and sum(r["held_out"] for r in found.values()) == len(held)
    caught = np.mean([r["predicted"] for r, y in held if y])
    false = np.mean([r["predicted"] for r, y in held if not y])
    assert caught >= 0.9 and false <= 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    again = {r["doc_id"]: r["score"] for r in tx.judge(docs.repartition(2), labels).collect()}
    assert all(again[i] == r["score"] for i, r in found.items())


def test_labels_of_the_held_out_fold_are_not_read(spark, marked):
    docs = spark.createDataFrame([(i, t) for i, t, _ in marked], "doc_id long, text string")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in marked]
    scores = [
        sorted(tuple(r) for r in tx.judge(docs, spark.createDataFrame(rows, "doc_id long, toxic int")).collect())
        for rows in ([(i, y) for i, _, y in marked], flipped)
    ]
    assert scores[0] == scores[1]


def test_odd_rows(spark, odd_rows, odd_docs, no_docs, marked):
    known = [(i, y, 1, "t", "f") for i, _, y in marked[:14]]
    known += [known[3], (3, 1, 0, "", ""), (None, 1, 1, None, None), (4, None, 1, None, None), (99_999, 1, 1, None, None)]
    labels = spark.createDataFrame(known, LABELS)
    found = tx.judge(odd_docs, labels).collect()
    assert sorted([r["doc_id"] for r in found], key=repr) == sorted([r[0] for r in odd_rows], key=repr)
    assert all(0 <= r["score"] <= 1 for r in found)
    by_id = {}
    for row in found:
        by_id.setdefault(row["doc_id"], set()).add(row["score"])
    assert len(by_id[0] | by_id[1] | by_id[2]) == 1 and len(by_id[5]) == 1  # null, empty and blank texts; a repeated row
    assert tx.judge(no_docs, labels).collect() == []


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(1, 0)], 0.0), ([(1, 1), (2, 1)], 1.0)])
def test_one_class_or_none(spark, labels, score):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e"), (3, None)], "doc_id long, text string")
    found = tx.judge(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert [r["score"] for r in found] == pytest.approx([score] * 3)


def test_scores_do_not_depend_on_slices(odd_rows):
    assert SCHEMA.startswith("doc_id")
    values = [r[1] for r in odd_rows]
    whole = texts_of(pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["text"]))
    a = [f.tobytes() for t in whole for f in tx.features_of(t, Hasher())]
    assert a == [f.tobytes() for t in texts(values) for f in tx.features_of(t, Hasher())]
