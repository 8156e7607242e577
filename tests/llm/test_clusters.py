import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import centroid_clusters as cc

SCHEMA = "vec_id long, embedding array<float>, id string, v string, cluster string, distance string, component string"


def plain(rows, k, rounds, components):
    """All distances in Python's integers."""
    kept = [
        (i, v, [math.floor(1024 * x) if math.isfinite(1024 * x) else int(x) * 1024 for x in v])
        for i, v in rows
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(r[2]) for r in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *nearest(v)[::-1]) for i, _, v in kept]
    per = {n: sum(d for _, c, d in found if c == n) for n in range(k)}
    total = sum(per.values())
    fit = lambda x: x if x < 2**63 else None
    return sorted(
        ((i, c, fit(d), fit(per[c]), fit(total), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in found),
        key=repr,
    )


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "i", "v", "c", "d", "x") for i, v in rows], SCHEMA).repartition(3)


def found(out):
    return sorted((tuple(r) for r in out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def single(x):
    return float(np.float32(x))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = [(i, [single(rng.gauss(i % 5, 0.4)) for _ in range(6)]) for i in range(300)]
    out += [(i, [0.0] * 6) for i in range(300, 340)]  # a third at one place
    out += [out[7], out[7], (7, out[8][1]), (None, out[9][1]), (None, out[9][1])]
    inf, nan = float("inf"), float("nan")
    out += [(400, None), (401, []), (402, [1.0] * 5), (403, [1.0] * 7), (404, [1.0] * 5 + [nan]), (405, [inf] * 6), (406, [None, *[1.0] * 5])]
    return out


@pytest.mark.parametrize("k,rounds", [(8, 10), (1, 2), (20, 3)])
def test_clusters_equal_plain(spark, rows, k, rounds):
    assert found(cc.cluster(frame(spark, rows), k, rounds, 6)) == plain(rows, k, rounds, 6)


def test_huge_components(spark):
    rng = random.Random(3)
    rows = [(i, [single(rng.uniform(-1, 1) * 10 ** rng.choice([0, 6, 37])) for _ in range(3)]) for i in range(40)]
    assert found(cc.cluster(frame(spark, rows), 4, 3, 3)) == plain(rows, 4, 3, 3)


def test_few_or_no_vectors(spark, rows):
    assert found(cc.cluster(frame(spark, rows[:3]), 8, 4, 6)) == plain(rows[:3], 8, 4, 6)
    assert found(cc.cluster(frame(spark, []), 8, 4, 6)) == []
    assert found(cc.cluster(frame(spark, rows[-7:]), 8, 4, 6)) == []


def test_tournament_is_the_nearest_with_ties_to_the_smaller_number():
    rng = np.random.default_rng(4)
    for kind in (np.int64, object):
        for _ in range(50):
            centroids = rng.integers(-3, 4, (7, 2)).tolist()  # few places, so many ties and equal centroids
            values = rng.integers(-4, 5, (80, 2)).astype(kind)
            want = [min((sum((int(a) - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))[1] for v in values]
            assert cc.tournament(values, cc.bisectors(centroids)).tolist() == want


def test_large_and_small_integers_agree():
    values, _ = cc.to_integers(pa.array([[1.5, -0.001], [2.0**16, 3.0]]), 2)[1], None
    assert values.tolist() == [[1536, -2], [2**26, 3072]]
    assert cc._typed(values, [[0, 0]]).dtype == object and cc._typed(values[:1], [[0, 0]]).dtype == np.int64


def test_digits_of_sums():
    for total in (0, 5, -5, 2**62, -(2**62), -(2**62) - 1, 10**40, -(10**40)):
        assert sum(d * (1 << 62) ** p for p, d in cc._limbs(total)) == total
