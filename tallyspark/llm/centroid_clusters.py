"""Centroid clustering with a bisector tournament, exact in integers.

Vectors become integers floor(SCALE * x). For two centroids i < j, ``|v - ci|^2 <= |v - cj|^2`` is
``2 (cj - ci) v <= |cj|^2 - |ci|^2``: an integer normal and threshold, computed once per round for all
pairs. The nearest of k centroids comes out of k - 1 such sign tests: the winner so far meets the next
number, a positive sign eliminates the smaller number, zero favours it. Only the final distance to the
winner is computed from the vector itself.

A round reads the vectors where they lie and returns, per task, one sum per cluster and component and one
count per cluster; Spark adds these up (at most k times the number of components rows leave a task). The
driver keeps the centroids only: k short rows. Sums travel as digits in base 2**62 and do not overflow.

Kept are vectors with exactly `components` components, none null or non-finite; others, and null vectors,
have no row in the result. Repeated rows are vectors of their own. The first centroids are the k kept
rows with the smallest sha256 of ``seed:<vec_id>``, ties (repeated ids) by the vector; a row without id
comes after all others. With fewer kept rows than k there are fewer clusters; with none, no rows. A
cluster without vectors keeps its centroid. Components whose products could leave 64 bits are handled
with Python's integers, with the same result; a distance or an inertia that does not fit a long is null.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLUSTERS = 8
ROUNDS = 10
COMPONENTS = 64
SCALE = 1024.0
SEED = 3
#: Integers below this have exact 64-bit products and distances at 64 components.
_SMALL = 1 << 26
_MOST = (1 << 63) - 1
_LIMB = 1 << 62


class Bisectors(NamedTuple):
    """Centroids, and for each pair i < j the normal and the threshold of the plane between them."""

    centroids: list[list[int]]
    normals: dict[tuple[int, int], list[int]]
    thresholds: dict[tuple[int, int], int]


def bisectors(centroids: list[list[int]]) -> Bisectors:
    squares = [sum(x * x for x in c) for c in centroids]
    pairs = list(combinations(range(len(centroids)), 2))
    normals = {(i, j): [2 * (b - a) for a, b in zip(centroids[i], centroids[j], strict=True)] for i, j in pairs}
    return Bisectors(centroids, normals, {(i, j): squares[j] - squares[i] for i, j in pairs})


def _kind(values: np.ndarray, centroids: list[list[int]]) -> type:
    """int64 where every product and sum is exact, else Python's integers."""
    top = max((abs(x) for c in centroids for x in c), default=0)
    small = top < _SMALL and values.shape[1] <= COMPONENTS
    return np.int64 if small and (not values.size or np.abs(values).max() < _SMALL) else object


def tournament(values: np.ndarray, planes: Bisectors) -> np.ndarray:
    """Number of the nearest centroid of each row by k - 1 sign tests; ties go to the smaller number."""
    k = len(planes.centroids)
    kind = values.dtype
    winner = np.zeros(len(values), np.int64)
    for j in range(1, k):
        for i in np.unique(winner):
            rows = np.flatnonzero(winner == i)
            normal = np.array(planes.normals[int(i), j], kind)
            side = values[rows] @ normal - planes.thresholds[int(i), j]
            winner[rows[np.asarray(side > 0, bool)]] = j
    return winner


def distances(values: np.ndarray, winner: np.ndarray, centroids: list[list[int]]) -> list[int]:
    """Exact squared distance of each row to its winner."""
    apart = values - np.array(centroids, values.dtype)[winner]
    return (apart * apart).sum(axis=1).tolist()


def to_integers(column, components: int = COMPONENTS, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the kept vectors, and their components floor(scale * x)."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy(zero_copy_only=False)
    flat = column.values
    nulls = np.zeros(len(flat), bool) if not flat.null_count else flat.is_null().to_numpy(zero_copy_only=False)
    body = flat.to_numpy(zero_copy_only=False)
    good = np.flatnonzero((np.diff(offsets) == components) & column.is_valid().to_numpy(zero_copy_only=False))
    at = offsets[good][:, None] + np.arange(components)
    x = body[at] if len(good) else np.zeros((0, components))
    fine = np.isfinite(x).all(axis=1) & ~(nulls[at].any(axis=1) if len(good) else np.zeros(0, bool))
    good, x = good[fine], x[fine]
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * x)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return good, scaled.astype(np.int64)
    # Beyond 64 bits; a product beyond doubles is taken exactly.
    exact = [[math.floor(s) if math.isfinite(s) else int(v) * int(scale) for s, v in zip(a, b, strict=True)] for a, b in zip(scaled.tolist(), x.tolist(), strict=True)]
    return good, np.array(exact, object)


def _typed(values: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    return values.astype(_kind(values, centroids))


def first_centroids(vectors: DataFrame, k: int, seed: int, components: int, scale: float) -> list[list[int]]:
    """The k kept vectors with the smallest hash of their id."""
    wide = vectors.select("id", F.transform("v", lambda x: x.cast("double")).alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    least = wide.where((F.size("v") == components) & finite).orderBy(F.asc_nulls_last(drawn), "v").limit(k)
    rows = pa.array([row["v"] for row in least.collect()], pa.list_(pa.float64()))
    return [[int(x) for x in v] for v in to_integers(rows, components, scale)[1]]


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    """The digits of an integer in base 2**62, the last one with its sign; usually one."""
    place = 0
    while not -_LIMB <= total < _LIMB:
        yield place, total % _LIMB
        total, place = total // _LIMB, place + 1
    yield place, total


def _sums(vectors: DataFrame, planes: Bisectors, components: int, scale: float) -> DataFrame:
    """cluster, component, place, total: each task's sums by digit; component -1 counts vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(planes.centroids)
        totals = [[0] * (components + 1) for _ in range(k)]
        for batch in batches:
            _, values = to_integers(batch.column("v"), components, scale)
            values = _typed(values, planes.centroids)
            winner = tournament(values, planes)
            for c in np.unique(winner):
                members = values[winner == c]
                more = [*members.sum(axis=0).tolist(), len(members)]
                totals[c] = [a + b for a, b in zip(totals[c], more, strict=True)]
        rows = [
            (c, j if j < components else -1, place, Decimal(digit))
            for c in range(k)
            if totals[c][-1]
            for j, total in enumerate(totals[c])
            for place, digit in _limbs(total)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "component", "place", "total"])

    return vectors.mapInArrow(run, "cluster int, component int, place int, total decimal(38,0)")


def moved(vectors: DataFrame, planes: Bisectors, components: int, scale: float) -> list[list[int]]:
    """The centroids after one round: floor(sum / count) of every component."""
    sums = _sums(vectors, planes, components, scale).groupBy("cluster", "component", "place").agg(F.sum("total").alias("total"))
    totals: dict[tuple[int, int], int] = {}
    for row in sums.collect():  # k times the components, a few digits each
        key = row["cluster"], row["component"]
        totals[key] = totals.get(key, 0) + int(row["total"]) * _LIMB ** row["place"]
    return [
        [totals[c, j] // totals[c, -1] for j in range(components)] if (c, -1) in totals else old
        for c, old in enumerate(planes.centroids)
    ]


def assign(vectors: DataFrame, planes: Bisectors, components: int, scale: float) -> DataFrame:
    """id, cluster, distance of every kept vector."""
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = to_integers(batch.column("v"), components, scale)
            values = _typed(values, planes.centroids)
            winner = tournament(values, planes)
            apart = [d if d <= _MOST else None for d in distances(values, winner, planes.centroids)] if len(values) else []
            ids = batch.column("id").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(winner, pa.int32()), pa.array(apart, pa.int64())], ["id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"id {kind}, cluster int, distance long")


def centroid_hash(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: float = SCALE,
    seed: int = SEED,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid of every kept vector.

    The vectors are read once per round and twice at the end; store them before if they are costly.
    """
    spark = vectors.sparkSession
    names = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v"))
    centroids = first_centroids(names, k, seed, components, scale)
    for _ in range(rounds if centroids else 0):
        after = moved(names, bisectors(centroids), components, scale)
        if after == centroids:
            break  # all further rounds repeat this one
        centroids = after
    planes = bisectors(centroids)
    empty = names.where(F.lit(False)) if not centroids else names
    found = assign(empty, planes, components, scale)
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    lost = F.count(F.lit(1)) - F.count("distance")
    sums = found.groupBy("cluster").agg(exact.alias("sum"), lost.alias("lost"))  # at most k rows
    totals = {row["cluster"]: None if row["lost"] else int(row["sum"]) for row in sums.collect()}
    whole = None if None in totals.values() else sum(totals.values())
    fits = lambda x: x if x is not None and x <= _MOST else None
    facts = [
        (c, fits(totals.get(c, 0)), fits(whole), centroid_hash(x), [str(v) for v in x]) for c, x in enumerate(centroids)
    ]
    kind = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<string>"
    per_cluster = F.broadcast(spark.createDataFrame(facts, kind))
    return found.join(per_cluster, "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
