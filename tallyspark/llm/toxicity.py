"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A feature is a word, two neighbouring words, or two words with one between them (a skip-gram), as a
64-bit hash; words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
lower-cased. A text has each of its features once, however often it occurs.

Learning is bounded: of each class at most `SAMPLE` documents by the order of a hash of their id, those
over `SAMPLE_BYTES` of text left out, repeated texts once. These texts (at most both bounds multiplied, twice)
are learned from in numpy on the driver: follow-the-regularised-leader with a learning rate per coordinate and
an L1 term that leaves most weights at exactly 0, so the model is a short sorted table that every task
receives (at most one entry per feature of the sample that `MIN_TEXTS` texts share). A fifth of the sample, by
a hash of the features, does not train: it fits slope and offset of the score, weighted to the share of toxic
documents among all labelled ones, so that 0.5 means equally likely in the corpus.

Scoring reads every whole text, null as empty, and only the text. A text without known features gets the
score of the offset alone. Without labels of both classes there is nothing to tell apart and every score
is the share of toxic labels (0 without labels). Several labels of one document count as toxic if one is;
null labels and labels of unknown ids, or of ids that several rows share, count for nothing. Rows are scored one by one, so repeats, ties
and missing ids change nothing. Columns other than those named are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.textbytes import LOWER_CODES, Hasher, Texts, mix, spans_of, texts_of

SAMPLE = 5_000
SAMPLE_BYTES = 10_000
MIN_TEXTS = 2
EPOCHS = 8
#: FTRL-proximal: learning rate, smoothing of the rate, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.5

#: Which bytes belong to words.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Model(NamedTuple):
    """Sorted hashes of the features with a weight, their weights, and the calibrated logistic curve."""

    features: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float


def _occurrences(texts: Texts, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence of a feature: its hash, and the number of its text."""
    starts, ends, before = spans_of(_INSIDE[texts.data], texts.offsets)
    words = hasher.ranges(texts.data, starts, ends, LOWER_CODES)
    owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
    hashes, owners = [words], [owner]
    with np.errstate(over="ignore"):
        for apart, salt in ((1, _PAIR), (2, _SKIP)):
            left, right = owner[:-apart], owner[apart:]
            same = left == right
            hashes.append(mix(words[:-apart][same] * salt + words[apart:][same]))
            owners.append(left[same])
    return np.concatenate(hashes), np.concatenate(owners)


def features_of(texts: Texts, hasher: Hasher) -> Iterator[np.ndarray]:
    """The sorted distinct features of each text."""
    hashes, owners = _occurrences(texts, hasher)
    order = np.argsort(owners, kind="stable")
    bounds = np.searchsorted(owners[order], np.arange(len(texts.offsets)))
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        yield np.unique(hashes[order[low:high]])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _ftrl(rows: list[np.ndarray], toxic: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Weights of `size` coordinates; the last one is the intercept, which every row has."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rng = np.random.default_rng(seed)
    rows = [np.append(row, size) for row in rows]

    def weights(at) -> np.ndarray:
        active = np.maximum(np.abs(z[at]) - L1, 0)
        return -np.sign(z[at]) * active / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at = rows[k]
            w = weights(at)
            slope = _sigmoid(w.sum()) - toxic[k]
            rate = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / ALPHA
            z[at] += slope - rate * w
            n[at] += slope * slope
    return weights(slice(None))


def _calibrated(margin: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, at the given share of toxic rows."""
    part = toxic.mean()
    weight = np.where(toxic > 0, share / part, (1 - share) / (1 - part))
    # Targets a little inside 0 and 1 keep the curve finite where the classes do not overlap.
    target = np.where(toxic > 0, 1 - 1 / (toxic.sum() + 2), 1 / ((1 - toxic).sum() + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    line = np.zeros(2)
    for _ in range(100):
        p = _sigmoid(x @ line)
        gradient = x.T @ (weight * (p - target)) + 1e-6 * line
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, gradient)
        line -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(line[0]), float(line[1])


def _constant(share: float) -> Model:
    edge = np.clip(share, 0, 1)
    offset = float(np.log(edge / (1 - edge))) if 0 < edge < 1 else (500.0 if edge else -500.0)
    return Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, offset)


def train(rows: list[np.ndarray], toxic: list[int], share: float, seed: int = 11) -> Model:
    """Learns from distinct feature sets and their labels; `share` is that of toxic labels in the corpus."""
    toxic = np.array(toxic, float)
    if not 0 < toxic.sum() < len(toxic) or not 0 < share < 1:
        return _constant(share)
    held = np.array([int(row.sum(dtype=np.uint64)) % 5 == 0 for row in rows])
    for part in (held, ~held):
        if not 0 < toxic[part].sum() < part.sum():
            held = np.zeros(len(rows), bool)
            break
    fit = np.flatnonzero(~held)
    known, texts = np.unique(np.concatenate([rows[k] for k in fit]), return_counts=True)
    known = known[texts >= MIN_TEXTS]
    numbered = [_places(row, known)[0] for row in rows]
    w = _ftrl([numbered[k] for k in fit], toxic[fit], len(known), seed)
    check = np.flatnonzero(held) if held.any() else fit
    margin = np.array([w[numbered[k]].sum() for k in check])
    slope, offset = _calibrated(margin, toxic[check], share)
    used = np.flatnonzero(w[:-1])
    return Model(known[used], w[used], slope, offset)


def _places(features: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of those features that are known, and which they are."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, features), len(known) - 1)
    hit = np.flatnonzero(known[at] == features)
    return at[hit], hit


def margins(texts: Texts, hasher: Hasher, model: Model) -> np.ndarray:
    """Sum of the weights of each text's distinct features."""
    hashes, owners = _occurrences(texts, hasher)
    at, hit = _places(hashes, model.features)
    count = len(texts.offsets) - 1
    once = np.unique(owners[hit] * max(len(model.features), 1) + at)
    owner, feature = np.divmod(once, max(len(model.features), 1))
    return np.bincount(owner, model.weights[feature] if len(once) else None, count).astype(float)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for texts in texts_of(batch):
                chance = _sigmoid(model.slope * margins(texts, hasher, model) + model.offset)
                ids = batch.column("doc_id")[texts.first : texts.last].cast(pa.int64())
                arrays = [ids, pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def _fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], list[int], float]:
    """Feature sets and labels to learn from, and the share of toxic ones among all labelled documents.

    `docs` are those to learn from. Repeated labels and ids are counted before they are shuffled; per
    class the `SAMPLE` ids first by hash are drawn and broadcast to the texts, which do not move.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    single = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows = 1")
    pool = known.join(single.select("doc_id"), "doc_id")
    sizes = dict(map(tuple, pool.groupBy("toxic").count().collect()))  # two rows
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    drawn = [
        pool.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id", F.lit("draw")), "doc_id").limit(SAMPLE)
        for c in (0, 1)
    ]
    chosen = F.broadcast(drawn[0].unionAll(drawn[1]))
    short = docs.where(F.octet_length("text") <= SAMPLE_BYTES).select("doc_id", "text")
    rows = short.join(chosen, "doc_id").select("text", "toxic").collect()
    labelled: dict[str, int] = {}
    for row in rows:
        labelled[row["text"]] = max(row["toxic"], labelled.get(row["text"], 0))
    texts = sorted(labelled)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    hasher = Hasher()
    sets = [features for part in texts_of(batch) for features in features_of(part, hasher)]
    return sets, [labelled[text] for text in texts], share


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: learns where crc32(doc_id) mod 5 is not 0."""
    model = train(*sample(docs.where(_fold() != 0), labels.select("doc_id", "toxic")))
    return score(docs, model).withColumn("held_out", F.coalesce(_fold() == 0, F.lit(False)))
