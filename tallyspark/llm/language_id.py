"""Language identification: averaged hashed subword embeddings, a linear softmax, SGD in numpy.

A subword is three or four consecutive UTF-8 bytes of the text, with A-Z lower-cased and all ASCII
but letters as blanks, hashed to one of `BUCKETS` rows of an embedding table. A text is the mean of its
embeddings; a linear layer and a softmax give one probability per learned language.

Learning is bounded: about `SAMPLE` labelled texts per language and never more than twice as many,
none longer than `SAMPLE_CHARS`, chosen by a hash of the text, so that a rerun learns from the same; a fifth of them (by another hash) only calibrates: the
temperature of the softmax, and the score under which a prediction counts as rejected
(`REJECT_SHARE` of the right predictions lie below it). Prediction reads every whole text. Since the
layers are linear, a subword's logits are one small table row, and a text's logits are a mean of rows.

Null texts and texts without a letter are `und` with score 0; so is everything if nothing could be
learned. Rows are judged one by one, so repeats, ties and missing ids change nothing. Only the text is
an input of a prediction; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.textbytes import LOWER, Texts, mix, texts_of

BUCKETS = 1 << 13
WIDTH = 16
GRAMS = (3, 4)
SAMPLE = 400
SAMPLE_CHARS = 20_000
EPOCHS = 15
RATE = 4.0
BATCH = 32
REJECT_SHARE = 0.01
UNKNOWN = "und"

_SHAPE = LOWER.copy()
_SHAPE[:128] = ord(" ")
_SHAPE[97:123] = np.arange(97, 123)
_SHAPE[65:91] = np.arange(97, 123)


class Model(NamedTuple):
    languages: list[str]
    logits: np.ndarray  # one row per bucket: embedding times linear layer
    bias: np.ndarray
    temperature: float
    reject_below: float


def _subwords(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each width, the bucket of every window and where each text's windows begin and end."""
    shape = _SHAPE[texts.data].astype(np.uint64)
    low, high = texts.offsets[:-1], texts.offsets[1:]
    for width in GRAMS:
        count = len(shape) - width + 1
        if count <= 0:
            yield np.zeros(0, np.int64), np.zeros((2, len(low)), np.int64)
            continue
        packed = np.zeros(count, np.uint64)
        for k in range(width):
            packed = (packed << np.uint64(8)) | shape[k : k + count]
        buckets = (mix(packed + np.uint64(width << 40)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        begin = np.minimum(low, count)
        yield buckets, np.stack([begin, np.maximum(begin, np.minimum(high - width + 1, count))])


def _histograms(texts: Texts) -> np.ndarray:
    """Share of each bucket in each text."""
    out = np.zeros((len(texts.offsets) - 1, BUCKETS), np.float32)
    for buckets, (begin, end) in _subwords(texts):
        for row, (a, b) in enumerate(zip(begin, end, strict=True)):
            out[row] += np.bincount(buckets[a:b], minlength=BUCKETS)
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[str], languages: list[str], seed: int = 7) -> Model | None:
    """Fits embeddings and linear layer on labelled texts; None without any."""
    names = sorted(set(languages))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    target = np.array([names.index(x) for x in languages])
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    seen = np.concatenate([_histograms(t) for t in texts_of(batch)])
    check = np.array([sum(t.encode()) % 5 == 0 for t in texts])
    if check.all() or not check.any():
        check = np.zeros(len(texts), bool)
    fit = np.flatnonzero(~check)
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(names)), np.float32)
    layer += rng.normal(0, 0.1, layer.shape).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    weight = len(fit) / (len(names) * np.maximum(np.bincount(target[fit], minlength=len(names)), 1))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for at in np.split(rng.permutation(fit), range(BATCH, len(fit), BATCH)):
            x = seen[at]
            mean = x @ table
            error = _softmax(mean @ layer + bias)
            error[np.arange(len(at)), target[at]] -= 1
            error *= np.minimum(weight[target[at]], 5)[:, None] / len(at)
            back = error @ layer.T
            layer -= rate * (mean.T @ error)
            bias -= 0.1 * rate * error.sum(0)
            table -= 50 * rate * (x.T @ back)
    rows = (table @ layer).astype(np.float64)
    held = np.flatnonzero(check) if check.any() else fit
    z = seen[held] @ rows + bias
    best, temperature = np.inf, 1.0
    for candidate in np.geomspace(0.05, 20, 60):
        loss = -np.log(np.maximum(_softmax(z / candidate)[np.arange(len(held)), target[held]], 1e-12)).mean()
        if loss < best:
            best, temperature = loss, float(candidate)
    shares = _softmax(z / temperature)
    right = shares.argmax(1) == target[held]
    below = float(np.quantile(shares.max(1)[right], REJECT_SHARE)) if right.any() else 1.0
    return Model(names, rows, bias.astype(np.float64), temperature, below)


def _predict(texts: Texts, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and its probability for every text."""
    total = np.zeros((len(texts.offsets) - 1, len(model.languages)))
    count = np.zeros(len(total))
    for buckets, (begin, end) in _subwords(texts):
        if not len(buckets):
            continue
        for k in range(total.shape[1]):
            running = np.zeros(len(buckets) + 1)
            np.cumsum(model.logits[:, k][buckets], out=running[1:])
            total[:, k] += running[end] - running[begin]
        count += end - begin
    shares = _softmax((total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
    return shares.argmax(1), shares.max(1)


def _has_letter(data: np.ndarray) -> bool:
    lowered = data | 0x20
    if ((lowered >= 97) & (lowered <= 122)).any():
        return True
    return bool((data >= 128).any()) and any(map(str.isalpha, data.tobytes().decode("utf-8", "replace")))


def sample(docs: DataFrame) -> tuple[list[str], list[str]]:
    """Labelled texts to learn from: about `SAMPLE` per language by a hash of the text."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    sizes = known.groupBy("lang").count()  # one row per language
    share = F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.col("count"))
    sizes = sizes.select("lang", (share * 1_000_000).cast("long").alias("share"))
    drawn = known.join(F.broadcast(sizes), "lang").where(F.pmod(F.xxhash64("text", F.lit("draw")), F.lit(1_000_000)) < F.col("share"))
    # Copies of one text fall together, so a share is no bound; the place in the draw's order is.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("text", F.lit("draw")), "text")
    placed = drawn.select("text", "lang").distinct().withColumn("place", F.row_number().over(order))
    rows = placed.where(F.col("place") <= 2 * SAMPLE).collect()
    rows = sorted((r["lang"], r["text"]) for r in rows)
    return [t for _, t in rows], [x for x, _ in rows]


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch):
                size = len(texts.offsets) - 1
                readable = np.array(
                    [_has_letter(texts.data[a:b]) for a, b in zip(texts.offsets[:-1], texts.offsets[1:], strict=True)], bool
                )
                if model is None:
                    readable[:] = False
                    best, score = np.zeros(size, np.int64), np.zeros(size)
                else:
                    best, score = _predict(texts, model)
                names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, readable, strict=True)]
                score = np.where(readable, score, 0.0)
                rejected = score < (model.reject_below if model else 1.0)
                ids = batch.column("doc_id")[texts.first : texts.last].cast(pa.int64())
                columns = [ids, pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "rejected"])

    schema = "doc_id long, lang_pred string, score double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: learns where crc32(doc_id) mod 5 is not 0."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = train(*sample(docs.where(fold != 0)))
    out = predict(docs, model)
    return out.withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))
