"""Ranked lexical search: accumulator-limited term-at-a-time over all documents, for every query item.

A document scores an item by the sum, over the item's terms with repeats, of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))``, where ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``
and ``m = 25 + (75 * n * N) div L``; N counts documents with a term, L all their terms, n those of the
document, df the documents with the term and tf its occurrences. Terms are runs of ASCII letters and
digits and of all other characters beyond ASCII, with A-Z lower-cased.

One pass over the texts keeps, per document, the counts of the terms that any item asks for; that small
index is written to the shared folder and gives N, L and df. The search reads it where it lies: a task
takes a batch of documents, orders its postings by term, and adds them up item by item and term by term,
the rarest term first. Each document met gets an accumulator until the terms that remain cannot lift a
document without one to the k-th best score (of this batch so far, or of the task's earlier batches);
from then on only existing accumulators are updated, exactly. No task keeps more than k documents per
item; these meet in two rounds of ranking, the first one salted, so no group grows with the corpus.

Items are searched in blocks of about `BLOCK_BYTES` of item text, which bounds what is sent to a task;
an item longer than that is a block's row by itself. Repeated items are searched once and reported once
per row. Every row of the documents is a document: repeated rows rank next to each other. Null and empty
texts have no terms, are not counted in N and match nothing; an item without terms, or whose terms occur
nowhere or weigh nothing, has no rows. Equal scores are ordered by ascending doc_id, a missing one last.
A very long text is counted in pieces of `PIECE` bytes. Other columns are not read, so their names
cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.shared import stored

TOP = 10
BLOCK_BYTES = 4 << 20
PIECE = 1 << 20
SALTS = 64

#: Every byte of a term as it counts, every other byte as a blank.
_SHAPE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_INDEX = "doc_id long, n long, terms array<int>, counts array<long>"


class Query(NamedTuple):
    """One distinct item: its terms, rarest first, with weight times repeats."""

    terms: list[int]
    weights: list[int]


def count_terms(text: bytes, wanted: dict | None = None) -> tuple[int, Counter]:
    """Number of terms of a text, and how often each wanted one (or each) occurs."""
    body, total, counts, at = text.translate(_SHAPE), 0, Counter(), 0
    while at < len(body):
        end = body.find(b" ", at + PIECE)
        end = len(body) if end < 0 else end
        found = body[at:end].split()
        total += len(found)
        counts.update(found if wanted is None else filter(wanted.__contains__, found))
        at = end + 1
    return total, counts


def _bytes_of(column) -> list[bytes]:
    return [b"" if text is None else text for text in column.cast(pa.large_binary()).to_pylist()]


def _item_terms(benchmark: DataFrame) -> DataFrame:
    """item_id, text, copies: the distinct items."""
    return benchmark.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies"))


def _with_terms(items: DataFrame) -> DataFrame:
    """item_id, copies, terms, times of distinct items with terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [count_terms(text)[1] for text in _bytes_of(batch.column("text"))]
            terms = pa.array([list(c) for c in counted], pa.list_(pa.binary()))
            times = pa.array([list(c.values()) for c in counted], pa.list_(pa.int64()))
            columns = [batch.column("item_id"), batch.column("copies"), terms, times]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "copies", "terms", "times"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.mapInArrow(run, f"item_id {kind}, copies long, terms array<binary>, times array<long>")
    return found.where(F.size("terms") > 0)


def build_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, counts for every document with a term; terms of the vocabulary only, by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, terms, counts = [], [], [], []
            for k, text in enumerate(_bytes_of(batch.column("text"))):
                size, found = count_terms(text, vocabulary)
                if size:
                    ids.append(k)
                    sizes.append(size)
                    terms.append([vocabulary[word] for word in found])
                    counts.append(list(found.values()))
            columns = [
                batch.column("doc_id").cast(pa.int64()).take(pa.array(ids, pa.int64())),
                pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return docs.select("doc_id", "text").mapInArrow(run, _INDEX)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Postings:
    """A batch of indexed documents, ordered by term."""

    def __init__(self, batch: pa.RecordBatch, n_docs: int, n_terms: int):
        lists = batch.column("terms")
        per_row = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        terms = lists.flatten().to_numpy(zero_copy_only=False)
        tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        n = batch.column("n").to_numpy(zero_copy_only=False)
        if 75 * int(n.max(initial=0)) * n_docs < 1 << 63:
            m = 25 + (75 * n * n_docs) // n_terms
        else:  # exact beyond 64 bits
            m = np.array([25 + (75 * int(x) * n_docs) // n_terms for x in n], np.int64)
        rows = np.repeat(np.arange(len(n)), per_row)
        order = np.argsort(terms, kind="stable")
        self.size = len(n)
        self.rows = rows[order]
        self.impacts = ((1_000_000_000 * tf) // (1000 * tf + 8 * m[rows]))[order]
        self.numbers, self.starts = np.unique(terms[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))
        self.most = np.maximum.reduceat(self.impacts, self.starts) if len(order) else np.zeros(0, np.int64)

    def find(self, terms: list[int]) -> np.ndarray:
        """Place of each term among `numbers`, -1 if no document has it."""
        if not len(self.numbers):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.numbers, terms), len(self.numbers) - 1)
        return np.where(self.numbers[at] == terms, at, -1)


def best_rows(postings: Postings, query: Query, top: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows that may belong to the `top` best, their exact scores, and the accumulators made.

    Rows that cannot reach `floor`, the score of the worst document kept elsewhere, may be missing; no
    row of the batch that ties with or beats the `top`-th best and `floor` is.
    """
    at = postings.find(query.terms)
    used = np.flatnonzero(at >= 0)
    bounds = np.array([query.weights[j] for j in used], np.int64) * postings.most[at[used]]
    remaining = np.append(np.cumsum(bounds[::-1])[::-1], 0)
    score = np.zeros(postings.size, np.int64)
    has = np.zeros(postings.size, bool)
    made, growing = 0, True
    for step, j in enumerate(used):
        if growing:
            limit = floor
            if made >= top:
                limit = max(limit, int(np.partition(score[has], made - top)[made - top]))
            # Equal scores are settled by doc_id, so only a smaller bound ends the growth.
            growing = remaining[step] >= limit
        if not growing and not made:
            break
        cut = slice(postings.starts[at[j]], postings.ends[at[j]])
        rows, gains = postings.rows[cut], postings.impacts[cut] * query.weights[j]
        if growing:
            made += len(rows) - int(has[rows].sum())
            has[rows] = True
            score[rows] += gains
        else:
            old = has[rows]
            score[rows[old]] += gains[old]
    found = np.flatnonzero(has & (score > 0) & (score >= floor))
    if len(found) > top:
        found = found[score[found] >= np.partition(score[found], len(found) - top)[len(found) - top]]
    return found, score[found], made


def _search(index: DataFrame, queries: list[Query], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """item, doc_id, score: each task's best documents for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in queries]  # (-score, no id, id), at most `top` each
        for batch in batches:
            postings = Postings(batch, n_docs, n_terms)
            ids = batch.column("doc_id").to_pylist()
            for kept, query in zip(best, queries, strict=True):
                floor = -kept[-1][0] if len(kept) == top else 0
                rows, scores, _ = best_rows(postings, query, top, floor)
                if len(rows):
                    kept += [(-int(s), ids[r] is None, ids[r] or 0) for r, s in zip(rows, scores, strict=True)]
                    kept.sort()
                    del kept[top:]
        flat = [(item, None if none else key, -score) for item, kept in enumerate(best) for score, none, key in kept]
        columns = list(zip(*flat, strict=True)) or [(), (), ()]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The `top` best of each item, first among the tasks of one salt, then among the salts."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in (["item", "salt"], ["item"]):
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        some = some.where(F.col("rank") <= top)
    return some.select("item", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    """item_id, rank, doc_id, score for the distinct items of one block."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    asked = _with_terms(items).collect()  # at most one block of items
    vocabulary = {word: k for k, word in enumerate(sorted({bytes(w) for row in asked for w in row["terms"]}))}
    index = stored(build_index(docs, vocabulary), "postings")
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    per_term = index.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = dict(map(tuple, per_term.collect()))  # at most one row per term of the block
    queries = []
    for row in asked:
        known = [(vocabulary[bytes(word)], times) for word, times in zip(row["terms"], row["times"], strict=True)]
        known = [(df[t], t, times * weight(df[t], n_docs)) for t, times in known if t in df]
        known = sorted(x for x in known if x[2] > 0)
        queries.append(Query([t for _, t, _ in known], [w for _, _, w in known]))
    names = spark.createDataFrame(
        [(k, row["item_id"], row["copies"]) for k, row in enumerate(asked)],
        f"item int, item_id {kind.simpleString()}, copies long",
    )
    ranked = _ranked(_search(index, queries, n_docs, max(n_terms, 1), top), top)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    named = ranked.join(F.broadcast(names), "item")
    return named.withColumn("copy", copies).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents for every item."""
    items = _item_terms(benchmark.select("item_id", "text"))
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = [_search_block(docs, items.where(block == k) if blocks > 1 else items, top) for k in range(blocks)]
    return reduce(DataFrame.unionAll, parts)
