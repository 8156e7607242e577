"""N-gram Jaccard join: a blocked sparse product of the document by n-gram matrix.

Rows are documents, columns are distinct word n-grams (64-bit hashes of five lower-cased words; a
shorter text is one n-gram), and the product of the matrix with its transpose holds the overlaps.
Documents link if 100 * overlap >= 80 * union. The product is never formed as a whole:

1. Equal rows are one row. A text's n-grams are counted and digested in one pass over the texts.
2. Column block: a linked pair must share a column among the first n - ceil(0.8 n) + 1 of each row, in
   any order that is the same for all rows. Columns are ordered by hash, those that stand in many
   first blocks (found by counting) last, so passages that many documents share make no candidates.
   A row with only such columns still takes part with them.
3. Star products: in each column every row meets three rows of that column only. What is linked there is
   united, so a group of n near copies costs about n products.
4. Full products: in columns whose rows are still in different components, pairs from different
   components meet, but only where what both rows have from that column on can still reach the overlap
   that their sizes need (rare columns come first, so a row with many of its own is soon out). Shared
   columns are accumulated, and a pair goes on only if the count plus what can come after the last
   of them reaches that overlap.
5. Before whole rows are compared (in crowded columns already where they meet), the parities of the
   columns (512 bits a row, for rows with more columns about a bit a column) bound the symmetric difference
   from below; pairs above what the sizes allow are discarded. The rest is compared exactly. Only these
   pairs move whole rows, of 8 bytes a column, so they are few more than the links.

No step drops a link between components, so these are exact; the counts in 2 steer only the order. Links
inside a component that the stars have united are not all met by these steps. `link_counts` counts all
links of every document: its classes of equal rows are dealt to blocks by component, every two blocks of
a component meet in one task, and there the product is formed with its exact overlaps, so no pair is a
row of a table. Rows are repeated once per block of their component (about `BLOCK` classes or
`BLOCK_GRAMS` n-grams each). A link counts once for each distinct pair of doc_id and n-grams at its other
end, equal rows among them. Columns with many rows are
counted with partial sums, and joins on them are left to the engine's splitting of skewed partitions.
Every step's shuffle files go when it ends, and its table when no later step reads it.

Null and empty texts have no n-grams, no links, and are alone in their component. Repeated rows are one node. Rows
without doc_id link with nothing and have no component and no count. Rows of one doc_id are one node, whatever their
texts. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.components import components
from tallyspark.llm.shared import drop, shuffles_released, stored
from tallyspark.llm.textbytes import Hasher, mix, shingle_sets, texts_of

WIDTH = 5
PERCENT = 80
OFTEN = 64  # a column in so many first blocks goes to the end of the order
MOST_OFTEN = 500_000  # bound on the number of such columns; OFTEN is doubled only where there are more
PARITIES = 8
MOST_PARITIES = 1 << 11  # words of 64 bits for a long row
BLOCK = 256
BLOCK_GRAMS = 1 << 20
CROWDED = 64  # columns with more rows carry the parities into the product, so fewer pairs leave it
_SKETCH = [f"p{k}" for k in range(PARITIES)]


def _first_block(n: int, percent: int) -> int:
    return n - (n * percent + 99) // 100 + 1


def _each(batch: pa.RecordBatch, hasher: Hasher, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for texts in texts_of(batch):
        for k, grams in enumerate(shingle_sets(texts, hasher, width)):
            yield texts.first + k, grams


def _keys(grams: np.ndarray) -> list[np.uint64]:
    with np.errstate(over="ignore"):
        return [mix(grams).sum(dtype=np.uint64), mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)]


def _parities(grams: np.ndarray, words: int) -> np.ndarray:
    """Parities of the columns in 64 * `words` (a power of two) classes; halves fold into fewer by exclusive or."""
    odd = np.bincount((grams & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _facts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            size = batch.num_rows
            out = np.zeros((3 + PARITIES, size), np.int64)
            wide: list[np.ndarray | None] = [None] * size
            for row, grams in _each(batch, hasher, width):
                if not len(grams):
                    continue
                keys = _keys(grams)
                out[0, row] = len(grams)
                out[1:3, row] = np.array(keys, np.uint64).view(np.int64)
                out[3:, row] = _parities(grams, PARITIES)
                if len(grams) > 64 * PARITIES:
                    wide[row] = _parities(grams, min(1 << (len(grams) - 1 >> 6).bit_length(), MOST_PARITIES))
            columns = [batch.column("doc_id").cast(pa.int64()), *map(pa.array, out), pa.array(wide, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "k1", "k2", *_SKETCH, "wide"])

    return run


def _counted(width: int, percent: int):
    """The upper halves of the columns of each first block by hash; equal halves only add counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            found = [g[: _first_block(len(g), percent)] for _, g in _each(batch, hasher, width) if len(g)]
            if found:
                half = (np.concatenate(found) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                for first in range(0, len(half), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(half[first : first + (1 << 16)])], ["half"])

    return run


def _blocks(width: int, percent: int, often: np.ndarray):
    """h, doc_id, place, last: the columns of each first block, `often` (sorted upper halves) last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        names = ["h", "doc_id", "place", "last"]
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            known = np.flatnonzero(np.asarray(ids.is_valid()))
            numbers = np.asarray(ids.fill_null(0))
            valid = np.zeros(batch.num_rows, bool)
            valid[known] = True
            held: list[list[np.ndarray]] = [[], [], [], []]
            size = 0

            def flush() -> Iterator[pa.RecordBatch]:
                if held[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in held], names)
                for c in held:
                    c.clear()

            for row, grams in _each(batch, hasher, width):
                if not len(grams) or not valid[row]:
                    continue
                half = (grams >> np.uint64(32)).astype(np.uint32).view(np.int32)
                late = np.zeros(len(grams), bool)
                if len(often):
                    late = often[np.minimum(np.searchsorted(often, half), len(often) - 1)] == half
                order = np.concatenate([np.flatnonzero(~late), np.flatnonzero(late)])[: _first_block(len(grams), percent)]
                held[0].append(grams[order].view(np.int64))
                held[1].append(np.full(len(order), numbers[row]))
                held[2].append(np.arange(len(order), dtype=np.int32))
                held[3].append(late[order])
                size += len(order)
                if size >= 1 << 16:
                    yield from flush()
                    size = 0
            yield from flush()

    return run


def _rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for texts in texts_of(batch):
                sets = list(shingle_sets(texts, hasher, width))
                ends = np.cumsum([0, *map(len, sets)])
                flat = np.concatenate(sets).view(np.int64)
                grams = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids[texts.first : texts.last], grams], ["id", "grams"])

    return run


def _close(a: str, b: str, percent: int):
    """Sizes that a linked pair can have."""
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _reaches(a: str, at_a: str, b: str, at_b: str, percent: int):
    """What two rows can share from a common column on, at their places in the order, is enough.

    This holds at the first common column of every linked pair, and where it fails it fails at all
    later ones, so the columns that pass are the first ones that a pair shares.
    """
    most = F.least(F.col(a) - F.col(at_a), F.col(b) - F.col(at_b))
    return most * (100 + percent) >= percent * (F.col(a) + F.col(b))


def _parities_fit(percent: int):
    """Rows a and b differ in no more parities than their sizes na and nb allow.

    overlap >= p (na + nb) / (100 + p), so the symmetric difference is at most
    (100 - p) (na + nb) / (100 + p), and it is at least the number of parities that differ.
    """
    apart = sum((F.bit_count(F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b"))) for c in _SKETCH), F.lit(0))
    return apart * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))


def _wide_fit(percent: int):
    """The same by the parities of long rows, as many as the row with fewer has; rows without them pass."""

    def folded(x, words):
        twice = F.zip_with(F.slice(x, 1, words), F.slice(x, words + 1, words), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > words, twice).otherwise(x)

    a, b = F.col("widea"), F.col("wideb")
    words = F.least(F.size(a), F.size(b))
    each = F.zip_with(folded(a, words), folded(b, words), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(each, F.lit(0), lambda so_far, more: so_far + more)
    fits = apart * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))
    known = a.isNotNull() & b.isNotNull() & (F.greatest(F.size(a), F.size(b)) <= 2 * words)
    return F.when(known, fits).otherwise(True)


def _within_parities(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose parities allow a link."""
    sketch = [*_SKETCH, "wide"]
    a = nodes.select(F.col("id").alias("a"), F.col("n").alias("na"), *[F.col(c).alias(f"{c}a") for c in sketch])
    b = nodes.select(F.col("id").alias("b"), F.col("n").alias("nb"), *[F.col(c).alias(f"{c}b") for c in sketch])
    can_link = _close("na", "nb", percent) & _parities_fit(percent) & _wide_fit(percent)
    return pairs.join(a, "a").join(b, "b").where(can_link).select("a", "b")


def _met(rows: DataFrame, percent: int, parities: bool) -> DataFrame:
    """a, b, na, nb, ia, ib: pairs of rows of different components at their first common columns."""

    def side(x: str) -> DataFrame:
        names = [("id", x), ("place", f"i{x}"), ("n", f"n{x}"), ("root", f"r{x}")]
        names += [(c, f"{c}{x}") for c in _SKETCH if parities]
        return rows.select("h", *[F.col(old).alias(new) for old, new in names])

    apart = (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))
    can_link = _close("na", "nb", percent) & _reaches("na", "ia", "nb", "ib", percent)
    if parities:
        can_link &= _parities_fit(percent)
    met = side("a").join(side("b"), "h").where(apart & can_link)
    return met.select("a", "b", "na", "nb", "ia", "ib")


class _Compared:
    """Exact comparison of pairs; the rows of the matrix are made once per document and kept."""

    def __init__(self, docs: DataFrame, width: int, percent: int) -> None:
        self.docs, self.width, self.percent = docs.select("doc_id", "text"), width, percent
        self.rows: DataFrame | None = None
        self.made: list[DataFrame] = []

    def linked(self, pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")  # what is left of them decides how they meet the rows
        ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
        if self.rows is not None:
            ids = ids.join(self.rows.select("id"), "id", "left_anti")
        ids = stored(ids, "ids")  # its size decides whether it is broadcast or the texts are shuffled
        texts = self.docs.join(ids, self.docs["doc_id"] == ids["id"], "left_semi")
        made = stored(texts.mapInArrow(_rows(self.width), "id long, grams array<long>"), "rows")
        drop(ids)
        self.made.append(made)
        self.rows = made if self.rows is None else self.rows.unionAll(made)
        a = self.rows.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
        b = self.rows.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
        both = F.size(F.array_intersect("ga", "gb"))
        enough = 100 * both >= self.percent * (F.size("ga") + F.size("gb") - both)
        links = stored(pairs.join(a, "a").join(b, "b").where(enough).select("a", "b"), "linked")
        drop(pairs)
        return links


def _keyed_rows(width: int):
    """k1, k2, grams of every text with n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for texts in texts_of(batch):
                sets = [g for g in shingle_sets(texts, hasher, width) if len(g)]
                if not sets:
                    continue
                keys = np.array([_keys(g) for g in sets], np.uint64).view(np.int64)
                ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int64())
                grams = pa.LargeListArray.from_arrays(ends, pa.array(np.concatenate(sets).view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), grams], ["k1", "k2", "grams"])

    return run


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of `a` with all of `b`."""
    sizes = [len(g) for g in (*a, *b)]
    _, column, often = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    shared = often[column] > 1
    row, column = row[shared], (np.cumsum(often > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(a), len(b)))
    count = int((often > 1).sum())
    for first in range(0, count, width):
        low, high = np.searchsorted(column, [first, first + width])
        cells = np.zeros((len(sizes), min(width, count - first)), np.float32)
        cells[row[low:high], column[low:high] - first] = 1
        out += cells[: len(a)] @ cells[len(a) :].T
    return out


def _counted_links(percent: int):
    """For the classes of two blocks: the documents at the other ends of their links."""

    def run(table: pa.Table) -> pa.Table:
        left = table.column("block").to_numpy() == table.column("low")[0].as_py()
        grams = [np.asarray(g.values) for g in table.column("grams")]
        weight = table.column("weight").to_numpy()
        inside = table.column("low")[0] == table.column("high")[0]
        x = np.flatnonzero(left)
        y = x if inside else np.flatnonzero(~left)
        found = np.zeros(len(weight), np.int64)
        if len(x) and len(y):
            size = np.array([len(g) for g in grams])
            both = _overlaps([grams[k] for k in x], [grams[k] for k in y])
            linked = 100 * both >= percent * (size[x][:, None] + size[y][None, :] - both)
            if inside:
                np.fill_diagonal(linked, False)
            found[x] = linked @ weight[y]
            if not inside:
                found[y] = weight[x] @ linked
        return pa.table({"k1": table.column("k1"), "k2": table.column("k2"), "links": pa.array(found)})

    return run


def link_counts(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (documents that it links with) for every row."""
    facts, member, classes = _grouped(docs, width, percent)
    sized = member.groupBy("k1", "k2").agg(F.count_distinct("doc_id").alias("weight"), F.min("id").alias("id"), F.first("n").alias("n"))
    sized = stored(sized.join(classes, ["k1", "k2"]), "sized")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int")
    wide = sized.groupBy("component").agg(F.count("*").alias("rows"), blocks.alias("blocks")).where("rows > 1").drop("rows")
    dealt = sized.join(wide, "component").withColumn("block", F.pmod(F.xxhash64("k1", "k2"), F.col("blocks")).cast("int"))
    dealt = stored(dealt.select("k1", "k2", "id", "weight", "component", "blocks", "block"), "dealt")

    source = docs.select("doc_id", "text")
    ids = dealt.select("id").distinct()
    texts = source.join(ids, source["doc_id"] == ids["id"], "left_semi").select("text")
    rows = texts.mapInArrow(_keyed_rows(width), "k1 long, k2 long, grams array<long>").dropDuplicates(["k1", "k2"])
    met = rows.join(dealt.drop("id"), ["k1", "k2"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("k1", "k2", "grams", "weight", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    found = met.groupBy("component", "low", "high").applyInArrow(_counted_links(percent), "k1 long, k2 long, links long")
    found = found.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    found = stored(sized.join(found, ["k1", "k2"], "left").select("k1", "k2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "counts")

    out = _shown(facts, classes).join(found, ["k1", "k2"], "left")
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0)))
    return out.select("doc_id", "n_shingles", "component_id", n_links.alias("n_links"))


def _shown(facts: DataFrame, classes: DataFrame) -> DataFrame:
    out = facts.select("doc_id", "n", "k1", "k2").join(classes, ["k1", "k2"], "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    return out.select("k1", "k2", "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def similar_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every row."""
    facts, _, classes = _grouped(docs, width, percent)
    return _shown(facts, classes).drop("k1", "k2")


def _grouped(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts of every row, the classes of known rows, and each class's component."""
    source = docs.select("doc_id", "text")
    fields = ", ".join(f"{c} long" for c in ["doc_id", "n", "k1", "k2", *_SKETCH])
    facts = stored(source.mapInArrow(_facts(width), f"{fields}, wide array<long>"), "facts")
    known = facts.where("n > 0 and doc_id is not null")
    nodes = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ["n", *_SKETCH, "wide"]])
    # An id with several texts is compared with all of them, so the parities of one of them say too little.
    several = known.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("k1", "k2")])
    several = several.where("min_k1 != max_k1 or min_k2 != max_k2").select(F.col("doc_id").alias("id"), F.lit(True).alias("several"))
    nodes = nodes.join(several, "id", "left").withColumn("wide", F.when(F.col("several").isNull(), F.col("wide"))).drop("several")
    nodes = stored(nodes, "nodes")
    member = stored(known.select("doc_id", "k1", "k2", "n").join(nodes.select("id", "k1", "k2"), ["k1", "k2"]), "members")

    halves = source.mapInArrow(_counted(width, percent), "half int").groupBy("half").agg(F.count("*").alias("n"))
    halves = stored(halves.where(F.col("n") >= OFTEN), "halves")
    bounds = [OFTEN << k for k in range(40)]
    with shuffles_released(docs.sparkSession):
        above = halves.agg(*[F.count(F.when(F.col("n") >= n, 1)) for n in bounds]).first()
    least = next(n for n, count in zip(bounds, above, strict=True) if count <= MOST_OFTEN or n == bounds[-1])
    often = np.sort(np.array([r["half"] for r in halves.where(F.col("n") >= least).collect()], np.int32))
    drop(halves)

    blocks = source.mapInArrow(_blocks(width, percent, often), "h long, doc_id long, place int, last boolean")
    column = Window.partitionBy("h")
    few = blocks.where("not last").withColumn("rows", F.count("*").over(column)).where("rows > 1")  # about `least` rows a column
    late = blocks.where("last")
    places = stored(few.select("h", "doc_id", "place").unionAll(late.select("h", "doc_id", "place")), "places")
    cells = places.join(member.select("doc_id", "id", "n"), "doc_id").groupBy("h", "id").agg(F.min("place").alias("place"), F.first("n").alias("n"))
    cells = stored(cells, "cells")
    drop(places)

    # Three rows of each column that all others meet.
    row = F.struct("id", "n", "place")
    drawn = F.min(F.struct(F.xxhash64("id").alias("draw"), row.alias("row")))["row"]
    hubs = cells.groupBy("h").agg(F.min(row).alias("x"), F.max(row).alias("y"), drawn.alias("z")).where("x.id < y.id")
    hubs = hubs.select("h", F.explode(F.array_distinct(F.array("x", "y", "z"))).alias("hub")).select("h", F.col("hub.id").alias("hub"), F.col("hub.n").alias("m"), F.col("hub.place").alias("at"))
    can_link = _close("n", "m", percent) & _reaches("n", "place", "m", "at", percent)
    star = cells.join(hubs, "h").where((F.col("id") != F.col("hub")) & can_link)
    star = star.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    star = stored(star, "star")

    compared = _Compared(source, width, percent)
    links = compared.linked(_within_parities(star, nodes, percent))
    roots = stored(components(links, rounds=2), "roots")

    # Columns whose rows are not yet in one component.
    placed = cells.join(roots, cells["id"] == roots["node"], "left")
    placed = placed.select("h", "id", "place", "n", F.coalesce("root", "id").alias("root"))
    mixed = placed.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows"))
    mixed = mixed.where("low < high").select("h", "rows")
    placed = stored(placed.join(mixed, "h"), "placed")
    drop(cells, roots)
    few = _met(placed.where(F.col("rows") <= CROWDED), percent, parities=False)
    crowd = placed.where(F.col("rows") > CROWDED).join(nodes.select("id", *_SKETCH), "id")
    met = few.unionAll(_met(crowd, percent, parities=True))
    shared = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("got"), F.max("ia").alias("ia"), F.max("ib").alias("ib"))
    to_come = F.least(F.col("na") - F.col("ia") - 1, F.col("nb") - F.col("ib") - 1)
    shared = shared.where((F.col("got") + to_come) * (100 + percent) >= percent * (F.col("na") + F.col("nb")))
    fresh = shared.select("a", "b").join(star, ["a", "b"], "left_anti")
    more = compared.linked(_within_parities(fresh, nodes, percent))
    drop(placed, star, nodes, *compared.made)

    found = stored(components(links.unionAll(more)), "components")
    drop(links, more)
    of_node = member.select("id", "k1", "k2").distinct().join(found, F.col("id") == F.col("node"), "left")
    of_node = stored(of_node.groupBy("k1", "k2").agg(F.min(F.coalesce("root", "id")).alias("component")), "classes")
    drop(found)
    return facts, member, of_node


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows whose doc_id is its component's smallest, and rows without doc_id.

    Repeated rows of one id and text stay once; different texts of one id all stay.
    """
    best = similar_groups(docs, width, percent).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id is not null").join(best, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id is null"))
