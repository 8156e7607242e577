"""Removal of long repeated strings: shard suffix orders, merged by interleave refinement.

A byte goes if a string of `LENGTH` bytes over it also starts earlier (in a document of smaller doc_id, or
earlier in the same one). Equal strings must be found across all documents, so they are first brought
together, and suffixes are ordered only where that decides something:

1. Each string has an anchor, the gram of `GRAM` bytes with the smallest hash in it (the leftmost of
   equals): equal strings have equal anchors at equal places. Neighbouring strings with one anchor are a
   segment, about one per 40 bytes. A segment is known by its anchor's hash and its content's hash.
2. One shuffle sorts segments by (anchor, content, document, place). Of equal segments all but the first
   are repeats as a whole; an anchor with one content is settled. What is left are first segments whose
   anchor has several contents: the ends of passages, and places where copies differ.
3. Their bytes are fetched and meet by anchor. In each task they form shards of about `SHARD_BYTES`.
   A shard is sorted once (prefix doubling) and kept as its Burrows-Wheeler order of distinct strings.
   Shards are merged without sorting their suffixes again: an interleave of the two orders is
   refined by the next 8 bytes at a time, only where a block of equal prefixes still holds rows of both
   shards. Blocks left after `LENGTH` bytes are common prefixes of that length: repeated intervals, whose
   earliest string stays and whose others are removed. A task's rows come sorted by anchor. Equal strings
   have one anchor, so at the end of an anchor, after about `UNIT_BYTES`, the merged order is complete and let
   go: memory follows that bound and the largest anchor, not the size of the partition.

Anchors that a sample of documents shows very often are dealt to many tasks by content; their distinct
strings are settled by one more aggregation on digests. The sample steers only the plan. Within a slice
of texts, equal segments are folded before the shuffle, so copies and periodic texts move few rows.

Null and empty texts have no bytes; texts shorter than `LENGTH` keep all. Rows without doc_id are not
compared and keep all. Repeated rows of one id with the same text count once and get the same result;
different texts of one id are documents of their own, in the order of a 32-bit hash of the text, by which
they are told apart. Other columns are not read. Segments are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import stored
from tallyspark.llm.textbytes import CODES, Hasher, mix, texts_of

LENGTH = 100
GRAM = 24
SHARD_BYTES = 1 << 20
UNIT_BYTES = 2 << 20  # a memory bound: about 40 times as much while its shards are merged
SAMPLE_DOCS = 20_000
OFTEN_IN_SAMPLE = 50
DEALT = 64

_LOW = np.uint64((1 << 20) - 1)  # place in a slice, below 44 bits of hash
_SPLIT = np.uint64(0xFFFFFFFF)
_CODES2 = mix(CODES + np.uint64(1))
_END = 0xFF  # no byte of UTF-8


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    out, span = x, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segments(data: np.ndarray, offsets: np.ndarray, hasher: Hasher, length: int = LENGTH, gram: int = GRAM):
    """Anchor hash, content hash, first start, number of starts and text number of each segment."""
    parts = []
    step = (1 << 20) - length
    for low in range(0, max(len(data) - length + 1, 0), step):  # one step, but for a long text
        piece = data[low : low + step + length - 1]
        hashes = hasher.windows(piece, gram)
        keyed = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (_sliding_least(keyed, length - gram + 1) & _LOW).astype(np.int64)
        start = np.arange(len(anchor))
        text = np.searchsorted(offsets, start + low, side="right") - 1
        inside = start + low + length <= offsets[text + 1]
        begins = inside.copy()
        begins[1:] &= (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(begins)
        if not len(first):
            continue
        last = np.minimum(np.append(first[1:], len(anchor)) - 1, offsets[text[first] + 1] - low - length)
        place = anchor[first]
        content = mix(hasher.ranges(piece, first, last + length, _CODES2) + (place - first).astype(np.uint64))
        parts.append((hashes[place], content, first + low, last - first + 1, text[first]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for texts in texts_of(batch):
                found = segments(texts.data, texts.offsets, hasher, length, gram)
                seen = np.unique(np.stack([found[0], found[4].astype(np.uint64)], 1), axis=0)[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64))], ["a"])

    return run


#: A place in a document: the start of a string, and above these bits a hash of the whole text, so
#: that places of different texts with one id do not meet.
_PLACE_BITS = 31


def text_place(data: bytes) -> int:
    """Place of a text's first byte among all texts of its id."""
    return int.from_bytes(hashlib.md5(data, usedforsecurity=False).digest()[:4], "big") << _PLACE_BITS


def _as_before(*keys: np.ndarray) -> np.ndarray:
    """Which rows equal the row before in all keys: places of documents that are repeated rows."""
    same = np.zeros(len(keys[0]), bool)
    same[1:] = np.logical_and.reduce([k[1:] == k[:-1] for k in keys])
    return same


def _segment_rows(length: int, gram: int, often: np.ndarray):
    """a, c, doc_id, at, n, part: n strings from `at`; settled runs have negative n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            number, valid = np.asarray(ids.fill_null(0)), np.asarray(ids.is_valid())
            for texts in texts_of(batch):
                a, c, first, n, text = segments(texts.data, texts.offsets, hasher, length, gram)
                row = texts.first + text
                known = valid[row]
                a, c, n, row = a[known], c[known], n[known], row[known]
                held = np.unique(text[known])
                bases = np.zeros(len(texts.offsets) - 1, np.int64)
                bases[held] = [text_place(texts.data[texts.offsets[k] : texts.offsets[k + 1]].tobytes()) for k in held]
                at = first[known] - texts.offsets[text[known]] + bases[text[known]]
                doc = number[row]
                order = np.lexsort((at, doc, c, a))
                order = order[~_as_before(a[order], c[order], doc[order], at[order])]
                a, c, doc, at, n = a[order], c[order], doc[order], at[order], n[order]
                fresh = np.ones(len(a), bool)
                fresh[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
                # Folded segments, joined where they touch.
                settled = np.flatnonzero(~fresh)
                settled = settled[np.lexsort((at[settled], doc[settled]))]
                sd, sa, sn = doc[settled], at[settled], n[settled]
                opens = np.ones(len(sd), bool)
                opens[1:] = (sd[1:] != sd[:-1]) | (sa[1:] > sa[:-1] + sn[:-1])
                cut = np.flatnonzero(opens)
                run_end = np.maximum.reduceat(sa + sn, cut) if len(cut) else sa
                a, c, doc, at, n = a[fresh], c[fresh], doc[fresh], at[fresh], n[fresh]
                hot = np.isin(a, often)
                part = np.where(hot, mix(a + c % np.uint64(DEALT)), a)
                columns = [
                    np.concatenate([a.view(np.int64), np.zeros(len(cut), np.int64)]),
                    np.concatenate([c.view(np.int64), np.zeros(len(cut), np.int64)]),
                    np.concatenate([doc, sd[cut]]),
                    np.concatenate([at, sa[cut]]),
                    np.concatenate([n, sa[cut] - run_end]),
                    (np.concatenate([part, mix(sd[cut].astype(np.uint64))]) >> np.uint64(33)).astype(np.int32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "c", "doc_id", "at", "n", "part"])

    return run


def _sorted_out(often: np.ndarray):
    """From rows sorted by (a, c, doc_id, at): repeats (a is null) and open first segments."""

    def rows(a, doc, at, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([a, pa.array(doc), pa.array(at), pa.array(n)], ["a", "doc_id", "at", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before
        waiting = None  # the latest first segment: a, doc, at, n, whether its anchor had another before it

        for batch in batches:
            a, c, doc, at, n = (np.asarray(batch.column(k)) for k in ("a", "c", "doc_id", "at", "n"))
            if not len(a):
                continue
            ready = n < 0
            fresh = np.ones(len(a), bool)
            fresh[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
            same = _as_before(a, c, doc, at)
            if last is not None:
                fresh[0] = (int(a[0]), int(c[0])) != last[:2]
                same[0] = (int(a[0]), int(c[0]), int(doc[0]), int(at[0])) == last
            last = (int(a[-1]), int(c[-1]), int(doc[-1]), int(at[-1]))
            gone = ready | (~fresh & ~same)
            yield rows(pa.nulls(int(gone.sum()), pa.int64()), doc[gone], at[gone], np.abs(n[gone]))
            first = np.flatnonzero(fresh & ~ready)
            fa, fd, ft, fn = a[first], doc[first], at[first], n[first]
            before = np.zeros(len(first), bool)
            if waiting is not None:
                fa, fd, ft, fn = (np.append(w, x) for w, x in zip(waiting[:4], (fa, fd, ft, fn), strict=True))
                before = np.append(waiting[4], before)
            if not len(fa):
                continue
            same = fa[1:] == fa[:-1]
            before[1:] |= same
            mixed = before.copy()
            mixed[:-1] |= same
            mixed |= np.isin(fa.view(np.uint64), often)
            waiting = (fa[-1:], fd[-1:], ft[-1:], fn[-1:], before[-1:])
            keep = np.flatnonzero(mixed[:-1])
            yield rows(pa.array(fa[keep]), fd[keep], ft[keep], fn[keep])
        if waiting is not None and (waiting[4][0] or np.isin(waiting[0].view(np.uint64), often)[0]):
            yield rows(pa.array(waiting[0]), *waiting[1:4])

    return run


def _contents(length: int):
    """The bytes of each open segment of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = batch.column("text")[row].as_py().encode()
                doc = batch.column("doc_id")[row].as_py()
                lists = batch.column("open")[row].values
                base = text_place(data)
                places = np.asarray(lists.field("at"))
                own = pa.array(np.flatnonzero(places >> _PLACE_BITS == base >> _PLACE_BITS))
                a, at, n = (lists.field(k).take(own) for k in ("a", "at", "n"))
                body = [data[s - base : s - base + k + length - 1] for s, k in zip(at.to_pylist(), n.to_pylist(), strict=True)]
                columns = [a, pa.array(np.full(len(body), doc, np.int64)), at, n, pa.array(body, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["a", "doc_id", "at", "n", "body"])

    return run


class Shard(NamedTuple):
    """Distinct strings in byte order; each by its earliest start."""

    words: np.ndarray  # 8-byte words at all places of the shard's bytes
    place: np.ndarray  # of each string in the shard's bytes
    doc: np.ndarray
    at: np.ndarray
    row: np.ndarray  # input row, for what is reported


def _words(data: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.full(8, _END, np.uint8)]).astype(np.uint64)
    out = padded[: len(data)].copy()
    for k in range(1, 8):
        out = (out << np.uint64(8)) | padded[k : k + len(data)]
    return out


def _ranks(words: np.ndarray, length: int, starts: np.ndarray) -> np.ndarray:
    """A rank of each start among all starts by its first `length` bytes; equal strings share one."""
    size = len(words)
    order = np.argsort(words, kind="stable")
    slots = np.arange(size)

    def heads(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        alone = new.copy()
        alone[:-1] &= new[1:]
        return at[head], alone

    head, alone = heads(words[order], slots)
    rank = np.empty(size + length + 64, np.int64)
    rank[size:] = 0
    rank[order] = head + 1
    active = slots[~alone]
    depth = 8
    while depth * 2 <= length and len(active):
        place = order[active]
        keys = (rank[place].astype(np.uint64) << np.uint64(32)) | rank[place + depth].astype(np.uint64)
        by = np.argsort(keys, kind="stable")
        order[active] = place[by]
        head, alone = heads(keys[by], active)
        rank[order[active]] = head + 1
        active = active[~alone]
        depth *= 2
    return (rank[starts].astype(np.uint64) << np.uint64(32)) | rank[starts + length - depth].astype(np.uint64)


def shard_of(bodies: list[bytes], doc: np.ndarray, at: np.ndarray, n: np.ndarray, row: np.ndarray, length: int):
    """The shard of some segments, and the (row, offset) of strings that start earlier in it as well."""
    data = np.frombuffer(b"\xff".join(bodies) + b"\xff", np.uint8)
    begin = np.cumsum([0, *(len(b) + 1 for b in bodies[:-1])])
    owner = np.repeat(np.arange(len(bodies)), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    place = begin[owner] + step
    words = _words(data)
    keys = _ranks(words, length, place)
    order = np.lexsort((at[owner] + step, doc[owner], keys))
    fresh = np.ones(len(order), bool)
    fresh[1:] = keys[order][1:] != keys[order][:-1]
    head = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    itself = (doc[owner[order]] == doc[owner[head]]) & (at[owner[order]] + step[order] == at[owner[head]] + step[head])
    kept, gone = order[fresh], order[~itself]
    shard = Shard(words, place[kept], doc[owner[kept]], at[owner[kept]] + step[kept], row[owner[kept]])
    return shard, (row[owner[gone]], at[owner[gone]] + step[gone])


def merge(x: Shard, y: Shard, length: int) -> tuple[Shard, tuple[np.ndarray, np.ndarray]]:
    """Both shards as one, by refining the interleave of their orders; and the later of equal strings."""
    size = len(x.place) + len(y.place)
    of_y = np.repeat([False, True], [len(x.place), len(y.place)])
    words = np.concatenate([x.words, y.words])
    place = np.concatenate([x.place, y.place + len(x.words)])
    slot = np.arange(size)  # rows that still share a block with rows of the other shard, in order
    block = np.zeros(size, np.int64)
    merged = np.arange(size)
    for depth in range(0, length, 8):
        row = merged[slot]
        key = words[place[row] + depth]
        if length - depth < 8:
            key = key >> np.uint64(8 * (8 - (length - depth)))
        # Within a block each shard's rows are in order already, so this stable sort only merges runs.
        by = np.lexsort((key, block))
        row, key, block = row[by], key[by], block[by]
        merged[slot] = row
        new = np.ones(len(row), bool)
        new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(new) - 1
        count = np.bincount(block, minlength=1) if len(block) else np.zeros(1, np.int64)
        from_y = np.bincount(block, weights=of_y[row], minlength=1) if len(block) else np.zeros(1)
        both = ((from_y > 0) & (from_y < count))[block] if len(block) else np.zeros(0, bool)
        slot, block = slot[both], block[both]
        if not len(slot):
            break
    # What is left are pairs of equal strings, next to each other.
    pair = merged[slot].reshape(-1, 2)
    doc, at, rows = (np.concatenate([getattr(x, f), getattr(y, f)]) for f in ("doc", "at", "row"))
    left, right = pair[:, 0], pair[:, 1]
    later = np.where((doc[left] < doc[right]) | ((doc[left] == doc[right]) & (at[left] <= at[right])), right, left)
    stays = np.ones(size, bool)
    stays[later] = False
    order = merged[stays[merged]]
    apart = (doc[left] != doc[right]) | (at[left] != at[right])  # not the same place of a repeated row
    return Shard(words, place[order], doc[order], at[order], rows[order]), (rows[later[apart]], at[later[apart]])


def _settled(length: int, often: np.ndarray):
    """doc_id, at, n, w1, w2: repeats in the open segments; first strings of frequent anchors with digests."""
    names = ["doc_id", "at", "n", "w1", "w2"]

    def found(doc: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Runs of neighbouring strings."""
        order = np.lexsort((at, doc))
        doc, at = doc[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)
        cut = np.flatnonzero(new)
        if len(cut):
            ends = np.append(cut[1:], len(at)) - 1
            none = pa.nulls(len(cut), pa.int64())
            columns = [pa.array(doc[cut]), pa.array(at[cut]), pa.array(at[ends] - at[cut] + 1), none, none]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: list[Shard] = []
        docs: list[np.ndarray] = []
        frequent: list[np.ndarray] = []
        held: list[pa.RecordBatch] = []
        size = rows = unit = 0

        def build() -> Iterator[pa.RecordBatch]:
            nonlocal size, rows
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            size = 0
            doc, at, n = (np.asarray(table.column(k).combine_chunks()) for k in ("doc_id", "at", "n"))
            docs.append(doc)
            frequent.append(np.isin(np.asarray(table.column("a").combine_chunks()).view(np.uint64), often))
            shard, gone = shard_of(table.column("body").to_pylist(), doc, at, n, rows + np.arange(len(doc)), length)
            yield from found(doc[gone[0] - rows], gone[1])
            rows += len(doc)
            # Shards of like size are merged, so each string takes part in few merges.
            while shards and len(shards[-1].place) <= 2 * len(shard.place):
                shard, gone = merge(shards.pop(), shard, length)
                yield from found(np.concatenate(docs)[gone[0]], gone[1])
            shards.append(shard)

        def complete() -> Iterator[pa.RecordBatch]:
            nonlocal rows, unit
            if held:
                yield from build()
            while len(shards) > 1:
                shard, gone = merge(shards.pop(), shards.pop(), length)
                yield from found(np.concatenate(docs)[gone[0]], gone[1])
                shards.append(shard)
            if shards:
                shard = shards[0]
                hot = np.concatenate(frequent)[shard.row]
                place = shard.place[hot]
                if len(place):
                    digest = [np.zeros(len(place), np.uint64), np.full(len(place), 7, np.uint64)]
                    with np.errstate(over="ignore"):
                        for depth in range(0, length, 8):
                            word = shard.words[place + depth]
                            if length - depth < 8:
                                word = word >> np.uint64(8 * (8 - (length - depth)))
                            digest = [mix(digest[0] * np.uint64(3) + word), mix((digest[1] ^ word) + np.uint64(depth))]
                    columns = [shard.doc[hot], shard.at[hot], np.ones(len(place), np.int64), *(d.view(np.int64) for d in digest)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
            for kept in (shards, docs, frequent):
                kept.clear()
            rows = unit = 0

        before = None  # the latest anchor
        for batch in batches:
            a = np.asarray(batch.column("a"))
            if not len(a):
                continue
            # Strings of an anchor stay together, but for frequent ones, whose digests meet once more.
            ends = np.isin(a.view(np.uint64), often)
            ends[1:] |= a[1:] != a[:-1]
            ends[0] |= a[0] != before
            before = a[-1]
            ends = np.append(np.flatnonzero(ends), len(a))
            total = np.cumsum(pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < len(a):
                done = int(total[first - 1]) if first else 0
                room, last = SHARD_BYTES - size, len(a)
                if unit < UNIT_BYTES:
                    room = min(room, UNIT_BYTES - unit)
                else:
                    last = int(ends[np.searchsorted(ends, first)])
                if last == first:
                    yield from complete()
                    continue
                last = min(last, int(np.searchsorted(total, done + room)) + 1)
                held.append(batch.slice(first, last - first))
                size += int(total[last - 1]) - done
                unit += int(total[last - 1]) - done
                first = last
                if size >= SHARD_BYTES:
                    yield from build()
        yield from complete()

    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, at, n: runs of n neighbouring starts (bytes) of strings that also start earlier.

    A start counts from the `text_place` of its text.
    """
    source = docs.select("doc_id", "text").where("doc_id is not null and octet_length(text) >= %d" % length)
    total = source.count()
    share = min(1_000_000, 1_000_000 * SAMPLE_DOCS // max(total, 1))
    sample = source.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    seen = sample.mapInArrow(_anchors(length, gram), "a long").groupBy("a").agg(F.count("*").alias("n"))
    # At most SAMPLE_DOCS * anchors of a document / OFTEN_IN_SAMPLE numbers; they steer only the partitioning.
    often = np.array([r["a"] for r in seen.where(F.col("n") >= OFTEN_IN_SAMPLE).collect()], np.int64).view(np.uint64)

    rows = source.mapInArrow(_segment_rows(length, gram, often), "a long, c long, doc_id long, at long, n long, part int")
    rows = rows.repartition("part").sortWithinPartitions("a", "c", "doc_id", "at").select("a", "c", "doc_id", "at", "n")
    marks = stored(rows.mapInArrow(_sorted_out(often), "a long, doc_id long, at long, n long"), "segments")

    per_doc = marks.where("a is not null").groupBy("doc_id").agg(F.collect_list(F.struct("a", "at", "n")).alias("open"))
    texts = source.join(per_doc.hint("shuffle_hash"), "doc_id")
    bodies = texts.mapInArrow(_contents(length), "a long, doc_id long, at long, n long, body binary")
    frequent = F.col("a").isin([int(a) for a in often.view(np.int64)]) if len(often) else F.lit(False)
    deal = F.when(frequent, F.pmod(F.xxhash64("body"), F.lit(DEALT))).otherwise(F.lit(0))
    dealt = bodies.withColumn("deal", deal).repartition("a", "deal").drop("deal").sortWithinPartitions("a")
    settled = stored(dealt.mapInArrow(_settled(length, often), "doc_id long, at long, n long, w1 long, w2 long"), "repeats")

    strings = settled.where("w1 is not null")
    earliest = strings.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    again = strings.join(earliest, ["w1", "w2"]).where(F.struct("doc_id", "at") != F.col("first"))
    return (
        marks.where("a is null")
        .select("doc_id", "at", "n")
        .unionAll(settled.where("w1 is null").select("doc_id", "at", "n"))
        .unionAll(again.select("doc_id", "at", "n"))
    )


def _kept(length: int, with_rest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for row in range(batch.num_rows):
                body = (batch.column("text")[row].as_py() or "").encode()
                data = np.frombuffer(body, np.uint8)
                runs = batch.column("runs")[row]
                gone = np.zeros(len(data) + 1, np.int64)
                if runs.is_valid:
                    at, n = (np.asarray(runs.values.field(k)) for k in ("at", "n"))
                    base = text_place(body)
                    own = at >> _PLACE_BITS == base >> _PLACE_BITS
                    at, n = at[own] - base, n[own]
                    np.add.at(gone, np.minimum(at, len(data)), 1)
                    np.add.at(gone, np.minimum(at + n + length - 1, len(data)), -1)
                gone = np.cumsum(gone[:-1]) > 0
                rest = data[~gone].tobytes()
                starts = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                for column, value in zip(
                    out, (len(data), int(gone.sum()), starts, hashlib.sha256(rest).hexdigest(), rest if with_rest else None), strict=True
                ):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_rest: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) for every row."""
    runs = repeated_runs(docs, length, gram).groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(runs.hint("shuffle_hash"), "doc_id", "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return rows.mapInArrow(_kept(length, with_rest), schema)
