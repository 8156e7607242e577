"""Memory of the merge of repeated strings follows a bound, not the size of a partition."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import repeats


def segments(rng, anchors, each):
    """a, doc_id, at, n, body: sorted by anchor; neighbours of one anchor share most strings."""
    rows, doc = [], 0
    for a in range(anchors):
        body = bytes(rng.choice(b"abcdef") for _ in range(140))
        for _ in range(each):
            k = rng.randrange(140)
            rows.append((a, doc, 0, 41, body[:k] + b"x" + body[k + 1 :]))
            doc += 1
    return rows


def batches(rows, size):
    for first in range(0, len(rows), size):
        a, doc, at, n, body = zip(*rows[first : first + size], strict=True)
        columns = [*(pa.array(c, pa.int64()) for c in (a, doc, at, n)), pa.array(body, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "doc_id", "at", "n", "body"])


def settled(rows, size, often=()):
    """Places that are gone, and (digest, place) of what is to meet again."""
    gone, strings = set(), []
    for batch in repeats._settled(100, np.array(often, np.uint64))(batches(rows, size)):
        for r in batch.to_pylist():
            if r["w1"] is None:
                gone |= {(r["doc_id"], r["at"] + k) for k in range(r["n"])}
            else:
                strings.append((r["w1"], r["w2"], r["doc_id"], r["at"]))
    return gone, strings


def plain(rows):
    seen, gone = set(), set()
    for a, doc, at, n, body in sorted(rows, key=lambda r: r[1:3]):
        for k in range(n):
            key = (a, body[k : k + 100])
            if key in seen:
                gone.add((doc, at + k))
            seen.add(key)
    return gone


@pytest.mark.parametrize("size", [7, 1_000])
def test_merged_orders_are_let_go_at_the_end_of_an_anchor(monkeypatch, size):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 1_000)
    monkeypatch.setattr(repeats, "UNIT_BYTES", 4_000)
    held, merge = [], repeats.merge

    def watched(x, y, length):
        held.append(len(x.words) + len(y.words))
        return merge(x, y, length)

    monkeypatch.setattr(repeats, "merge", watched)
    rows = segments(random.Random(31), 60, 12)  # 101,000 bytes; an anchor has 1,680
    gone, strings = settled(rows, size)
    assert gone == plain(rows) and not strings
    assert held and max(held) <= 4_000 + 1_680 + 1_000


@pytest.mark.parametrize("size", [7, 1_000])
def test_an_anchor_larger_than_the_bound_stays_whole(monkeypatch, size):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 500)
    monkeypatch.setattr(repeats, "UNIT_BYTES", 1_000)
    rows = segments(random.Random(32), 3, 50)
    assert settled(rows, size)[0] == plain(rows)


@pytest.mark.parametrize("size", [7, 1_000])
def test_frequent_anchors_meet_again_by_digests(monkeypatch, size):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 500)
    monkeypatch.setattr(repeats, "UNIT_BYTES", 1_000)
    rows = segments(random.Random(33), 2, 40)
    gone, strings = settled(rows, size, often=[1])
    first = {}
    for w1, w2, doc, at in sorted(strings, key=lambda s: s[2:]):
        if first.setdefault((w1, w2), (doc, at)) != (doc, at):
            gone.add((doc, at))
    assert len(first) < len(strings)  # the bound cut this anchor
    assert gone == plain(rows)
