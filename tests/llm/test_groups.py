"""N-gram join, repeated strings and decontamination against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import decontamination, ngram_join, repeats
from tallyspark.llm.components import components
from tests.llm.conftest import SCHEMA, invented

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def plain_groups(rows):
    """{doc_id: (size, component)} by comparing all pairs; rows of one id and text are one."""
    docs = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(docs[a] & docs[b])
            if both and 100 * both >= 80 * (len(docs[a]) + len(docs[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(docs[d]), find(d)) for d in ids}


def chained(seed, n):
    """Near copies of copies, so that components are longer than single links."""
    rng = random.Random(seed)
    rows, text = [], invented(rng, 150).split()
    for k in range(n):
        if k % 7 == 0:
            text = invented(rng, rng.randint(40, 200)).split()
        text = list(text)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(["alpha", "beta", "gamma"])
        rows.append((k * 3, " ".join(text), None, None, 0, None, None, None, None))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("often,crowded", [(64, 64), (2, 3)])
def test_groups_equal_all_pairs(spark, monkeypatch, often, crowded):
    monkeypatch.setattr(ngram_join, "OFTEN", often)  # 2: nearly all shared columns go last
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    rows = chained(1, 70)
    found = ngram_join.similar_groups(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == plain_groups(rows)


def plain_links(rows):
    """{(doc_id, n-grams): links} by comparing all pairs."""
    nodes = {(r[0], frozenset(shingles(r[1]))) for r in rows if r[0] is not None}

    def linked(a, b):
        both = len(a & b)
        return both and 100 * both >= 80 * (len(a) + len(b) - both)

    return {x: sum(bool(x != y and linked(x[1], y[1])) for y in nodes) for x in nodes}


@pytest.mark.parametrize("block,grams", [(256, 1 << 20), (3, 1 << 20), (256, 500)])
def test_links_equal_all_pairs(spark, odd_docs, odd_rows, monkeypatch, block, grams):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", grams)
    base = invented(random.Random(9), 150).split()
    near = [(1_000 + k, " ".join([*base[: 4 * k], f"new{k}", *base[4 * k + 1 :]]), *[None] * 7) for k in range(30)]
    rows = [tuple(r) for r in chained(1, 40)] + near + [(2_000, near[0][1], *[None] * 7), (1_001, near[2][1], *[None] * 7)]
    rows = [(*r[:4], 0, *r[5:]) for r in rows]
    for docs, given in ((spark.createDataFrame(rows, SCHEMA).repartition(4), rows), (odd_docs, odd_rows)):
        want = plain_links(given)
        found = ngram_join.link_counts(docs).collect()
        assert len(found) == len(given)
        if given is rows:
            assert max(want.values()) >= 30  # near copies link with each other, not only with three of them
        got = sorted((r.doc_id, r.n_shingles, r.n_links) for r in found if r.doc_id is not None)
        assert got == sorted((r[0], len(shingles(r[1])), want[r[0], frozenset(shingles(r[1]))]) for r in given if r[0] is not None)
        assert all(r.n_links is None for r in found if r.doc_id is None)


def test_links_of_nothing(no_docs):
    assert ngram_join.link_counts(no_docs).collect() == []


def test_overlaps_in_chunks():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 30)) for _ in range(9)]
    found = ngram_join._overlaps(sets[:4], sets[4:], width=7)
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]


def test_groups_of_odd_rows(odd_docs, odd_rows):
    found = ngram_join.similar_groups(odd_docs).collect()
    assert len(found) == len(odd_rows)
    want = plain_groups(odd_rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]


def test_groups_of_nothing(no_docs):
    assert ngram_join.similar_groups(no_docs).collect() == []
    assert ngram_join.keep_one(no_docs).collect() == []


def test_one_of_each_group_stays(odd_docs, odd_rows):
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    want = {d for d, (_, c) in plain_groups(odd_rows).items() if d == c}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {**{k: 0 for k in range(1, 41)}, 101: 100}


def plain_repeats(rows, length):
    seen, out = set(), {}
    for d, text in sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=lambda x: (x[0], repeats.text_place((x[1] or "").encode()))):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if b[s : s + length] in seen:
                gone[s : s + length] = True
            seen.add(b[s : s + length])
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out[d, len(b)] = (len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("often,shard", [(50, 1 << 21), (2, 3_000)])
def test_repeats_equal_plain_search(spark, odd_docs, odd_rows, monkeypatch, often, shard):
    monkeypatch.setattr(repeats, "OFTEN_IN_SAMPLE", often)
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
    rng = random.Random(9)
    passages = [invented(rng, 40) for _ in range(5)]
    rows = [
        (k + 100, invented(rng, rng.randint(5, 60)) + " " + rng.choice(passages) + " " + invented(rng, 30) + rng.choice(passages), *[None] * 7)
        for k in range(60)
    ]
    docs = odd_docs.unionAll(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    found = repeats.remove_repeats(docs).collect()
    want = plain_repeats(odd_rows + rows, 100)
    for r in found:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, r.n_bytes]
            assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert len(found) == len(odd_rows) + 60


def test_texts_that_share_an_id_are_not_pooled(spark):
    """Copies, and texts that occur nowhere else, under one id and under others."""
    rng = random.Random(21)
    parts = [invented(rng, 60 + k) for k in range(8)]
    rows = [(7, parts[0]), (7, parts[1]), (7, parts[2] + parts[0]), (7, parts[0]), (3, parts[1]), (9, parts[3] + parts[2]), (9, parts[4]), (8, parts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_repeats(rows, 100)
    found = repeats.remove_repeats(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, r.n_bytes]


def test_different_texts_of_one_id_stay(spark):
    """Near duplicates go, whatever their id; texts that only share an id do not."""
    rng = random.Random(22)
    a, b, c = (invented(rng, 80) for _ in range(3))
    rows = [(7, a, "x"), (7, b, "x"), (7, a, "x"), (8, a + " more", "y"), (9, c, "z"), (None, c, "z"), (None, c, "z")]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, k1 string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, c), (0, c), (7, a), (7, b), (9, c)])


def test_repeats_in_a_text_longer_than_a_slice(spark):
    rng = random.Random(2)
    body = "".join(rng.choice("abcdef ") for _ in range(1_300_000))
    text = body + "#" + body[1_000_000:1_200_000]
    found = repeats.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (found.n_bytes, found.n_removed, found.n_spans) == (1_500_001, 200_000, 1)


def test_repeats_of_nothing(no_docs):
    assert repeats.remove_repeats(no_docs).collect() == []


def test_merge_keeps_byte_order():
    rng = random.Random(6)
    bodies = [bytes(rng.choice(b"ab") for _ in range(150)) for _ in range(40)]
    bodies += [b"b" * 20 + bodies[0][:130], bodies[3]]
    ids, at = np.arange(len(bodies)), np.zeros(len(bodies), np.int64)
    n = np.full(len(bodies), 51)
    half = len(bodies) // 2
    x, gone_x = repeats.shard_of(bodies[:half], ids[:half], at[:half], n[:half], ids[:half], 100)
    y, gone_y = repeats.shard_of(bodies[half:], ids[half:], at[half:], n[half:], ids[half:], 100)
    both, later = repeats.merge(x, y, 100)
    strings = [bodies[r][a : a + 100] for r, a in zip(both.row, both.at, strict=True)]
    assert strings == sorted({b[s : s + 100] for b in bodies for s in range(51)})
    assert len(strings) + len(gone_x[0]) + len(gone_y[0]) + len(later[0]) == 51 * len(bodies)


def norm(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_hits(rows, items):
    windows = {}
    for item, text in items:
        w = norm(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    out = {}
    for r in rows:
        w, hit, found = norm(r[1]), set(), set()
        for g, names in windows.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found |= names
        out[r[0]] = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


@pytest.fixture()
def items(spark, odd_rows):
    long = odd_rows[12][1].split()
    rows = [(1, " ".join(long[30:60])), (2, None), (3, ""), (4, "ONE, two"), (5, " ".join(long[40:53])), (5, "wörd"), (6, " ".join(odd_rows[5][1].split()[:13]))]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, gram string")


def test_contamination_equals_plain_search(odd_docs, odd_rows, items, monkeypatch):
    want = plain_hits(odd_rows, items[0])
    # Windows broadcast, only their hashes, and nothing.
    for limit, each in ((1 << 26, 32), (1, 0), (0, 32)):
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(decontamination, "HASH_BYTES", each)
        found = decontamination.contamination(odd_docs, items[1]).collect()
        assert len(found) == len(odd_rows)
        for r in found:
            assert (r.n_words, r.n_hit, r.item_ids, r.contaminated) == want[r.doc_id]


def test_windows_cross_chunks(odd_docs, odd_rows, items, monkeypatch):
    monkeypatch.setattr(decontamination, "CHUNK", 7)
    found = decontamination.contamination(odd_docs, items[1]).collect()
    assert {r.doc_id: r.n_hit for r in found} == {k: v[1] for k, v in plain_hits(odd_rows, items[0]).items()}


def test_removal_of_documents_and_spans(odd_docs, odd_rows, items):
    want = plain_hits(odd_rows, items[0])
    kept = decontamination.decontaminate(odd_docs, items[1])
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in odd_rows if not want[r[0]][3])
    for r in decontamination.decontaminate(odd_docs, items[1], remove="spans").collect():
        before = next(x[1] for x in odd_rows if x[0] == r.doc_id)
        if want[r.doc_id][1] == 0:
            assert r.text == before
        else:
            assert len(norm(r.text)) == want[r.doc_id][0] - want[r.doc_id][1]
    with pytest.raises(ValueError):
        decontamination.decontaminate(odd_docs, items[1], remove="lines")


def test_rows_that_share_an_id_or_have_none(spark, odd_rows, items):
    """Each text is judged by its own words; columns named like the operator's own do not clash."""
    bad = " ".join(odd_rows[12][1].split()[30:60])
    rows = [(7, bad), (7, "three clean words"), (None, bad), (None, "four more clean words"), (8, "ab"), (7, bad)]
    names = ["__doc", "__hit", "__digest", "digest", "hit", "row", "bad_id", "item_ids", "n_hit"]
    schema = "doc_id long, text string, " + ", ".join(f"{name} string" for name in names)
    docs = spark.createDataFrame([(*r, *names) for r in rows], schema).repartition(2)
    judged = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.contaminated) for r in decontamination.contamination(docs, items[1]).collect())
    assert judged == [(0, 4, 0, False), (0, 30, 30, True), (7, 3, 0, False), (7, 30, 30, True), (7, 30, 30, True), (8, 1, 0, False)]
    clean = decontamination.decontaminate(docs, items[1])
    assert clean.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in clean.collect()) == [(0, "four more clean words"), (7, "three clean words"), (8, "ab")]
    cut = decontamination.decontaminate(docs, items[1], remove="spans")
    assert cut.columns == docs.columns and sorted((r.doc_id or 0, r.text) for r in cut.collect())[:3] == [(0, ""), (0, "four more clean words"), (7, "")]


def test_no_documents_or_no_benchmark(odd_docs, no_docs, items, odd_rows):
    assert decontamination.contamination(no_docs, items[1]).collect() == []
    assert decontamination.decontaminate(odd_docs, items[1].limit(0)).count() == len(odd_rows)


def test_only_ascii_letters_are_lowered(spark):
    points = [chr(p) for p in range(1, 0x110000) if not 0xD800 <= p <= 0xDFFF]
    rows = [("".join(f"aB{c}C " for c in points[i : i + 500]),) for i in range(0, len(points), 500)] + [(points[i],) for i in range(0x600)]
    frame = spark.createDataFrame(rows, "text string")
    for text, lowered, tokens in frame.select("text", decontamination.lower_ascii(F.col("text")), decontamination.words(F.col("text"))).collect():
        assert lowered == text.translate(LOWER)
        assert tokens == norm(text)
    texts = [None, "", " ", "one", " One two", "TWO 2-\n", "-", "ÄB.cd", "a\u2028b"]
    counts = spark.createDataFrame([(t,) for t in texts], "text string").select("text", decontamination.count_words(F.col("text"))).collect()
    assert [n for _, n in counts] == [len(norm(t)) for t in texts]


def test_windows_of_one_text_hash_as_their_words(spark):
    tokens = "a b c d e f g h i j k l m a b".split()
    row = spark.range(1).select(decontamination._window_hashes(F.array(*map(F.lit, tokens)), [1, 2, 3, 7, 8, 13]).alias("h")).first()
    counts = {x["width"]: len(x["hashes"]) for x in row.h}
    assert counts == {w: len(tokens) - w + 1 for w in (1, 2, 3, 7, 8, 13)}
    by_width = {x["width"]: x["hashes"] for x in row.h}
    assert by_width[2][0] == by_width[2][13] and len(set(by_width[13])) == 3 and len(set(by_width[3])) == 13


def test_decontamination_plan_has_no_python(odd_docs, items):
    plan = decontamination.contamination(odd_docs, items[1])._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
