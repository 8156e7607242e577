"""Measures the byte-wise merge of two Burrows-Wheeler transforms, which the repeats operator departs from.

python -m tests.llm.measure_merge <documents.parquet> <megabytes a shard>

Two shards of real texts are transformed; their interleave is refined one byte a round, each round a stable
distribution of the bytes before all suffixes, for as many rounds as a repeat is long. Prints seconds for a
gigabyte and for one level of merging, and checks the order on a part.
"""

from __future__ import annotations

import sys
import time

import numpy as np
import pyarrow.parquet as pq

from tallyspark.llm.repeats import LENGTH

SEPARATOR = 0xF9  # above all bytes of UTF-8, as those are shifted by 2 to leave room for two ends


def suffixes(data: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling; the last byte is the smallest and unique."""
    rank = data.astype(np.int64)
    width = 1
    while True:
        later = np.full(len(data), -1, np.int64)
        later[:-width] = rank[width:]
        keys = rank * (len(data) + 256) + later + 1
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(data), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        rank = np.empty(len(data), np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all():
            return order
        width *= 2


def shards(path: str, size: int) -> list[np.ndarray]:
    """Two runs of texts of about `size` bytes, each with its own end."""
    out, held, total = [], [], 0
    for text in pq.read_table(path, columns=["text"]).column("text").to_pylist():
        held.append(np.frombuffer((text or "").encode(), np.uint8) + np.uint8(2))
        held.append(np.array([SEPARATOR], np.uint8))
        total += len(held[-2]) + 1
        if total >= size:
            out.append(np.concatenate([*held, np.array([len(out)], np.uint8)]))
            held, total = [], 0
            if len(out) == 2:
                return out
    raise ValueError("the table is smaller than two shards")


def merged(before: list[np.ndarray], rounds: int) -> np.ndarray:
    """Which rows of the merged order come from the second transform."""
    from_second = np.repeat([False, True], [len(b) for b in before])
    chars = np.empty(len(from_second), np.uint8)
    for _ in range(rounds):
        chars[~from_second], chars[from_second] = before
        from_second = from_second[np.argsort(chars, kind="stable")]
    return from_second


def main(path: str, megabytes: str) -> None:
    both = shards(path, int(float(megabytes) * 1e6))
    size = sum(map(len, both))
    began = time.process_time()
    orders = [suffixes(data) for data in both]
    built = time.process_time() - began
    before = [data[order - 1] for data, order in zip(both, orders, strict=True)]
    began = time.process_time()
    from_second = merged(before, LENGTH)
    took = time.process_time() - began
    places = np.empty(size, np.int64)
    places[~from_second], places[from_second] = orders
    last = b""
    for row in range(min(size, 200_000)):
        prefix = both[int(from_second[row])][places[row] : places[row] + LENGTH].tobytes()
        assert last[: min(len(last), len(prefix))] <= prefix, row
        last = prefix
    print(f"{size / 1e6:.1f} MB: transforms {built / size * 1e9:.0f} CPU seconds a GB, one level of merging {took / size * 1e9:.0f}")
    print(f"bytes moved by the rounds of one level: {LENGTH} x input")


if __name__ == "__main__":
    main(*sys.argv[1:])
