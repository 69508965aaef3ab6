from __future__ import annotations

import tracemalloc

import numpy as np

from pulsegrid.llm import common as C


def test_hashes_of_spans_in_plain_integers():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 3 * C._STEP + 5).astype(np.uint8)
    prefix, total = C.prefix_hash(data), 0
    for i, x in enumerate(data.tolist()):
        assert int(prefix[i]) == total
        total = (total + (x + 1) * pow(C._BASE, i, 1 << 64)) % (1 << 64)
    assert int(prefix[-1]) == total
    # the same string wherever it stands, across the steps of the powers too
    word = np.arange(9, dtype=np.uint8)
    starts = np.array([0, 11, C._STEP - 4, C._STEP + 20, 2 * C._STEP - 1, 3 * C._STEP - 4])
    for s in starts:
        data[s : s + 9] = word
    assert len(np.unique(C.span_hash(C.prefix_hash(data), starts, starts + 9))) == 1
    assert len(C.prefix_hash(data[:0])) == 1


def test_a_worker_keeps_nothing_of_a_block():
    data = np.frombuffer(b"some words of a text " * 150_000, np.uint8)
    tracemalloc.start()
    try:
        found = int(C.Tokens(data, np.array([0, len(data)])).count[0])
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert found == 750_000 and kept < 1 << 20
