from __future__ import annotations

import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from support import SF_DIRS, fresh_dir
from tokenizers import Tokenizer

from pulsegrid.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_pieces(rows, capacity=4096):
    """(doc_id, piece, start, length, crc) of every piece, written plainly."""
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            out.append((i, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check(got, want, capacity=4096):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    by = {}
    for *_, length, _, sequence, offset in got:
        by.setdefault(sequence, []).append((offset, length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_whole_table(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(SF_DIRS["0.001"] + "/documents.parquet").select("doc_id", "text").collect()]
    want = plain_pieces(rows)
    n = check([tuple(r) for r in P.query(spark, SF_DIRS["0.001"]).collect()], want)
    assert n == max(-(-sum(r[3] for r in want) // 4096), sum(r[3] > 2048 for r in want))


def test_edge_rows(spark, edge_docs, no_docs):
    path = fresh_dir("pg-pack-") + "/out"
    P.pack(edge_docs.repartition(3), path, PATH, capacity=100)
    rows = [(r[0], r[1]) for r in edge_docs.select("doc_id", "text").collect()]
    check([tuple(r) for r in P.read_pieces(spark, path).collect()], plain_pieces(rows, 100), 100)
    empty = fresh_dir("pg-pack-") + "/out"
    assert P.pack(no_docs, empty, PATH) == 0 and P.read_pieces(spark, empty).count() == 0


def test_words_of_earlier_blocks_are_remembered():
    encoder, asked = P.WordEncoder(PATH), []
    words = encoder._words
    encoder._words = lambda w: asked.extend(w.to_pylist()) or words(w)
    blocks = [["the first block", "has words"], ["the first words", "come again"], ["the block has words"]]
    got = [encoder(pa.array(b)) for b in blocks]
    assert sorted(asked) == sorted({w for b in blocks for t in b for w in t.split()})
    plain = [Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids for b in blocks for t in b]
    assert [i for ids, _ in got for i in ids.tolist()] == [i for t in plain for i in t]


def total(patterns, size):
    out = np.zeros(size, np.int64)
    for p in patterns:
        assert p.times > 0
        for length, n in p.slots:
            out[length] += n * p.times
    return out


def first_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - x)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece(seed):
    rng = np.random.default_rng(seed)
    capacity = [60, 200, 4096][seed % 3]
    lengths = np.minimum(rng.lognormal(np.log(capacity / [3, 40][seed % 2]), 1, 3000).astype(int) + 1, capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    patterns = P.plan_patterns(counts, capacity)
    assert (total(patterns, capacity + 1) == counts).all()
    assert all(sum(x * n for x, n in p.slots) <= capacity for p in patterns)
    n = sum(p.times for p in patterns)
    bound = max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))
    assert bound <= n <= first_fit(lengths.tolist(), capacity) + 1 and n <= bound * 1.02 + 1
    # the size of the plan follows the lengths, not the pieces
    more = P.plan_patterns(counts * 1_000_000, capacity)
    assert len(more) < 12 * capacity and sum(p.times for p in more) <= n * 1_000_000


def test_places_are_all_slots():
    counts = np.bincount([1] * 7 + [3] * 5 + [4] * 2 + [10] * 3, minlength=11)
    patterns = P.plan_patterns(counts, 10)
    places = P.Places(patterns, 10)
    seen = {}
    for length in np.flatnonzero(counts).tolist():
        r = np.arange(counts[length])
        for s, o in zip(*places.place(np.full(len(r), length), r), strict=True):
            seen.setdefault(int(s), []).append((int(o), length))
    assert len(seen) == sum(p.times for p in patterns)
    for pieces in seen.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [0, *itertools.accumulate(x for _, x in pieces)][:-1] and sum(x for _, x in pieces) <= 10


def test_complements():
    counts = np.zeros(101, np.int64)
    counts[[10, 20, 25, 30]] = 1
    sums = P._Sums(counts)
    assert sums.complement(30, {}) == (30,) and sums.complement(45, {}) == (25, 20) and sums.complement(75, {}) == (30, 25, 20)
    # 20 + 20 needs two of them; 30 + 10 is there
    assert sums.complement(40, {}) == (30, 10) and sums.complement(40, {30: 1}) is None and sums.complement(100, {}) is None


def by_brute_force(counts, gap):
    have = [x for x, n in enumerate(counts) for _ in range(min(n, 3))]
    return any(sum(c) == gap for k in (1, 2, 3) for c in itertools.combinations(have, k))


@pytest.mark.parametrize("seed", range(20))
def test_every_complement_is_found(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(1, 40, 8), minlength=61)
    sums = P._Sums(counts)
    for gap in range(1, 61):
        found = sums.complement(gap, {})
        assert (found is not None) == by_brute_force(counts, gap)
        assert found is None or sum(found) == gap and all(counts[x] >= found.count(x) for x in found)
