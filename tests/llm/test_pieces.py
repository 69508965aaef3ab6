from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from support import SF_DIRS

from pulsegrid.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return P.PieceEncoder(PATH)


def brute(model, word, n):
    """Scores of all segmentations of a word, written as a plain recursion."""
    out = []

    def go(i, score):
        if i == len(word):
            out.append(score)
        for j in range(i + 1, len(word) + 1):
            piece = word[i:j]
            if piece in model.score and not (i and P.MARK in piece) and P.MARK not in piece[1:]:
                go(j, score + model.score[piece][0])
        if i < len(word) and (word[i] not in model.score or (i and word[i] == P.MARK)):
            go(i + 1, score + model.unknown)

    go(0, 0.0)
    return sorted(out, reverse=True)[:n]


WORDS = ["▁hello", "▁", "▁the", "▁of.\nWas", "▁été▁x", "▁日本語", "▁a😀b", "▁%%%", "▁▁", "▁thehe"]


@pytest.mark.parametrize("word", WORDS)
def test_nbest_of_a_word(encoder, word):
    found = encoder.model.nbest(word, 5)
    assert [s for s, _ in found] == brute(encoder.model, word, 5)
    assert len({tuple(i) for _, i in found}) == len(found)
    ids, counts, score, cost = encoder.model.solve([word])
    assert ids.tolist() == found[0][1] and counts[0] == len(ids) and score[0] == found[0][0]
    assert cost[0] == (found[0][0] - found[1][0] if len(found) > 1 else np.inf)


TEXTS = ["hello world", "", " ", "a  b", "of the", "x▁y", "née\n\tzß 日本", " lead", "trail ", "the the the"]


def test_texts(encoder):
    texts = pa.array(TEXTS)
    ids, sizes, scores = encoder(texts)
    assert encoder.round_trip(texts, ids, sizes).all()
    for text, got in zip(TEXTS, scores, strict=True):
        assert np.allclose(got, whole(encoder.model, text, P.NBEST))


def test_columns(spark, edge_docs, no_docs):
    coded = edge_docs.select("text", P.encode(F.col("text"), PATH).alias("_p")).withColumn("back", P.decode(F.col("_p.ids"), PATH))
    for r in coded.collect():
        assert r["back"] == (r["text"] or "") and r["_p"]["round_trip"]
        assert (len(r["_p"]["ids"]) == 0) == (not r["text"])
        assert r["_p"]["nbest"] == sorted(r["_p"]["nbest"], reverse=True)
    assert no_docs.select(P.encode(F.col("text"), PATH)).count() == 0


def test_query_decodes_every_document(spark):
    rows = P.query(spark, SF_DIRS["0.001"]).collect()
    assert len(rows) == 200 and all(r["round_trip"] and r["best_score"] == r["nbest_scores"][0] for r in rows)


def whole(model, text, n):
    """The ``n`` best scores of a text over all pieces of the model, written as a plain recursion over the whole text."""
    marked = [P.MARK if c == " " else c if c != P.MARK else None for c in " " + text] if text else []

    def go(i):
        if i == len(marked):
            return [0.0]
        found = []
        for j in range(i + 1, min(len(marked), i + model.longest) + 1):
            piece = None if None in marked[i:j] else "".join(marked[i:j])
            if piece in model.score or (j == i + 1 and piece not in model.score):
                found += [model.score.get(piece, (model.unknown,))[0] + s for s in go(j)]
        return sorted(found, reverse=True)

    return go(0)[:n]


RUNS = ["a  b", " ", "   ", "  lead", "trail  ", "x   y", "if:\n    go  ", "  ▁  x", " ▁▁ ", "a  \n   é", "        "]


def test_runs_of_blanks_over_all_pieces(encoder):
    names = encoder.model.score
    assert sum(not name.strip(P.MARK) for name in names) == 15
    texts = pa.array(RUNS)
    ids, sizes, scores = encoder(texts)
    assert encoder.round_trip(texts, ids, sizes).all()
    for text, got in zip(RUNS, scores, strict=True):
        assert np.allclose(got, whole(encoder.model, text, P.NBEST))


def test_long_runs_of_blanks_take_the_longest_pieces(encoder):
    texts = pa.array(["a" + " " * 8 + "b", "x" + " " * 5000 + "y", " " * 5000])
    ids, sizes, scores = encoder(texts)
    assert encoder.round_trip(texts, ids, sizes).all()
    assert sizes.tolist() == [3, 1 + 313 + 1, 313] and [len(s) for s in scores] == [P.NBEST] * 3
    for word in (" " * 8 + "b", " " * 200 + "y", " " * 200):
        found = encoder.model.nbest(word, 5)
        flat, _, score, cost = encoder.model.solve([word])
        assert flat.tolist() == found[0][1] and score[0] == found[0][0] and cost[0] == found[0][0] - found[1][0]
        assert len({tuple(i) for _, i in found}) == 5


def paths(model, text):
    """All segmentations of a text (score, ids), written as a plain recursion over the whole text."""
    marked = [P.MARK if c == " " else c if c != P.MARK else None for c in " " + text] if text else []

    def go(i):
        if i == len(marked):
            return [(0.0, ())]
        found = []
        for j in range(i + 1, min(len(marked), i + model.longest) + 1):
            piece = None if None in marked[i:j] else "".join(marked[i:j])
            if piece in model.score:
                score, ids = model.score[piece][0], (model.score[piece][1],)
            elif j == i + 1:
                score, ids = model.unknown, tuple(model.spelled(marked[i] or P.MARK))
            else:
                continue
            found += [(score + s, ids + x) for s, x in go(j)]
        return found

    return {ids: s for s, ids in go(0)}


SHORT = ["of the", "x▁y", "é zß", "a  b", "", "日", "to it is", "   ", "in\n  a", "the the"]


def test_every_segmentation_is_written_out(encoder):
    texts = pa.array(SHORT)
    ids, sizes, scores = encoder.segmentations(texts)
    made = [len(s) for s in scores]
    assert encoder.round_trip(texts, ids, sizes, np.array(made)).all()
    each = iter(np.split(ids, np.cumsum(sizes)[:-1]))
    for text, got in zip(SHORT, scores, strict=True):
        ways = paths(encoder.model, text)
        found = [tuple(next(each).tolist()) for _ in got]
        assert len(set(found)) == len(found) == min(P.NBEST, len(ways))
        assert np.allclose(got, sorted(ways.values(), reverse=True)[: P.NBEST])
        assert np.allclose(got, [ways[x] for x in found])
    best, best_sizes, _ = encoder(texts)
    assert best_sizes.tolist() == sizes[np.cumsum(made) - made].tolist() and len(best) == best_sizes.sum()


def test_every_segmentation_decodes(spark, edge_docs):
    coded = edge_docs.select("text", P.encode(F.col("text"), PATH).alias("_p"), P.digests(F.col("text"), PATH).alias("_d"))
    coded = coded.select("*", F.posexplode("_p.nbest_ids").alias("rank", "some")).withColumn("back", P.decode(F.col("some"), PATH))
    rows = coded.collect()
    assert max(r["rank"] for r in rows) == P.NBEST - 1
    for r in rows:
        p, d, k, some = r["_p"], r["_d"], r["rank"], np.frombuffer(r["some"], "<u2")
        assert r["back"] == (r["text"] or "") and p["nbest_round_trip"][k] and d["round_trip"][k]
        assert r["some"] == p["nbest_ids"][k] and (k or some.tolist() == p["ids"]) and d["n_pieces"][k] == len(some)
        assert d["nbest"] == p["nbest"] and d["crc32"] == p["nbest_crc32"] and len(set(map(bytes, p["nbest_ids"]))) == len(p["nbest"])


def test_blocks_within_a_batch(spark, edge_docs, monkeypatch):
    """The same segmentations when a batch is many blocks."""
    plain = edge_docs.select("text", P.encode(F.col("text"), PATH).alias("p")).collect()
    blocks = P.text_blocks
    monkeypatch.setattr(P, "text_blocks", lambda offsets: blocks(offsets, 40))
    assert edge_docs.select("text", P.encode(F.col("text"), PATH).alias("p")).collect() == plain


def test_query_has_a_digest_of_each_rank(spark):
    for r in P.query(spark, SF_DIRS["0.001"]).collect():
        assert len(r["nbest_crc32"]) == len(r["nbest_scores"]) == len(r["nbest_pieces"]) and all(r["nbest_round_trip"])
        assert r["ids_crc32"] == r["nbest_crc32"][0] and r["n_pieces"] == r["nbest_pieces"][0] and len(set(r["nbest_crc32"])) == len(r["nbest_crc32"])


def test_edges_of_the_tree_are_found_by_hash(encoder):
    model = encoder.model
    for name, (_, i) in model.score.items():
        node = model._root[ord(name[0])]
        for c in name[1:]:
            node = model._next(np.array([(int(node) << 21) | ord(c)]))[0] if len(name) < 4 else node
        assert len(name) >= 4 or model._node_id[node] == i
    keys = model._keys[model._keys >= 0]
    assert (model._next(keys) > 0).all()
    absent = np.setdiff1d(np.arange(1 << 21, (1 << 21) + 200_000), keys)
    assert not model._next(absent).any()


def test_round_trips_some_segmentations_at_a_time(encoder, monkeypatch):
    texts = pa.array([*TEXTS, "another text of more words " * 20])
    ids, sizes, scores = encoder.segmentations(texts)
    made = np.array([len(x) for x in scores])
    wrong = ids.copy()
    wrong[-1] = wrong[0]
    seen = []
    blocks = P.text_blocks
    monkeypatch.setattr(P, "text_blocks", lambda offsets: [seen.append(x) or x for x in blocks(offsets, 16)])
    assert encoder.round_trip(texts, ids, sizes, made).all()
    assert encoder.round_trip(texts, wrong, sizes, made).tolist() == [True] * (len(sizes) - 1) + [False]
    assert len(seen) > 10


def test_long_words_and_ties(encoder):
    """Of equal paths that with the longer last piece; words longer than any piece, and of one character."""
    for word in ("▁" + "a" * 300, "▁" + "日本" * 40, "▁" + " " * 30, "▁q", "▁" + "thehe" * 50):
        ids, counts, score, _ = encoder.model.solve([word])
        assert counts[0] == len(ids) and np.isclose(score[0], encoder.model.nbest(word, 1)[0][0])
        both = encoder.model.solve(["▁x", word, "▁the"])
        assert both[0][both[1][0] : both[1][0] + both[1][1]].tolist() == ids.tolist()


def test_segmentations_some_texts_at_a_time(encoder, monkeypatch):
    texts = pa.array([*TEXTS, *SHORT, "", "another text of more words " * 20, "  "])
    ids, sizes, scores = encoder.segmentations(texts)
    seen = []
    blocks = P.text_blocks
    monkeypatch.setattr(P, "text_blocks", lambda offsets: [seen.append(x) or x for x in blocks(offsets, 40)])
    again, again_sizes, again_scores = encoder.segmentations(texts)
    assert len(seen) > 10
    assert again.tolist() == ids.tolist() and again_sizes.tolist() == sizes.tolist() and again_scores == scores
    assert again.dtype == np.int32


def test_memory_of_a_block(encoder):
    """A block of 2 MB with its ids (24 MB): 148 MB, and 51 MB more for the round trips, when all of it was worked on at once."""
    rng = np.random.default_rng(5)
    words = np.array([f"word{i:x}of{i * 7919 % 65536:x}" for i in range(60_000)])
    texts = pa.array([" ".join(words[rng.integers(0, len(words), 100)]) for _ in range(1500)])
    tracemalloc.start()
    try:
        ids, sizes, scores = encoder.segmentations(texts)
        made = np.array([len(s) for s in scores])
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        assert encoder.round_trip(texts, ids, sizes, made).all()
        decoding = tracemalloc.get_traced_memory()[1] - held
    finally:
        tracemalloc.stop()
    assert most < 110e6 and decoding < 20e6
