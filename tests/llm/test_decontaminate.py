from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import docs_frame
from support import SF_DIRS

from pulsegrid.llm import decontaminate as D


def plain_alignment(a, b):
    """Smith-Waterman as in the textbook."""
    h = np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (D.MATCH if a[i - 1] == b[j - 1] else D.MISMATCH), h[i - 1, j] + D.GAP, h[i, j - 1] + D.GAP)
    return h.max()


def test_alignment_scores():
    rng = np.random.default_rng(5)
    items = [rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64) for _ in range(60)]
    texts = [rng.integers(0, 4, rng.integers(1, 25)).astype(np.uint64) for _ in range(60)]
    best, row, end = D.align(items, texts)
    for k in range(60):
        assert best[k] == plain_alignment(items[k], texts[k])
        if best[k]:
            assert plain_alignment(items[k][: row[k]], texts[k][: end[k]]) == best[k]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))) for _ in range(3000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [text(36) for _ in range(12)]
    rows, planted = [], set()
    for i in range(300):
        body = text(rng.randrange(5, 300))
        if i % 3 == 0:  # one leaked item in a third of the documents: its n-grams are frequent
            body[3:3] = items[0]
            planted.add((i, 0))
        elif i % 10 == 1:
            k = rng.randrange(1, 12)
            copy = list(items[k])
            for place in rng.sample(range(36), 5):  # edited copy: words replaced, one dropped, one added
                copy[place] = rng.choice(words)
            del copy[20]
            copy.insert(9, "extra")
            body += copy
            planted.add((i, k))
        rows.append((i, " ".join(body)))
    bench = spark.createDataFrame([(k, " ".join(w).upper() + ".") for k, w in enumerate(items)] + [(90, None), (91, ""), (92, "!?"), (93, "unseenword")], "item_id long, text string")
    return docs_frame(spark, rows), bench, planted, rows


def test_planted_copies_and_no_others(corpus):
    docs, bench, planted, rows = corpus
    got = D.matches(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == planted
    texts = dict(rows)
    for r in got:
        assert 0.5 <= r["score"] <= 1 and r["end_word"] - r["start_word"] >= 30
        if r["item_id"] == 0:
            assert r["score"] == 1.0 and (r["start_word"], r["end_word"]) == (3, 39) and len(texts[r["doc_id"]].split()) >= 39


def test_parts_of_the_benchmark_give_the_same(corpus, monkeypatch):
    docs, bench, planted, _ = corpus
    parts = D.benchmarks(docs, bench, most_words=100)
    assert len(parts) > 1
    monkeypatch.setattr(D, "benchmarks", lambda *a: parts)
    assert {(r["doc_id"], r["item_id"]) for r in D.matches(docs, bench).collect()} == planted


def test_clean_keeps_the_others_whole(corpus):
    docs, bench, planted, _ = corpus
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == set(range(300)) - {i for i, _ in planted}


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "same words here in this text"), (2, None)], "item_id long, text string")
    got = sorted(tuple(r) for r in D.matches(edge_docs, bench).select("doc_id", "item_id", "score").collect())
    assert got == [(8, 1, 1.0), (9, 1, 1.0), (9, 1, 1.0)]
    assert D.matches(no_docs, bench).count() == 0
    assert D.matches(edge_docs, bench.limit(0)).count() == 0 and D.clean(edge_docs, bench.limit(0)).count() == edge_docs.count()


def test_query_finds_every_verbatim_item(spark):
    d = SF_DIRS["0.01"]
    docs, bench = pq.read_table(f"{d}/documents.parquet").to_pylist(), pq.read_table(f"{d}/benchmark.parquet").to_pylist()
    want = {(x["doc_id"], b["item_id"]) for x in docs for b in bench if b["text"] in x["text"]}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in D.query(spark, d).collect()}
    assert want and want <= set(got) and all(got[p] == 1.0 for p in want)


def test_items_of_one_and_two_words_stand_anywhere(spark):
    bench = spark.createDataFrame([(1, "Forty-two"), (2, "answer"), (3, "forty"), (4, "two forty"), (5, "Answer!"), (6, "missing word")], "item_id long, text string")
    docs = docs_frame(spark, [(1, "the answer is forty two, and again: forty two"), (2, "forty two"), (3, "two times forty"), (4, "an answer"), (5, "answer"), (6, ""), (7, None), (8, "missing another word here")])
    got = {(r["doc_id"], r["item_id"]): (r["score"], r["start_word"], r["end_word"]) for r in D.matches(docs, bench).collect()}
    assert got == {
        (1, 1): (1.0, 3, 5), (1, 2): (1.0, 1, 2), (1, 3): (1.0, 3, 4), (1, 5): (1.0, 1, 2), (2, 1): (1.0, 0, 2), (2, 3): (1.0, 0, 1),
        (3, 3): (1.0, 2, 3), (4, 2): (1.0, 1, 2), (4, 5): (1.0, 1, 2), (5, 2): (1.0, 0, 1), (5, 5): (1.0, 0, 1),
    }
    assert sorted(r["doc_id"] for r in D.clean(docs, bench).collect()) == [6, 7, 8]


def test_parts_follow_the_words_of_the_search(spark):
    items = spark.createDataFrame([(i, ",".join(f"w{chr(97 + (i * 7 + k) % 26)}{chr(97 + k % 26)}" for k in range(50))) for i in range(20)], "item_id long, text string")
    docs = items.withColumnRenamed("item_id", "doc_id")
    parts = D.benchmarks(docs, items, most_words=200)
    assert 3 <= len(parts) <= 5 and sorted(i for b in parts for i in b.ids) == list(range(20))
    assert D.benchmarks(docs, items.filter("item_id < 0")) == []
