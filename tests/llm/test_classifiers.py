from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from support import SF_DIRS

from pulsegrid.llm import labelled
from pulsegrid.llm import quality as Q
from pulsegrid.llm import toxicity as T


@pytest.fixture(scope="module")
def split():
    d = SF_DIRS["0.1"]
    docs = pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).to_pandas()
    return docs.merge(pq.read_table(f"{d}/labels.parquet").to_pandas(), on="doc_id")


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(label) - ones))


def held_out_auc(fit, table, label, folds, held_out, **options):
    fold = np.array([zlib.crc32(str(i).encode()) % folds for i in table.doc_id])
    train, test = table[fold != held_out], table[fold == held_out]
    model = fit(pa.table({"label": train[label].to_numpy(), "text": train.text.to_numpy()}), **options)
    return auc(model.score(pa.array(test.text.to_numpy())), test[label].to_numpy())


def test_quality_on_held_out_rows(split):
    assert held_out_auc(Q.fit, split, "quality", 3, 1) > 0.99


def test_toxicity_on_held_out_rows(split):
    assert held_out_auc(T.fit, split, "toxic", 4, 2) > 0.93


def test_gradients_of_the_network():
    """Backward pass against differences of the loss."""
    texts = pa.array(["good words stand here in line", "some bad thing", "x"])
    (_, _, block) = next(T._blocks(texts))
    model = T.ToxicityModel(block.hashes[:4], seed=1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    kind, T._F = T._F, np.float64
    try:
        def loss():
            _, vectors = model.inputs(block)
            idx, mask = T._window_words(block, np.arange(len(block.start)), True)
            logit, cache = model.forward(model.gates(vectors), idx, mask, keep=True)
            return float((logit * np.array([1.0, -2.0, 0.5])).sum()), vectors, cache

        _, vectors, cache = loss()
        grads, _ = model.backward(vectors, cache, np.array([1.0, -2.0, 0.5]))
        rng = np.random.default_rng(0)
        for name, grad in grads.items():
            for _ in range(3):
                at = tuple(rng.integers(0, n) for n in model.p[name].shape)
                old, eps = model.p[name][at], 1e-6
                model.p[name][at] = old + eps
                up = loss()[0]
                model.p[name][at] = old - eps
                down = loss()[0]
                model.p[name][at] = old
                assert grad[at] == pytest.approx((up - down) / (2 * eps), rel=1e-4, abs=1e-7), name
    finally:
        T._F = kind


def test_every_word_is_in_a_window():
    for n in (1, 16, 31, 32, 33, 48, 49, 200):
        (_, _, block) = next(T._blocks(pa.array([" ".join(f"w{k}" for k in range(n))])))
        seen = np.zeros(n, int)
        for s, size in zip(block.start, block.length, strict=True):
            seen[s : s + size] += 1
        assert (seen >= 1).all() and (n <= 32 or (seen[16:-16] >= 2).all()) and (block.length <= T.WINDOW).all()


def test_window_scores_do_not_depend_on_the_batch(split):
    rows = split.head(300)
    model = T.fit(pa.table({"label": rows.toxic.to_numpy(), "text": rows.text.to_numpy()}), passes=2)
    texts = rows.text.to_list()[:20] + ["", "a"]
    assert np.allclose(model.score(pa.array(texts)), [model.score(pa.array([t]))[0] for t in texts], atol=1e-5)


@pytest.mark.parametrize("module,column", [(Q, Q.quality_score), (T, T.toxicity_score)])
def test_edges(spark, edge_docs, no_docs, module, column, split):
    rows = split.head(200)
    label = "quality" if module is Q else "toxic"
    model = module.fit(pa.table({"label": rows[label].to_numpy(), "text": rows.text.to_numpy()}), **({"passes": 1} if module is T else {}))
    scores = [r["s"] for r in edge_docs.select(column(F.col("text"), model).alias("s")).collect()]
    assert len(scores) == 14 and all(0 <= s <= 1 for s in scores)
    assert no_docs.select(column(F.col("text"), model)).count() == 0
    for labels in ([], [1, 1], [0]):
        one = module.fit(pa.table({"label": pa.array(labels, pa.int32()), "text": pa.array(["some words"] * len(labels), pa.string())}))
        assert all(0 <= s <= 1 for s in one.score(pa.array(["", "some words"])))


def test_training_rows_leave_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "clash") for i in range(60)] + [(3, "text 3", "again"), (None, "x", "y")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 80)] + [(4, 1, 0), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = labelled.training_rows(docs, labels, "quality", 3, 1, 1000)
    want = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert rows["doc_id"].to_pylist() == want
    assert rows["label"].to_pylist() == [1 if i == 4 else i % 2 for i in want]
    assert labelled.training_rows(docs, labels, "quality", 3, 1, 7).num_rows <= 7
    assert labelled.training_rows(docs, labels.limit(0), "quality", 3, 1, 7).num_rows == 0


@pytest.mark.parametrize("module,folds,held_out,limit", [(Q, 3, 1, 0.5), (T, 4, 2, 0.3)])
def test_query_columns(spark, module, folds, held_out, limit):
    rows = module.query(spark, SF_DIRS["0.001"]).collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held_out)
        assert r["predicted"] == int(r["score"] >= limit) and 0 <= r["score"] <= 1


def test_training_leaves_and_takes_little_memory(spark, monkeypatch):
    """The driver holds the word vectors once, not the rows of all their trigrams, and gives back what training took."""
    import tracemalloc

    words = pa.array([" ".join(f"{i:024d}" for i in range(40_000))])
    block = T._merge([b for _, _, b in T._blocks(words)])
    model = T.ToxicityModel(block.hashes[:5])
    rows = model.p["char"][block.grams]
    chars = np.add.reduceat(rows, np.cumsum(block.sizes) - block.sizes, axis=0) / block.sizes[:, None].astype(np.float32)
    del rows
    tracemalloc.start()
    vectors = model.inputs(block)[1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(vectors[:, T.WORD_SIZE :], chars)
    assert peak < 6 * vectors.nbytes
    calls = []
    monkeypatch.setattr(T, "release_memory", lambda: calls.append(1))
    docs = spark.createDataFrame([(i, f"some words of text {i % 7} " + "bad " * (i % 2)) for i in range(40)], "doc_id long, text string")
    T.train(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    assert calls
