from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from support import SF_DIRS, fresh_dir
from tokenizers import Tokenizer

from pulsegrid.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 2**40), max_size=300))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values.sort()
    code = T.EliasFano(T.ef_encode(np.array(values, np.uint64)))
    assert code.all().tolist() == values
    assert [code.select(i) for i in range(len(code))] == values


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 1000, 20_000))
    assert len(T.ef_encode(values)) * 8 < 20_000 * (2 + np.log2(values[-1] / 20_000) + 0.1) + 1000
    with pytest.raises(IndexError):
        T.EliasFano(T.ef_encode(values)).select(20_000)


WORDS = ["The", "the.", "naïve,", "ÉTÉ", "don't", "I'LL", "日本", "😀x", "<|endoftext|>", "<|EndOfText|>", "x<|startoftext|>y", "é", "a-b", "123", "ſ", "İx", "ﬁ.", "a.,", "ÿ", "", "K"]


@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=8), max_size=6), st.sampled_from([" ", "\n", "\t ", " ", "　", "\x0b"]))
@settings(max_examples=80, deadline=None)
def test_encoder_equals_the_library(texts, space):
    texts = [space.join(t) for t in texts]
    ids, counts = T._encoder(PATH)(pa.array(texts, pa.string()))
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_encoder_remembers_words_of_earlier_blocks(monkeypatch):
    encoder, asked, plain = T.WordEncoder(PATH), [], Tokenizer.from_file(PATH)
    words = encoder._words
    monkeypatch.setattr(encoder, "_words", lambda w: asked.extend(w.to_pylist()) or words(w))
    blocks = [["The naïve, the.", "don't"], ["the. The été", ""], ["don't été 日本 naïve,"], [], ["日本 123"]]
    for block in blocks:
        ids, counts = encoder(pa.array(block, pa.string()))
        want = [e.ids for e in plain.encode_batch(block, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert sorted(asked) == sorted({w for block in blocks for t in block for w in t.split(" ")})


@pytest.mark.parametrize("limit", ["KNOWN_WORDS", "KNOWN_BYTES"])
def test_encoder_starts_anew_beyond_its_limits(monkeypatch, limit):
    monkeypatch.setattr(T, limit, 3)
    encoder, plain = T.WordEncoder(PATH), Tokenizer.from_file(PATH)
    for k in range(20):
        block = [f"The {WORDS[k]} and {WORDS[-k]} again", WORDS[k]]
        ids, counts = encoder(pa.array(block, pa.string()))
        want = [e.ids for e in plain.encode_batch(block, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert len(encoder._known) < 12


def test_encoder_without_ids_of_word_ends():
    encoder = T.WordEncoder(PATH)
    encoder._ends[:] = False
    texts = ["The naïve, thoroughly été.", "", "don't ÿ"]
    ids, counts = encoder(pa.array(texts, pa.string()))
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[1])


@pytest.mark.parametrize("segment", [50, T.SEGMENT_TOKENS])
def test_files_edges(spark, edge_docs, segment):
    path = fresh_dir("pg-tokens-") + "/x"
    T.write_token_files(edge_docs, path, PATH, segment_tokens=segment)
    got = sorted((tuple(r) for r in T.read_token_index(spark, path).collect()), key=key)
    assert got == sorted(expected([(r["doc_id"], r["text"]) for r in edge_docs.collect()]), key=key)


@pytest.mark.parametrize("hot", [None, 7])
def test_rows_of_one_id_are_many_ranges(spark, hot):
    rows = [(hot, f"{'same' if i % 2 else i} text") for i in range(600)] + [(8, "the last"), (3, "an early one")]
    path = fresh_dir("pg-tokens-") + "/x"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        T.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    parts = [r["n"] for r in spark.read.parquet(path).groupBy("part").agg({"n_docs": "sum"}).withColumnRenamed("sum(n_docs)", "n").collect()]
    assert sum(parts) == 602 and max(parts) < 400
    assert sorted((tuple(r) for r in T.read_token_index(spark, path).collect()), key=key) == sorted(expected(rows), key=key)


def test_empty_table(spark, no_docs):
    path = fresh_dir("pg-tokens-") + "/x"
    T.write_token_files(no_docs, path, PATH)
    assert T.read_token_index(spark, path).count() == 0


def test_query_whole_table(spark):
    d = SF_DIRS["0.001"]
    t = pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))
    assert sorted(tuple(r) for r in T.query(spark, d).collect()) == expected(rows)
