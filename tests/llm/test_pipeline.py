from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import public_tokenizers
from conftest import docs_frame
from pyspark.sql import functions as F
from support import SF_DIRS
from test_neardup import brute as groups_of
from test_secrets import brute as secrets_of

import corpus_pipeline as C
from pulsegrid.llm import pieces, toxicity
from pulsegrid.llm.common import stored

SF = SF_DIRS["0.001"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def after(spark):
    """What each stage returned, by name, and the documents at first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in C.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF), f"test-{name}")
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_stages_and_columns(after):
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "pieces"]
    assert C.ORACLE_SQL is None
    for name, _ in C.STAGES[:-1]:
        assert after[name].columns == COLUMNS


def test_toxic_documents_go(spark, after):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    before, kept = texts(after["documents"]), texts(after["toxicity"])
    model = toxicity.train(after["documents"], spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept == {i: t for i, t in before.items() if model.score(pa.array([t]))[0] < toxicity.THRESHOLD}
    dropped = set(before) - set(kept)
    toxic, clean = ([i for i, x in labels.items() if x == k] for k in (1, 0))
    assert len(dropped & set(toxic)) >= 0.5 * len(toxic) and len(dropped & set(clean)) <= 0.1 * len(clean)


def test_one_document_of_each_group_stays(after):
    before, kept = texts(after["toxicity"]), texts(after["near_duplicates"])
    assert kept == {i: before[i] for i, g in groups_of(list(before.items())) if i == g}


def test_leaks_go_and_others_stay(after):
    items = pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()
    before, kept = texts(after["near_duplicates"]), texts(after["decontamination"])
    leaked = {i for i, t in before.items() if any(x in t for x in items)}
    assert kept.items() <= before.items() and not leaked & set(kept)
    assert len(before) - len(kept) - len(leaked) <= 2


def test_secrets_are_redacted_and_nothing_else(after):
    before, now = texts(after["decontamination"]), texts(after["secrets"])
    assert before.keys() == now.keys()
    for i, t in before.items():
        if sum(secrets_of(t)[0]) == 0 and "[SECRET]" not in now[i]:
            assert now[i] == t
        assert sum(secrets_of(now[i])[0]) == 0
    assert all(r["n_chars"] == len(r["text"]) for r in after["secrets"].collect())


def test_pieces_decode_to_the_texts(after):
    path = public_tokenizers.path(C.TOKENIZER)
    rows = after["pieces"].withColumn("back", pieces.decode(F.col("ids"), path)).collect()
    now = texts(after["secrets"])
    assert {r["doc_id"]: r["back"] for r in rows} == now and all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in rows)


def test_stages_on_edge_rows(spark, edge_docs, no_docs):
    """NULLs, empty and long texts, repeated rows and further columns; then no rows at all."""
    for docs, most in ((edge_docs, 10), (no_docs, 0), (docs_frame(spark, [(None, None)]), 1)):
        for name, stage in C.STAGES:
            docs = stored(stage(spark, docs, SF), f"edge-{name}")
            if name != "pieces":
                assert docs.columns == edge_docs.columns
        assert docs.count() == most
