"""Corpus pipeline: toxicity, near-duplicates, benchmark leaks, secrets, piece encoding.

Each stage takes the documents that the one before it kept and works on all of
them. Its result is written as Parquet under the shared checkpoint folder and
read back for the next stage, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontaminate, neardup, pieces, secrets, toxicity
from pulsegrid.llm.common import read_table, scratch, text_column

TOKENIZER = "piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores below the threshold; those without words stay."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity_score(F.col("text"), model) < toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates."""
    return neardup.keep_first(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or edited."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark and n_chars counted anew."""
    text = secrets.redact(F.col("text").cast("string"))
    counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return docs.withColumn("text", text).withColumn("n_chars", counted)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its piece ids, their number and digest, and whether they decode to the text; the N best segmentations with their scores."""
    coded = docs.select("doc_id", "lang", "source", pieces.encode(text_column(), public_tokenizers.path(TOKENIZER)).alias("_p"))
    return coded.select(
        "doc_id", "lang", "source", F.size("_p.ids").cast("long").alias("n_pieces"), F.col("_p.crc32").alias("ids_crc32"),
        F.col("_p.nbest").alias("nbest_scores"), F.col("_p.round_trip").alias("round_trip"), F.col("_p.ids").alias("ids"),
        F.col("_p.nbest_ids").alias("nbest_ids"), F.col("_p.nbest_crc32").alias("nbest_crc32"), F.col("_p.nbest_round_trip").alias("nbest_round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("pieces", encode_pieces),
]

#: No stage but the fourth is expressible in SQL; tests compare the stages with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
