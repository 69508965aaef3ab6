"""Labelled training rows for the text classifiers: a bounded, repeatable sample."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import text_column


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL ids are in no fold."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> pa.Table:
    """Up to ``most`` rows (doc_id, label, text) that are not of fold ``held_out``, in order of doc_id.

    The rows with the smallest hash of their doc_id are taken, which is the same
    sample on every run. Labels that are NULL count as absent; for an id with
    several labels the largest holds. The ids are at most ``most``, so their
    broadcast is bounded; only their texts come to the driver.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return found.select("doc_id", "label", "text").toArrow().sort_by("doc_id").combine_chunks()
