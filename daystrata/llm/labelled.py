"""Bounded, repeatable samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Whether a document's labels may not be learnt from."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, modulus: int, remainder: int
) -> DataFrame:
    """``(text, label)`` of at most ``rows`` labelled documents outside the held-out part, chosen by
    a hash of the id. Ids are at most ``rows``, so the join broadcasts them whatever the tables hold; of
    documents with one id the least text stands for all.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(~held_out(modulus, remainder)).groupBy(F.col("doc_id").alias("known_id"))
    known = known.agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("known_id"), "known_id").limit(rows)
    mine = docs.select(
        F.col("doc_id").alias("known_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    known = mine.join(F.broadcast(chosen), "known_id").groupBy("known_id")
    return known.agg(F.min("text").alias("text"), F.min("label").alias("label")).select("text", "label")
