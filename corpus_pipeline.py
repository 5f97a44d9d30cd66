"""Documents to packed training sequences: five stages, each calling one corpus operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from daystrata.llm import convnet, packing, paths, repeats, toxicity
from daystrata.sources.files import scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Null text counts as empty and is judged by the network's answer to no bytes; equal texts are judged
    alike, so ties and repeated rows stay or go together; nulls in other columns and further columns play no
    part; an empty table stays empty. Without labels every document is as likely good as not, and stays.
    """
    network = convnet.train(docs, _labels(spark, sf_dir))
    return convnet.kept(docs, network).select(COLUMNS)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic.

    Null and empty texts hold no passage and are judged as such; equal texts are judged alike; nulls in other
    columns and further columns play no part; an empty table stays empty.
    """
    model = toxicity.train(docs, _labels(spark, sf_dir))
    return toxicity.kept(docs, model).select(COLUMNS)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least id, null ids before all.

    Of repeated rows one stays; null text counts as empty; texts without words link to nothing and stay, but
    for rows alike in id and text; texts below five words link if they are equal; an empty table stays empty.
    """
    return paths.one_of_each(docs).select(COLUMNS)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere; other texts stay as they are.

    Every place of a passage goes, the first too, so repeated rows lose all their passages of 35 words and
    more; every row stays, with null, empty and short texts unchanged; ``n_chars`` becomes the length of what is
    left, null for null text; an empty table stays empty.
    """
    return repeats.cut(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences.

    Null text counts as empty and gives one piece, the end token; repeated rows and ids are packed as rows of
    their own; an empty table gives no rows; other columns are left out.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good),
    ("toxicity", harmless),
    ("n-gram Jaccard join", different),
    ("substring dedup", unrepeated),
    ("packing", packed),
]

#: SQL has no convolutional network; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
