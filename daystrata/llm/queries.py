"""The corpus operators as queries over whole tables, with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.llm import (
    alignment,
    bpe,
    convnet,
    fingerprints,
    licences,
    packing,
    paths,
    pii,
    prefixes,
    quotes,
    repeats,
    rules,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def fingerprinted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


def similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its group and the number of its links."""
    return paths.groups(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


_PATH = "concat('/', coalesce(source, ''), '/', coalesce(lang, ''), '/', doc_id, '.txt')"


def licensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files in a directory per source and language."""
    files = table(spark, sf_dir, "documents").select("doc_id", F.expr(_PATH).alias("path"), "text")
    return licences.scan(files)


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(table(spark, sf_dir, "conversations"))


# Every third message quotes the first line of the one before it, two marks deep every ninth.
_QUOTING = """select conv_id, turn, role, case
      when (conv_id + turn) % 9 = 0 and before <> '' then concat('> > ', before, {end}, coalesce(text, ''))
      when (conv_id + turn) % 3 = 0 and before <> '' then concat('> ', before, {end}, coalesce(text, ''))
      else text end as text
    from (select *, {line} as before
      from (select *, lag(text) over (partition by conv_id order by turn) as previous from {said}) p) q"""


def answered_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations with quotations put in by rule."""
    line = "split_part(coalesce(previous, ''), '\\n', 1)"
    said = table(spark, sf_dir, "conversations")
    return quotes.linked(spark.sql(_QUOTING.format(end="'\\n'", line=line, said="{said}"), said=said))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return convnet.score(docs, convnet.train(docs, table(spark, sf_dir, "labels")))


def unrepeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.digests(alignment.align(table(spark, sf_dir, "documents"), *files, hashed=True))


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def shared_beginnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix tree of the conversations, each rebuilt upon the first of its hundred."""
    said = prefixes.turn_paths(table(spark, sf_dir, "conversations"))
    return prefixes.tree(prefixes.rebuilt(said))


QUERIES: dict[str, Query] = {
    "op1_bpe": encoded,
    "op2_packing": packed,
    "op3_toxicity": toxic,
    "op4_quality_rules": rule_verdicts,
    "op5_fingerprints": fingerprinted,
    "op6_jaccard_join": similar,
    "op7_licence_scan": licensed,
    "op8_quote_linking": answered,
    "op8_quotes_put_in": answered_quotes,
    "op9_quality_classifier": quality,
    "op10_substring_dedup": unrepeated,
    "op11_alignment": aligned,
    "op12_pii": personal,
    "op13_prefix_trie": shared_beginnings,
}

SQL: dict[str, str] = {
    "op4_quality_rules": rules.judge_sql(),
    "op7_licence_scan": licences.scan_sql(f"select doc_id, {_PATH} as path, text from documents"),
    "op8_quote_linking": quotes.linked_sql(),
    "op8_quotes_put_in": quotes.linked_sql(
        "(" + _QUOTING.format(
            end="chr(10)", line="split_part(coalesce(previous, ''), chr(10), 1)", said="conversations") + ")"
    ),
    "op12_pii": pii.find_sql(),
    "op13_prefix_trie": prefixes.tree_sql(),
}
