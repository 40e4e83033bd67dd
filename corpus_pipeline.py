"""A corpus pipeline: language ID, exact dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with all
their columns; the last returns the packed pieces. Every stage works on the result of the
one before, written as Parquet and read again. An empty table passes all stages and stays empty;
extra columns of any name are kept by all stages but the last."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm import decontaminate, exact, language, packing, similar
from feedspark.llm.common import filter_rows, materialize, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, and drop the documents that the network rejects.

    Rejected: null, empty, or without a letter, or of no language with any certainty; without
    any label only the first. Rows that repeat fare alike. A very long text is judged whole.
    Rejected rows are few and go by their identifier and text, in an anti join."""
    network = language.fit(docs.filter(~language.held_out()))
    bad = language.identify(docs, network).filter(language.rejected(network)).select("doc_id", "text_key")
    return filter_rows(docs, bad, "left_anti")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest stays, then the smallest identifier (null last).

    Null and empty texts are one group, rows that repeat are copies; long texts count whole."""
    return exact.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8), the document with the smallest identifier stays.

    Texts without words are alike; null identifiers come last; rows that repeat identifier and
    text fare alike; long texts count whole. The others go by identifier and text, in an anti join."""
    gone = similar.near_copies(docs).filter("not kept").select("doc_id", "text_key")
    return filter_rows(docs, gone, "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go. Texts without words are never contaminated; long texts are scanned whole; rows that repeat fare alike."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of every document. Null and empty texts are their end id; long texts are cut; every row is packed, repeated ones too."""
    got = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 1, remembered=100_000)
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]

#: A trained network, fingerprints by XXH64 and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
