"""From raw documents to token ids: five stages, each on all that its predecessor kept.

A stage gets the session, the documents and the folder of the tables. All but the last return the documents they keep with their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import exact_dedup, simhash_dedup
from landfall.llm.bpe_codec import encode_texts
from landfall.llm.common import on_workers, read_documents, staged
from landfall.llm.language_id import identify, train
from landfall.llm.queries import VOCABULARY, taught
from landfall.llm.source_mix import mix_sources, taken_documents, text_digest, words

#: Documents whose best language scores less are in none of the known ones; all scores of a text add up to 1.
LEAST_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Reject documents without a letter and those in no known language. Without any labelled document nothing is rejected. Rows are judged one by one, repeated ones alike."""
    model = train(docs.where(taught(4)))
    if not model.langs:
        return docs
    return identify(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("doc.*")


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts, the longest one, then that with the smallest doc_id; of repeated rows one."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of linked fingerprints, that with the smallest doc_id; of repeated rows one."""
    return simhash_dedup.keep_one(docs, shingle=4, bits=4)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The copies that the mix takes; the one cut by the end of the budget stays if half of it or more is taken. Repeated rows are copies, too; an empty table stays so."""
    light = docs.select("doc_id", "source", text_digest(F.col("text")).alias("digest"), words(F.col("text")).alias("size"))
    mixed = mix_sources(light, F.col("size"), digest=F.col("digest"))
    return taken_documents(docs, mixed, (F.col("mix.taken") > 0) & (2 * F.col("mix.taken") >= F.col("mix.size")))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids, and whether they decode to the text."""
    coded = encode_texts(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce(F.col("doc.text"), F.lit("")).cast("binary")
    return coded.select("doc.doc_id", "doc.source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes"))


STAGES = [("language ID", language_id), ("exact dedup", exact), ("SimHash near-dedup", near), ("mixing sources", mix), ("BPE encoding", encode)]

#: The stages by model and by fingerprint have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order, each written and read again."""
    on_workers(spark)
    docs = read_documents(spark, folder)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, folder), name.replace(" ", "-"))
    return docs
