"""One registered query per operator, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, fill_in_middle, filter_audit, quality_rules, source_mix
from .bpe_codec import encode_texts
from .common import on_workers, read_documents
from .exact_dedup import exact_duplicates
from .language_id import identify, train
from .line_dedup import remove_repeated_lines
from .lm_scoring import score_texts
from .multiset_fingerprint import centred, fingerprints, in_hex, likeness
from .personal_data import KINDS, find_entities
from .simhash_dedup import near_duplicates
from .source_mix import mix_sources, text_digest, words
from .suffix_dedup import remove_repeats

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def taught(parts: int) -> Column:
    """Documents to learn from; those with remainder 2 are held out."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(parts)) != 2


def query(function):
    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        on_workers(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


@query
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = remove_repeats(read_documents(spark, folder), length=200)
    return kept.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(read_documents(spark, folder)).drop("n_chars")


ORACLE["op3_exact_dedup"] = exact_dedup.ORACLE


@query
def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    light = read_documents(spark, folder).select("doc_id", "source", text_digest(F.col("text")).alias("digest"), words(F.col("text")).alias("size"))
    mixed = mix_sources(light, F.col("size"), digest=F.col("digest"))
    one = ["doc.doc_id", "doc.source", *(f"mix.{c}" for c in ("stretch", "number", "size", "source_size", "target"))]
    return mixed.groupBy(*one).agg(F.sum("mix.taken").alias("taken")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op6_source_mix"] = source_mix.ORACLE


@query
def op9_multiset_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    rows = fingerprints(read_documents(spark, folder))
    three = {x: centred(F.col(f"{x}lanes"), F.col(f"{x}n")) for x in ("", "edited_", "next_")}
    rows = rows.withColumns({f"{x}centred": v for x, v in three.items()})
    near = lambda x: likeness(F.col("centred"), F.col(f"{x}_centred"), F.col("lanes"), F.col(f"{x}_lanes"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", in_hex(F.col("lanes")).alias("fingerprint"), in_hex(F.col("edited_lanes")).alias("edited_fingerprint"),
        near("edited").alias("near_edited"), near("next").alias("near_next"),
    )


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    model = train(docs.where(taught(4)))
    rows = identify(docs.select("doc_id", (~taught(4)).alias("held_out"), "text"), model)
    return rows.select("doc.doc_id", "doc.held_out", "lang_pred", "score")


@query
def op10_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_texts(read_documents(spark, folder).select("doc_id", "text"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        "doc.doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = near_duplicates(read_documents(spark, folder), shingle=4, bits=4)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    rows = score_texts(read_documents(spark, folder), taught(7))
    return rows.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    rows = find_entities(read_documents(spark, folder))
    name = lambda kind: F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)
    joined = lambda spans: F.array_join(F.transform(spans, lambda e: F.concat_ws(":", name(e["kind"]), e["start"], e["end"])), ",")
    of = lambda i: F.size(F.filter("base", lambda e: e["kind"] == i)).cast("long")
    counts = [of(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


@query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = remove_repeated_lines(read_documents(spark, folder))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return filter_audit.interactions(filter_audit.combinations(read_documents(spark, folder), labels))


ORACLE["op11_filter_audit"] = filter_audit.ORACLE


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = fill_in_middle.restore(fill_in_middle.fill_in_middle(read_documents(spark, folder).select("doc_id", "text")))
    digest = lambda column: F.sha2(F.col(column).cast("binary"), 256)
    return rows.select(
        "row.doc.doc_id", *(f"row.{c}" for c in ("n", "form", "prefix_chars", "middle_chars")), digest("row.output").alias("output_sha256"),
        digest("restored").alias("restored_sha256"))


ORACLE["op12_fill_in_middle"] = fill_in_middle.ORACLE


@query
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.apply_rules(read_documents(spark, folder).select("doc_id", "text"))
    return rows.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE["op13_quality_rules"] = quality_rules.ORACLE
