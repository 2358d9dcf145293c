"""The registered queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.llm import (
    alignment, bit_sliced, compression_quality, license_scan, line_quality, mixing, packing, pii, repeats, sharding,
    simhash, toxicity, whitening)
from attriflux.llm.shared import read

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = oracle
        return function
    return add


@register("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"))


@register("op2_license_scan", license_scan.scan_sql())
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, folder, "documents"))


@register("op3_vector_sharding")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read(spark, folder, "documents"))


@register("op4_quality_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = line_quality.train_line_model(docs, read(spark, folder, "labels"))
    return line_quality.line_quality(docs, model)


@register("op5_simhash")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@register("op6_bit_sliced_search", bit_sliced.search_sql())
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return bit_sliced.top_products(read(spark, folder, "embeddings"))


@register("op7_repeat_removal")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, folder, "documents"))


@register("op8_compression_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = compression_quality.train_compression_model(docs, read(spark, folder, "labels"))
    return compression_quality.score_quality(docs, model)


@register("op9_personal_data")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(read(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                        pii.span_text(F.col("spans")).alias("spans"))


@register("op10_source_mixing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op11_weak_toxicity")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.find_toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


@register("op12_token_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokenizers(read(spark, folder, "documents"), ids=False, digest=True)


@register("op13_embedding_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings"))


@register("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
