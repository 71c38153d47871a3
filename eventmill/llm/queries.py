"""The registered query of each operator: it reads its whole table and derives the columns of the check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm import alignment, bpe, langid, licenses, linedup, packing, pii, quality, simhash, subwords, toxicity, vectors, whitening
from eventmill.llm.common import table


def op1_context_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op2_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op3_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op4_license_index(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(table(spark, folder, "documents"))


def op5_bpe_transducer(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, folder, "documents")).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_compression_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op8_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


def op9_simhash_covering(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    return linedup.drop_repeated_lines(table(spark, folder, "documents")).select("doc_id", "text", "n_lines_before", "n_removed")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.summed_up(alignment.align(table(spark, folder, "documents")))


def op12_whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_subword_agenda(spark: SparkSession, folder: str) -> DataFrame:
    return subwords.encode_and_decode(table(spark, folder, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_context_bootstrap, op2_weak_supervision, op3_language_mixture, op4_license_index, op5_bpe_transducer, op6_compression_toxicity,
    op7_harmonic_packing, op8_near_vectors, op9_simhash_covering, op10_line_windows,
    op11_token_alignment, op12_whitened_vectors, op13_subword_agenda)}
