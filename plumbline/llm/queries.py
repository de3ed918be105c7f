"""The text operators as queries over the data folder's tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, dedup, divergence, langid, media, packing, pii, pseudolm, runs, secrets, toxicity, vectors, warc
from plumbline.llm.common import table


def op1_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts, digest and spans."""
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


def op2_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents, within a fifth of their words."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at a similarity of 0.85 over five-word shingles."""
    return dedup.near_components(table(spark, sf_dir, "documents"), 85, 100)


def op4_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as JPEG media, described from the stored bytes."""
    return media.describe(media.media_column(table(spark, sf_dir, "documents")))


def op5_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document; labels are learned outside the held-out fold only."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back from normalised archives."""
    return warc.archive(table(spark, sf_dir, "pages"))


def op7_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned from text and lang outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op8_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return packing.sequences(table(spark, sf_dir, "documents"))


def op9_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts, digest and spans."""
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op10_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pseudo-log-likelihood of every document under a network trained on all of them."""
    return pseudolm.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op11_collision_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors at a cosine of 0.95, and how many vectors each is linked with."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_block_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and a digest of what is left without their repeats."""
    return runs.report(runs.find(table(spark, sf_dir, "documents"), rewrite=runs.planted))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language over all documents, and the terms that each favours."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bootstrapped_pii": op1_bootstrapped_pii,
    "op2_cgk_decontamination": op2_cgk_decontamination,
    "op3_superminhash_dedup": op3_superminhash_dedup,
    "op4_jpeg_media": op4_jpeg_media,
    "op5_counterfactual_toxicity": op5_counterfactual_toxicity,
    "op6_warc_normaliser": op6_warc_normaliser,
    "op7_ecoc_language": op7_ecoc_language,
    "op8_karmarkar_karp_packing": op8_karmarkar_karp_packing,
    "op9_trigram_secrets": op9_trigram_secrets,
    "op10_pseudo_likelihood": op10_pseudo_likelihood,
    "op11_collision_vectors": op11_collision_vectors,
    "op12_block_runs": op12_block_runs,
    "op13_source_divergence": op13_source_divergence,
}
