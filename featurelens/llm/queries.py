"""The registered queries of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from featurelens.llm import decontaminate, embeddings, html_diff, katz, licenses, line_dedup, mixing, negatives, ngram_join, oracle, pii, quality, toxicity, whitening


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_diff.extract_main_text(_read(spark, sf_dir, "pages"))


def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.93 or more between embeddings of one label."""
    return embeddings.embedding_neardup(_read(spark, sf_dir, "embeddings"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents (five words, 0.8 or more)."""
    return ngram_join.ngram_join(_read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with their exact containment."""
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff scores of all documents."""
    return katz.katz_scores(_read(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; their paths are source, language, the id's
    hundred and the id."""
    docs = _read(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan_licenses(docs.select("doc_id", "text", path.alias("path")))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents mixed to source weights 5, 2, 1."""
    return mixing.mix_sources(_read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    return quality.select_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents less their repeated and nearly repeated lines."""
    return line_dedup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.digest(pii.find_pii(_read(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding; every seventh row has the
    next label."""
    vecs = _read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return negatives.mine_hard_negatives(vecs.withColumn("label", moved), "id % 100 = 0")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four whitened components. ``deviation`` is null
    where it does not fit a long."""
    out = whitening.whiten(_read(spark, sf_dir, "embeddings"))
    return (out.withColumn("deviation_exact", F.col("deviation").cast("string"))
            .withColumn("deviation", F.col("deviation").try_cast("long")))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.label_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_html_diff, op2_embedding_neardup, op3_ngram_join, op4_decontaminate, op5_katz_scores, op6_license_scan, op7_mix_sources, op8_quality, op9_line_dedup,
        op10_pii, op11_hard_negatives, op12_whitening, op13_toxicity)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
