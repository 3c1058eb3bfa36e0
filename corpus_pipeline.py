"""The training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes each stage's result to the shared folder and reads it back as the next
one's documents. Every stage but the last returns the columns it was given.

All stages keep documents whose text or id is null unless the stage's own rule
drops them; an empty table passes through; rows that repeat one id stay or go
together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featurelens.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from featurelens.llm.tables import stage

KEEP_FROM = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose probability of the best grade is under
    ``KEEP_FROM`` (poor and toxic ones)."""
    model = quality.fit_ordinal(quality.graded(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), 3)
    scored = quality.score(docs, model, prefix="_quality_")
    return scored.where(F.col("_quality_tail_2") >= KEEP_FROM).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one of each group of similar lines; a document all of whose
    lines went (and had any) goes. ``n_chars`` counts the new text."""
    out = line_dedup.dedup_lines(docs).where("n_lines = 0 or n_removed < n_lines")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))
    return out.select(*docs.columns)


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the smallest id of each class of near-duplicates."""
    gone = ngram_join.ngram_join(docs).where("doc_id <> class_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with size, target, taken and copies."""
    drawn = (mixing.mix_sources(docs).where("taken > 0").groupBy("doc_id")
             .agg(F.max("size").alias("size"), F.max("target").alias("target"), F.max("taken").alias("taken")))
    drawn = drawn.select(F.col("doc_id").alias("_id"), "size", "target", "taken",
                         F.expr("taken div size").alias("copies"))
    kept = docs.drop(*[c for c in ("size", "target", "taken", "copies") if c in docs.columns])
    return kept.join(drawn, kept["doc_id"].eqNullSafe(drawn["_id"])).drop("_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_ngrams),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix),
]

#: The classifier and the MinHash stages have no SQL form; tests/llm holds the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), "corpus-" + name.replace(" ", "-").lower())
    return docs
