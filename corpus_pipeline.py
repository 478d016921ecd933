"""The corpus pipeline: quality, near copies, benchmark passages, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatgrid.llm import kneser_ney, packing, pii, vertical_join, wu_manber
from beatgrid.llm.common import table
from beatgrid.sources.files import materialised


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity stays under the threshold of their language."""
    model = kneser_ney.fit(docs, table(spark, sf_dir, "labels"), whole=True)
    return model.judged(model.perplexities(docs, docs.columns)).filter("_keep").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more.

    A document is known by its id and its text, so rows that share an id only are told apart.
    """
    known = docs.withColumn("_key", F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash")))
    found = vertical_join.join_documents(known, ident="_key", size=5, percent=80)
    kept = found.filter(F.col("_key").eqNullSafe(F.col("component_id"))).select(F.col("_key.id").alias("_id"), F.col("_key.hash").alias("_hash"))
    kept = kept.distinct()
    same = F.col("_key.id").eqNullSafe(F.col("_id")) & (F.col("_key.hash") == F.col("_hash"))
    one = Window.partitionBy("_key.hash", "_key.id").orderBy("_key.id")
    rows = known.join(kept, same, "left_semi").withColumn("_copy", F.row_number().over(one))
    return rows.filter("_copy = 1").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    found = wu_manber.decontaminate(rows, table(spark, sf_dir, "benchmark"), ident="row")
    return found.filter(~F.col("contaminated")).select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near copies", near_copies),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: Tokenizer and trained models are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
