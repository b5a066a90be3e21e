"""Five stages that turn the documents table into packed training bins.

Every stage works on all documents that the stage before has kept.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.llm import decontamination, near_dedup, packing, quality_rules, secret_scan
from pontualis.llm.tables import Workspace, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or the log-likelihood ratio."""
    trusted = read(spark, sf_dir, "labels").where("quality = 1")
    ratio = quality_rules.fit_ratio(docs, trusted)
    return quality_rules.keep_good(docs, ratio)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    return near_dedup.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontamination.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    columns = docs.columns
    clean = secret_scan.redact(docs)
    if "n_chars" in columns:
        clean = clean.withColumn("n_chars", F.length("text").cast("bigint"))
    return clean.select(*columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document, or its pieces, in bins."""
    return packing.pack(packing.items_of(docs))


STAGES = [("quality rules", quality), ("near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark), ("secret scans", secrets),
          ("best-fit packing", packed)]

# Hashed n-gram ratios and the packing order are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    workspace = Workspace(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = workspace.save(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
